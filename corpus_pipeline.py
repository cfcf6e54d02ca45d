"""Corpus pipeline: STAGES over documents, each written as Parquet and read again as the next one's docs.

Every stage works on all that the one before it kept. The quality classifier drops documents that score under its
threshold, the Jaccard join leaves one document of each group, decontamination drops documents with a benchmark passage,
mixing samples by calibrated probabilities, and the last stage writes the rest as token files and returns their index.

All but the last stage return the columns of docs as they are, whatever other columns these have and whatever their
names; docs needs doc_id, text, source and lang. Null texts count as empty. Rows with a null id are judged like others but
for the Jaccard join, which can't name them and keeps them all. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weft.llm.decontaminate import without_leaks
from weft.llm.jaccard_join import one_of_each
from weft.llm.mixing import sampled
from weft.llm.quality import accepted
from weft.llm.token_output import token_output
from weft.sources.scratch import clear, mark, materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels outside the held-out fifth.

    Empty texts have a score like any other; of repeated rows all or none stay. Without usable labels all documents score
    one half and stay.
    """
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that word 5-gram sets of similarity 0.8 or more connect: that of the smallest id.

    Empty texts are like nothing and stay. Of rows with one id and text one stays; different texts of one id are judged
    each by itself. Very long texts are compared whole.
    """
    return one_of_each(docs, n=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage. Empty texts have none; repeated rows all stay or all go."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to flattened shares of sources, languages and forms.

    Null sources and languages are a value of their own. The draw depends on the id (null: the text), so repeated rows share
    their fate.
    """
    return sampled(docs, power=0.9, budget=0.9, rounds=12)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' index: document, start, length, checksum, file and place; a row for each row of docs.

    Empty texts have the end id only. Null ids come first; rows with one id go by their text's hash.
    """
    return token_output(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mixture", mixture), ("tokens", tokens)]
#: Boosted trees, set joins by hashes and tokenizers have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage wrote besides its result is deleted before the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    since = mark()
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        clear(spark, since)
        since = mark() - 1
    return docs
