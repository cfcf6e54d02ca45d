"""Operator 2: token counts from a digest cache."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.content import joined_back, unseen, with_digest
from weft.llm.memory import trimmed
from weft.llm.tokens import encoder, slices, tokenizer_digest
from weft.sources.scratch import exists, materialize

CACHE = "digest binary, version string, n_tokens long"


def stored_counts(spark, cache: str, version: str) -> DataFrame | None:
    """The cache's rows for one tokenizer version, or None where there is no cache yet."""
    return spark.read.schema(CACHE).parquet(cache).where(F.col("version") == version) if exists(spark, cache) else None


def token_counts(docs: DataFrame, cache: str, *, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """Per document: doc_id, digest, n_bytes, n_tokens and over_limit (n_tokens > limit).

    The key of a count is the SHA-256 of the content (null: empty; nothing else is normalised, as anything more would
    change counts) with the SHA-256 of the vocabulary file. Only distinct contents that the cache lacks are encoded, and
    their counts are appended to it; Spark commits the append as a whole, so a run that fails leaves no half of it.
    docs needs doc_id and text; null or repeated ids keep a row each. Empty tables give no rows.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    contents = with_digest(docs)
    misses = unseen(contents, stored_counts(spark, cache, version))

    def count(batches):
        import pyarrow as pa

        code = encoder(tokenizer, False)
        for batch in batches:
            n = [code.arrays(texts)[1] for texts in slices(batch.column(1))]
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())], ["digest", "version", "n_tokens"])

    misses.mapInArrow(lambda b: trimmed(count(b)), CACHE).write.mode("append").parquet(cache)
    counts = stored_counts(spark, cache, version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    own = materialize(contents.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "contents")
    return joined_back(own, counts).select("doc_id", F.hex("digest").alias("digest"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
