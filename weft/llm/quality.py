"""Operator 4: quality scores from boosted trees over document statistics."""

from __future__ import annotations

import zlib
from collections import Counter
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.gbt import Trees, fit
from weft.llm.memory import small_batches, trimmed

#: Labelled rows to learn from: those with the smallest hashes of their ids. A row's statistics are about 30 numbers.
TRAIN_ROWS = 8_000
MARKS = b"!|$%&*#.,;:?\"'()<>{}=_/\\@~^`+-["
_PUNCT = np.zeros(256, bool)
_PUNCT[list(MARKS + b"]")] = True
_KEPT = list(b"!|$%&*#.,")


def statistics(text: str) -> list[float]:
    """Numbers that describe a whole text: characters, words, lines, repetition. All are 0 for an empty text."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n, words, lines = len(raw), text.split(), text.split("\n")
    c = np.bincount(raw, minlength=256)
    nw, letters = max(len(words), 1), max(int(c[65:91].sum() + c[97:123].sum()), 1)
    twice = raw[1:] == raw[:-1]
    runs = int(np.count_nonzero(twice & _PUNCT[raw[1:]])) if n > 1 else 0
    seen = Counter(words)
    shared = Counter(lines)
    ends = max(int(c[46] + c[33] + c[63]), 1)
    loud = sum(x.isupper() for x in lines)
    odd = sum("|" in x or "***" in x or "%%%" in x or "$$$" in x or "###" in x or "&&&" in x or "!!" in x for x in lines)
    return [
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        c[65:91].sum() / letters,
        c[48:58].sum() / max(n, 1),
        c[32] / max(n, 1),
        c[10] / nw,
        c[128:].sum() / max(n, 1),
        _PUNCT @ c / nw,
        *[c[k] / nw for k in _KEPT],
        runs / nw,
        (n - c[32] - c[10]) / nw,
        len(seen) / nw,
        max(seen.values(), default=0) / nw,
        sum(map(eq, words, words[1:])) / nw,
        len(shared) / len(lines),
        len(words) / len(lines),
        len(words) / ends,
        loud / len(lines),
        odd / len(lines),
        float(odd),
        float(loud),
    ]


N_STATISTICS = len(statistics(""))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 on division by 5; false for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _features(batches):
    import pyarrow as pa

    for batch in batches:
        x = [statistics(t or "") for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])


def train(docs: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS, **params) -> Trees:
    """Fit on at most so many labelled rows outside the held-out fifth.

    labels needs doc_id and quality (other values than 0 and 1, and nulls, are left out; an id labelled both ways counts
    as its majority, ties as 1). The chosen ids, at most ``rows`` of them, are broadcast to fetch their texts; their
    statistics are all that comes to the driver. Of documents with one id that text counts whose hash is the smallest, and
    then the text itself.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    text = F.coalesce("text", F.lit(""))
    joined = docs.select("doc_id", text.alias("text")).join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    found = joined.select("text", "label").mapInArrow(_features, "label int, x array<double>").toArrow()
    x = np.array(found.column("x").to_pylist(), float).reshape(-1, N_STATISTICS)
    y = found.column("label").to_numpy().astype(float)
    order = np.lexsort([*x.T, y])  # the same model whatever order the rows came in
    return fit(x[order], y[order], **params)


def score(docs: DataFrame, model: Trees) -> DataFrame:
    """Every column of docs and quality_score, from 0 to 1; null texts count as empty. A clashing column is replaced."""
    import pyarrow as pa

    docs = docs.drop("quality_score")
    schema = docs.withColumn("quality_score", F.lit(0.0)).schema

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            got = []
            for a in range(0, batch.num_rows, 512):
                x = np.array([statistics(t or "") for t in texts.slice(a, 512).to_pylist()], float).reshape(-1, N_STATISTICS)
                got.append(model.probability(x))
            s = np.concatenate(got) if got else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], [*batch.schema.names, "quality_score"])

    return docs.mapInArrow(run, schema)


def accepted(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, rows: int = TRAIN_ROWS) -> DataFrame:
    """The documents whose score is at least the threshold, with their own columns as they are, whatever their names."""
    import pyarrow as pa

    small_batches(docs.sparkSession)
    model = train(docs, labels, rows=rows)

    def run(batches):
        for batch in batches:
            keep = [np.zeros(0, bool)]
            for a in range(0, batch.num_rows, 512):
                x = np.array([statistics(t or "") for t in batch.column("text").slice(a, 512).to_pylist()], float).reshape(-1, N_STATISTICS)
                keep.append(model.probability(x) >= threshold)
            yield batch.filter(pa.array(np.concatenate(keep), pa.bool_()))

    return docs.mapInArrow(lambda b: trimmed(run(b)), docs.schema)


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, rows: int = TRAIN_ROWS) -> DataFrame:
    """docs with quality_score, held_out and predicted (1 if the score is at least the threshold).

    Null texts count as empty and get a score; null ids aren't held out; repeated rows stay; columns of these three names are
    replaced; empty tables give no rows. Without labels of both classes all scores are the smoothed share of ones.
    """
    found = score(docs, train(docs, labels, rows=rows))
    return found.withColumns({"held_out": held_out(F.col("doc_id")), "predicted": (F.col("quality_score") >= threshold).cast("int")})


def crc_mod(doc_id: int) -> int:
    """The split's remainder, in plain Python."""
    return zlib.crc32(str(doc_id).encode()) % 5
