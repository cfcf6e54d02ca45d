"""How much the training-data operators hand to a Python worker at once."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from weft.llm import jaccard_join, memory


def test_texts_come_in_bounded_batches(spark):
    """pipeline: a worker got 10,000 texts at once, whatever their size."""
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 1000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64()), "bytes": pa.array([b.nbytes], pa.int64())})

    had = spark.conf.getAll.get(memory.BATCH)
    try:
        spark.conf.set(memory.BATCH, "2000000")
        memory.small_batches(spark)
        assert spark.conf.get(memory.BATCH) == "2000000"
        spark.conf.unset(memory.BATCH)
        jaccard_join.one_of_each(docs.limit(3))
        got = docs.mapInArrow(sizes, "n long, bytes long").collect()
        assert sum(r.n for r in got) == 4000 and max(r.bytes for r in got) < 2 * memory.BATCH_BYTES
    finally:
        spark.conf.set(memory.BATCH, had) if had else spark.conf.unset(memory.BATCH)
