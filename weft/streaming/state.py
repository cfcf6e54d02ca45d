"""Progress that can be resumed: contiguous prefixes, aligned logs, append-only ledgers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.sources.scratch import exists


#: Indices of a block.
BLOCK = 65_536


def contiguous_prefix(done: DataFrame, group: list[str], index: str) -> DataFrame:
    """Completed rows up to the first gap; indices start at 0 in each group, and rows with one index stay together.

    Indices are counted in blocks: the first block that isn't full holds the first gap, and only it is looked through.
    """
    keys = done.where(F.col(index) >= 0).select(*group, index).distinct().withColumn("_b", F.floor(F.col(index) / BLOCK))
    sizes = keys.groupBy(*group, "_b").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*group).orderBy("_b")
    # A block counts if all before it are there and full.
    fine = sizes.withColumns({"_k": F.row_number().over(w) - 1, "_full": F.coalesce(F.min((F.col("_n") == BLOCK).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(1))})
    fine = fine.where("_b = _k and _full = 1").select(*group, "_b")
    within = Window.partitionBy(*group, "_b").orderBy(index)
    left = keys.join(fine, [*group, "_b"]).withColumn("_k", F.row_number().over(within) - 1).where(F.col(index) == F.col("_b") * BLOCK + F.col("_k")).select(*group, index)
    return done.join(left, [*group, index], "left_semi")


def trusted_prefix(logs: list[DataFrame], index: str, valid: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Indices that all logs have from 0 on without a gap; if ``valid`` finds any bad row among them, none."""
    common = contiguous_prefix(logs[0].select(index).distinct(), [], index)
    for log in logs[1:]:
        common = common.join(contiguous_prefix(log.select(index).distinct(), [], index), index, "left_semi")
    if valid is not None and not valid(logs[0].join(common, index, "left_semi")).isEmpty():
        return common.limit(0)
    return common


def pending(plan: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Planned rows without a completed one."""
    return plan.join(done.select(key).distinct(), key, "left_anti")


def append_once(batch: DataFrame, path: str, key: list[str]) -> None:
    """Append the rows of a batch that the table lacks; the same batch again adds nothing."""
    spark = batch.sparkSession
    fresh = batch.dropDuplicates(key)
    if exists(spark, path):
        fresh = fresh.join(spark.read.parquet(path).select(*key), key, "left_anti")
    fresh.write.mode("append").parquet(path)


def stream_into(stream: DataFrame, path: str, checkpoint: str, key: list[str]):
    """A running query that appends each micro-batch once, whatever is replayed after a failure."""
    return stream.writeStream.foreachBatch(lambda df, _: append_once(df, path, key)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def chain_hashes(events: DataFrame, group: list[str], order: list[str], payload: str, seed: str) -> DataFrame:
    """Each event with the hash that a ledger chains it with: SHA-256 of the hash before and the payload.

    A chain is sequential, so each ledger's payload digests are folded in one row.
    """
    rows = events.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(*order, F.sha2(payload, 256).alias("d")))).alias("e"))
    zero = F.struct(F.sha2(F.lit(seed), 256).alias("h"), F.array().cast("array<string>").alias("out"))
    folded = F.aggregate("e", zero, lambda a, e: F.struct(F.sha2(F.concat(a["h"], e["d"]), 256).alias("h"), F.concat(a["out"], F.array(F.sha2(F.concat(a["h"], e["d"]), 256))).alias("out")))["out"]
    both = rows.select(*group, F.explode(F.arrays_zip(F.col("e"), folded.alias("hash"))).alias("x"))
    return both.select(*group, *[F.col(f"x.e.{o}").alias(o) for o in order], F.col("x.hash").alias("hash"))


def broken_chain(events: DataFrame, group: list[str], order: list[str], payload: str, stored: str, seed: str) -> DataFrame:
    """Events whose stored hash isn't the recomputed one; empty for a sound ledger."""
    want = chain_hashes(events, group, order, payload, seed)
    return events.join(want, [*group, *order]).where(~F.col("hash").eqNullSafe(F.col(stored))).drop("hash")
