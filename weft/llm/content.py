"""Content-addressed work, shared by the count cache and the blob ledger: which contents haven't been worked on yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.sources.scratch import materialize

#: Digests broadcast to pick unseen contents out of the documents: so many at 32 bytes each, counted first.
BROADCAST_DIGESTS = 500_000


def with_digest(docs: DataFrame, *keys: str) -> DataFrame:
    """The keys (doc_id by default), text (null: empty) and the 32 bytes of its SHA-256; other columns are left out."""
    return docs.select(*(keys or ("doc_id",)), F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", F.unhex(F.sha2(F.col("text"), 256)))


def joined_back(own: DataFrame, found: DataFrame) -> DataFrame:
    """own with the columns that found has for its digest, one row for each. A content that very many rows share is dealt out.

    Contents with over 1 in 10,000 of all rows, and 1,000 at least, are hot; there are under 10,000, whose digests are
    broadcast. Their rows get one of as many salts as there are partitions, and found's row for them gets all.
    """
    spark = own.sparkSession
    n, salts = own.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = own.groupBy("digest").agg(F.count("*").alias("_c")).where(F.col("_c") > max(1_000, n // 10_000))
    hot = materialize(counts.select("digest", F.lit(True).alias("_hot")), "hot")
    if hot.isEmpty():
        return own.join(found, "digest")
    marked = lambda df: df.join(F.broadcast(hot), "digest", "left")
    salted = marked(own).withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*[c for c in own.columns if c != "digest"]), F.lit(salts))).otherwise(0).cast("int"))
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return salted.drop("_hot").join(marked(found).withColumn("_salt", F.explode(every)).drop("_hot"), ["digest", "_salt"]).drop("_salt")


def unseen(contents: DataFrame, seen: DataFrame | None) -> DataFrame:
    """One row (digest, text) for each content whose digest is not in seen.

    Texts are collapsed in the map tasks before they are shuffled, so a content that a third of all rows share sends
    one row from each task. With a stored table the digests alone are compared first; few misses are then picked out
    by broadcast (their number is counted against BROADCAST_DIGESTS), many by a shuffled join.
    """
    if seen is not None:
        missing = contents.select("digest").distinct().join(seen.select("digest").distinct(), "digest", "left_anti")
        few = missing.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS
        contents = contents.join(F.broadcast(missing) if few else missing, "digest", "left_semi")
    return contents.groupBy("digest").agg(F.first("text").alias("text"))
