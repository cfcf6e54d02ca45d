"""The driver tables and the graphs that queries build from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges (child, parent, child_kind) of region, nation, supplier and customer; names are prefixed keys."""
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    rows = [
        table(spark, sf_dir, "nation").select(name("n", "n_nationkey").alias("child"), name("r", "n_regionkey").alias("parent"), F.lit("nation").alias("child_kind")),
        table(spark, sf_dir, "supplier").select(name("s", "s_suppkey").alias("child"), name("n", "s_nationkey").alias("parent"), F.lit("supplier").alias("child_kind")),
        table(spark, sf_dir, "customer").select(name("c", "c_custkey").alias("child"), name("n", "c_nationkey").alias("parent"), F.lit("customer").alias("child_kind")),
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


#: The same edges in SQL.
HIERARCHY = """edges as (
  select 'n' || n_nationkey child, 'r' || n_regionkey parent, 'nation' child_kind from nation
  union all select 's' || s_suppkey, 'n' || s_nationkey, 'supplier' from supplier
  union all select 'c' || c_custkey, 'n' || c_nationkey, 'customer' from customer)"""
