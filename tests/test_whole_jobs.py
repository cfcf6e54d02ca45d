"""Queries and operators on inputs that lie beyond what earlier versions looked at."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from weft.operators import assemble, dedup, graph
from weft.plans import catalog


def values(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def saved(spark, path, **tables):
    """A folder with one Parquet file or folder for each table."""
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_span_grid_has_every_order(spark, tmp_path):
    lines = spark.createDataFrame([(k, n, 2.0) for k in (5, 1999, 2000, 900_000) for n in (1, 2, 3)], "l_orderkey long, l_linenumber int, l_quantity double")
    got = catalog.QUERIES["span_grid"](spark, saved(spark, tmp_path, lineitem=lines))
    assert values(got, "l_orderkey", "cells") == [(k, 3) for k in (5, 1999, 2000, 900_000)]


def test_cycles_over_all_orders(spark, tmp_path):
    """A cycle of two far customers in far orders whose keys no sample of every 40th order has."""
    orders = spark.createDataFrame([(900_001, 70_001), (900_002, 80_002), (900_003, 70_001), (3, 1), (4, 2)], "o_orderkey long, o_custkey long")
    got = catalog.QUERIES["cycle_examples"](spark, saved(spark, tmp_path, orders=orders))
    assert values(got, "component", "length") == [(70_001, 2)]


def test_long_chain_of_components(spark, monkeypatch):
    """The smallest node reaches all 70 components, so one round by smallest labels alone finds one of them."""
    monkeypatch.setattr(graph, "LOCAL_EDGES", -1)
    rows = [(2 * i, 2 * j) for i in range(70) for j in range(i + 1, 70)] + [e for i in range(70) for e in ((2 * i, 2 * i + 1), (2 * i + 1, 2 * i))]
    got = graph.strong_components(spark.createDataFrame(rows, "a int, b int"))
    assert values(got, "node", "component") == [(n, n - n % 2) for n in range(140)]


def test_cycle_and_hierarchies_deeper_than_64(spark, monkeypatch):
    monkeypatch.setattr(graph, "LOCAL_EDGES", -1)
    n = 66
    ring = spark.createDataFrame([(k, (k + 1) % n) for k in range(n)], "a int, b int")
    members = spark.createDataFrame([(k, 0) for k in range(n)], "node int, component int")
    assert values(assemble.shortest_cycle(ring, members), "component", "length") == [(0, n)]
    chain = spark.createDataFrame([(k + 1, k) for k in range(n)], "child int, parent int")
    assert values(graph.descendants(chain, spark.createDataFrame([(0,)], "node int")), "node") == [(k,) for k in range(1, n + 1)]
    kinds = spark.createDataFrame([(0, "top")], "node int, kind string")
    assert values(graph.nearest_of_type(chain, kinds, "top"), "node", "ancestor") == [(k, 0) for k in range(1, n + 1)]


def test_short_texts_in_long_ones(spark):
    """Every pair that brute force finds, with sets of any two sizes."""
    rng = random.Random(3)
    texts = {"x y", "p q r s x y", *(f"p {c}" for c in "qrs"), "q s", "r q"}
    texts |= {" ".join(rng.sample("abcdefghijklmn", rng.randint(1, 12))) for _ in range(60)}
    want = set()
    for a in texts:
        for b in texts:
            s, t = set(a.split()), set(b.split())
            n = len(s & t)
            if a < b and (n >= 2 and n >= 0.75 * min(len(s), len(t)) or n / len(s | t) >= 0.55):
                want.add((a, b))
    got = dedup.blocked_pairs(spark.createDataFrame([(1, t) for t in texts], "scope int, text string"), "scope", "text", stop_share=1.0)
    assert set(values(got.where("rules <> 'trigram_jaccard'"), "text_a", "text_b")) == want


def test_nominated_pairs_has_no_budget(spark, tmp_path):
    n = 500
    suppliers = spark.range(n).select(F.col("id").alias("s_suppkey"), F.lit(1).alias("s_nationkey"), F.lit(10.0).alias("s_acctbal"))
    got = catalog.QUERIES["nominated_pairs"](spark, saved(spark, tmp_path, supplier=suppliers))
    assert values(got.groupBy("signal").count(), "signal", "count") == [("hierarchy", n * (n - 1) // 2), ("rank", n * (n - 1) // 2)]
