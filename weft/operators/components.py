"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.sources.scratch import materialize, remove_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (large) or smaller-or-equal (small) neighbours to its smallest neighbour or itself."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        return joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


#: Edges that one task solves, about 60 bytes each; they are counted first, and more go through rounds over tables.
LOCAL_EDGES = 500_000


def _in_one_task(batches):
    """(node, component) by labels that spread along edges and jump to their labels' labels, in arrays."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    parts = list(batches)
    if not parts:
        return
    t = pa.Table.from_batches(parts)
    both = pa.concat_arrays([*t.column("a").chunks, *t.column("b").chunks]).dictionary_encode()
    order = np.asarray(pc.sort_indices(both.dictionary))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    code = rank[np.asarray(both.indices)]
    u, v = code[: t.num_rows], code[t.num_rows :]
    label = np.arange(len(order))
    while True:
        before = label.copy()
        least = np.minimum(label[u], label[v])
        for end in (u, v):
            np.minimum.at(label, end, least)
            np.minimum.at(label, before[end], least)
        while not np.array_equal(jumped := label[label], label):
            label = jumped
        if (label == before).all():
            break
    nodes = both.dictionary.take(pa.array(order))
    yield pa.RecordBatch.from_arrays([nodes, nodes.take(pa.array(label))], ["node", "component"])


def connected_components(edges: DataFrame, *, name: str = "components", most: int = 60) -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node that can be reached.

    Nodes are of any one orderable type; nulls and loops are left out, and nodes without other edges don't appear. Each
    round deals edges by node with a minimum taken in the map tasks first, so a node with many edges doesn't fill a task,
    and is written to the shared folder. The number of rounds grows with the logarithm of the longest path.
    """
    edges = edges.select("a", "b").where("a is not null and b is not null and a <> b").distinct()
    now = materialize(edges, name)
    if now.limit(LOCAL_EDGES + 1).count() <= LOCAL_EDGES:
        kind = now.schema["a"].dataType.simpleString()
        return now.coalesce(1).mapInArrow(_in_one_task, f"node {kind}, component {kind}")
    digest = None
    for _ in range(most):
        nxt = materialize(_star(_star(now, True), False), name)
        found = nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        remove_table(now)
        now = nxt
        if tuple(found) == digest:
            break
        digest = tuple(found)
    else:
        raise RuntimeError("components didn't settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each group."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")
