"""Graph operators over edge tables (J01-J18, C13, C20). Loops are driven by counts; rows stay in tables."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.sources.scratch import materialize


def ancestor_distances(edges: DataFrame, *, most: int = 32, longest: bool = False) -> DataFrame:
    """(node, ancestor, distance) over edges (child, parent): the shortest upward path, or the longest on a DAG.

    Each round extends only what the last one found, and keeps what is new or better; it stops when nothing is. Depths
    over ``most`` raise an error, which on the longest-path form means a cycle.
    """
    edges = edges.select("child", "parent").where("child is not null and parent is not null").distinct()
    front = materialize(edges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).alias("distance")), "closure")
    known = front
    for depth in range(2, most + 2):
        grown = front.alias("f").join(edges.alias("e"), F.col("f.ancestor") == F.col("e.child")).select("node", F.col("e.parent").alias("ancestor"), F.lit(depth).alias("distance")).distinct()
        if not longest:
            grown = grown.join(known.select("node", "ancestor"), ["node", "ancestor"], "left_anti")
        front = materialize(grown, "closure")
        if front.isEmpty():
            break
        known = known.unionByName(front)
    else:
        raise RuntimeError(f"paths are longer than {most}")
    return known.groupBy("node", "ancestor").agg((F.max if longest else F.min)("distance").alias("distance"))


def ancestor_paths(edges: DataFrame, *, depth: int, paths: int) -> DataFrame:
    """Upward paths of each child that end at a root or at the depth bound: node, path (">"-joined), length, truncated.

    At most ``paths`` of each node are listed, shortest first, then by text; ``truncated`` marks nodes with more, and paths
    that the depth bound cut.
    """
    edges = edges.select(F.col("child").cast("string").alias("child"), F.col("parent").cast("string").alias("parent")).distinct()
    front = edges.select(F.col("child").alias("node"), F.col("parent").alias("top"), F.concat_ws(">", "child", "parent").alias("path"), F.lit(1).alias("length"))
    tops = edges.select(F.col("child").alias("top")).distinct()
    done = front.join(tops, "top", "left_anti").withColumn("cut", F.lit(False))
    for k in range(2, depth + 1):
        front = front.alias("f").join(edges.alias("e"), F.col("f.top") == F.col("e.child")).select("node", F.col("e.parent").alias("top"), F.concat_ws(">", "path", "e.parent").alias("path"), F.lit(k).alias("length"))
        done = done.unionByName(front.join(tops, "top", "left_anti").withColumn("cut", F.lit(False)))
    done = done.unionByName(front.join(tops, "top", "left_semi").withColumn("cut", F.lit(True)))
    w = Window.partitionBy("node")
    ranked = done.withColumn("rank", F.row_number().over(w.orderBy("length", "path"))).withColumn("n", F.count("*").over(w))
    return ranked.where(F.col("rank") <= paths).select("node", "path", "length", (F.col("cut") | (F.col("n") > paths)).alias("truncated"))


def joined(known: DataFrame | None, more: DataFrame, k: int) -> DataFrame:
    """known and more, written anew every 16th time, so that plans of deep graphs stay small."""
    known = more if known is None else known.unionByName(more)
    return materialize(known, "known") if k % 16 == 15 else known


def nearest_of_type(edges: DataFrame, kinds: DataFrame, kind: str) -> DataFrame:
    """(node, ancestor): the first ancestors of one type on every branch; a branch isn't followed beyond one.

    kinds has node and kind. Branches are followed to their end, and each (node, place) once, so cycles end too.
    """
    edges = edges.select("child", "parent").distinct()
    typed = edges.join(kinds.select(F.col("node").alias("parent"), F.col("kind")), "parent", "left").withColumn("hit", F.coalesce(F.col("kind") == kind, F.lit(False)))
    front = typed.select(F.col("child").alias("node"), F.col("parent").alias("at"), "hit")
    seen = None
    for k in count():
        front = front.distinct()
        if seen is not None:
            front = front.join(seen.select("node", "at"), ["node", "at"], "left_anti")
        front = materialize(front, "nearest")
        seen = joined(seen, front.select("node", "at", "hit"), k)
        if front.where("not hit").isEmpty():
            break
        front = front.where("not hit").join(typed.select(F.col("child").alias("at"), F.col("parent").alias("nxt"), F.col("hit").alias("h")), "at").select("node", F.col("nxt").alias("at"), F.col("h").alias("hit"))
    return seen.where("hit").select("node", F.col("at").alias("ancestor")).distinct()


def descendants(edges: DataFrame, flagged: DataFrame) -> DataFrame:
    """node of every descendant of the flagged nodes (column node), over edges (child, parent)."""
    edges = edges.select("child", "parent").distinct()
    front, known = flagged.select("node").distinct(), None
    for k in count():
        grown = front.join(edges, front["node"] == edges["parent"]).select(F.col("child").alias("node")).distinct()
        if known is not None:
            grown = grown.join(known, "node", "left_anti")
        front = materialize(grown, "reach")
        if front.isEmpty():
            break
        known = joined(known, front, k)
    return known if known is not None else front


def longest_depth(edges: DataFrame) -> DataFrame:
    """(node, depth) of nodes with a parent, over edges (child, parent) of a DAG: the longest way up.

    Round k finds the nodes from which k steps up are possible, from those of the round before. A graph of n nodes has no
    longer way than n - 1; more rounds mean a cycle, which is an error.
    """
    edges = materialize(edges.select("child", "parent").where("child is not null and parent is not null").distinct(), "depth")
    most = edges.select("child").distinct().count()
    front, known = materialize(edges.select(F.col("child").alias("node")).distinct(), "depth"), None
    for depth in count(1):
        if front.isEmpty():
            break
        if depth > most:
            raise RuntimeError("a cycle has no longest way")
        known = joined(known, front.withColumn("depth", F.lit(depth)), depth)
        front = materialize(front.join(edges, F.col("node") == F.col("parent")).select(F.col("child").alias("node")).distinct(), "depth")
    if known is None:
        return front.withColumn("depth", F.lit(0))
    return known.groupBy("node").agg(F.max("depth").alias("depth"))


def cyclic_core(edges: DataFrame, *, most: int = 200) -> DataFrame:
    """Edges (a, b) left after nodes without incoming or without outgoing edges are peeled off: what cycles live in."""
    left = materialize(edges.select("a", "b").distinct(), "peel")
    n = left.count()
    for _ in range(most):
        into, out = left.select(F.col("b").alias("a")).distinct(), left.select(F.col("a").alias("b")).distinct()
        left = materialize(left.join(into, "a", "left_semi").join(out, "b", "left_semi").select("a", "b"), "peel")
        now = left.count()
        if now == n or now == 0:
            return left
        n = now
    raise RuntimeError("peeling didn't settle")


#: Edges left after peeling that one task solves; they are counted first.
LOCAL_EDGES = 200_000


def strong_of(edges: list[tuple]) -> dict:
    """Component (its smallest node) of each node of an edge list, by Tarjan's search without recursion."""
    nexts: dict = {}
    for a, b in edges:
        nexts.setdefault(a, []).append(b)
        nexts.setdefault(b, [])
    index, low, on, stack, out = {}, {}, set(), [], {}
    for top in nexts:
        if top in index:
            continue
        work = [(top, iter(nexts[top]))]
        index[top] = low[top] = len(index)
        stack.append(top)
        on.add(top)
        while work:
            v, it = work[-1]
            for w in it:
                if w not in index:
                    index[w] = low[w] = len(index)
                    stack.append(w)
                    on.add(w)
                    work.append((w, iter(nexts[w])))
                    break
                if w in on:
                    low[v] = min(low[v], index[w])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[v])
                if low[v] == index[v]:
                    own = stack[stack.index(v) :] if stack[-1] != v else [v]
                    del stack[-len(own) :]
                    on.difference_update(own)
                    out.update(dict.fromkeys(own, min(own)))
    return out


def in_one_task(df: DataFrame, work, schema: str) -> DataFrame:
    """work() on all rows, as tuples, of a table whose size was checked."""

    def run(batches):
        import pyarrow as pa

        rows = [r for b in batches for r in zip(*[c.to_pylist() for c in b.columns], strict=True)]
        found = work(rows)
        names = [f.split()[0] for f in schema.split(", ")]
        kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
        types = [kinds[f.split()[1]] for f in schema.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in enumerate(types)], names)

    return df.coalesce(1).mapInArrow(run, schema)


def strong_components(edges: DataFrame) -> DataFrame:
    """(node, component) of nodes on cycles of two nodes or more: component is the smallest node of the cycle's component.

    What peeling leaves is solved by one task if it is small. Else each round gives every node the smallest label that
    can reach it and the smallest it can reach; where both are one node, its component is found and taken out. Nodes of a
    component have both labels in common, so edges between other labels go too. The component of the smallest node left
    is found each time, so rounds go on until no edge is left.
    """
    left, found = cyclic_core(edges.where("a <> b")), None
    kind = edges.schema["a"].dataType.simpleString()
    if kind in ("int", "bigint", "string") and left.limit(LOCAL_EDGES + 1).count() <= LOCAL_EDGES:

        def solve(rows):
            got = strong_of(rows)
            sizes: dict = {}
            for c in got.values():
                sizes[c] = sizes.get(c, 0) + 1
            return [(n, c) for n, c in got.items() if sizes[c] > 1]

        return in_one_task(left, solve, f"node {kind}, component {kind}")

    def spread(e: DataFrame) -> DataFrame:
        """(node, label) with the smallest node that reaches each node, itself included."""
        nodes = e.select(F.col("a").alias("node")).union(e.select(F.col("b").alias("node"))).distinct()
        labels, before = nodes.withColumn("label", F.col("node")), None
        while True:
            moved = e.join(labels, e["a"] == labels["node"]).select(F.col("b").alias("node"), "label")
            labels = materialize(labels.union(moved).groupBy("node").agg(F.min("label").alias("label")), "spread")
            total = tuple(labels.agg(F.sum(F.xxhash64("node", "label").cast("decimal(38,0)"))).first())
            if total == before:
                break
            before = total
        return labels

    while not left.isEmpty():
        forth = spread(left).withColumnRenamed("label", "f")
        back = spread(left.select(F.col("b").alias("a"), F.col("a").alias("b"))).withColumnRenamed("label", "g")
        labels = materialize(forth.join(back, "node"), "labels")
        done = materialize(labels.where("f = g").select("node", F.col("f").alias("component")), "strong")
        found = done if found is None else found.unionByName(done)
        rest = labels.where("f <> g")
        left = cyclic_core(left.join(rest.withColumnRenamed("node", "a"), "a").join(rest.withColumnRenamed("node", "b"), ["b", "f", "g"]).select("a", "b"))
    if found is None:
        found = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    return found.join(found.groupBy("component").count().where("count > 1").select("component"), "component", "left_semi").select("node", "component")


def sibling_counts(edges: DataFrame) -> DataFrame:
    """(node, n, first_sibling) of nodes with siblings, over edges (child, parent): how many other children their parents have.

    A node with one parent needs its group's size and two least children only; pairs are made for nodes with several parents.
    """
    e = edges.select("child", "parent").where("child is not null and parent is not null").distinct()
    least = e.groupBy("parent").agg(F.count("*").alias("n"), F.min("child").alias("lo"))
    second = e.join(least.select("parent", "lo"), "parent").where("child <> lo").groupBy("parent").agg(F.min("child").alias("second"))
    parents = e.groupBy("child").agg(F.count("*").alias("_p"))
    one = e.join(parents.where("_p = 1").select("child"), "child").join(least, "parent").join(second, "parent", "left").where("n > 1")
    single = one.select(F.col("child").alias("node"), (F.col("n") - 1).alias("n"), F.when(F.col("child") == F.col("lo"), F.col("second")).otherwise(F.col("lo")).alias("first_sibling"))
    several = e.join(parents.where("_p > 1").select("child"), "child")
    pairs = several.join(e.select("parent", F.col("child").alias("sibling")), "parent").where("child <> sibling").select(F.col("child").alias("node"), "sibling").distinct()
    return single.unionByName(pairs.groupBy("node").agg(F.count("*").alias("n"), F.min("sibling").alias("first_sibling")))


def siblings(edges: DataFrame) -> DataFrame:
    """(node, sibling) with a common parent, itself left out, each once."""
    e = edges.select("child", "parent").distinct()
    return e.alias("a").join(e.alias("b"), "parent").where("a.child <> b.child").select(F.col("a.child").alias("node"), F.col("b.child").alias("sibling")).distinct()


def adjacency(edges: DataFrame) -> DataFrame:
    """(node, children, parents) as counts: how many of each a node has."""
    down = edges.groupBy(F.col("parent").alias("node")).agg(F.count_distinct("child").alias("children"))
    up = edges.groupBy(F.col("child").alias("node")).agg(F.count_distinct("parent").alias("parents"))
    return down.join(up, "node", "full_outer").select("node", F.coalesce("children", F.lit(0)).cast("long").alias("children"), F.coalesce("parents", F.lit(0)).cast("long").alias("parents"))
