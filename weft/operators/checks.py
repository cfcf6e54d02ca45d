"""Rules as queries that return what breaks them, and set comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.operators.graph import cyclic_core, descendants
from weft.sources.scratch import materialize, small


def orphans(rows: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Rows whose key isn't known; null keys count as unknown."""
    return rows.join(known.select(F.col(known_key).alias(key)).distinct(), key, "left_anti")


def collisions(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Keys that occur more than once over all tables: key, n, n_tables."""
    out = None
    for name, df in tables.items():
        part = df.select(F.col(key).cast("string").alias("key"), F.lit(name).alias("t"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("key").agg(F.count("*").alias("n"), F.count_distinct("t").alias("n_tables")).where("n > 1")


def exactly_once(expected: DataFrame, consumed: DataFrame, key: str) -> DataFrame:
    """Keys that are missing, unknown or consumed more than once: key, problem."""
    e = expected.select(F.col(key).alias("key")).distinct().withColumn("e", F.lit(1))
    c = consumed.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("c"))
    j = e.join(c, "key", "full_outer")
    problem = F.when(F.col("c").isNull(), "missing").when(F.col("e").isNull(), "unknown").when(F.col("c") > 1, "repeated")
    return j.withColumn("problem", problem).where("problem is not null").select("key", "problem")


def functional_dependency(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Keys with more than one value: keys, n_values."""
    return df.groupBy(*keys).agg(F.count_distinct(value).alias("n_values")).where("n_values > 1")


def cardinality(counts: DataFrame, policy: DataFrame, kind: str) -> DataFrame:
    """Rows of (…, kind, n) whose n lies outside the policy's (kind, least, most); a null bound is none."""
    j = counts.join(small(policy), kind)
    return j.where((F.col("n") < F.coalesce("least", F.lit(0))) | (F.col("n") > F.coalesce("most", F.lit(1 << 62))))


def differences(actual: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Keys whose rows aren't the same on both sides: key, state (added, removed or changed). Columns must agree."""
    cols = [c for c in actual.columns if c != key]
    a = actual.select(key, F.struct(*cols).alias("a"), F.lit(1).alias("_a"))
    b = expected.select(key, F.struct(*cols).alias("b"), F.lit(1).alias("_b"))
    j = a.join(b, key, "full_outer")
    state = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(~F.col("a").eqNullSafe(F.col("b")), "changed")
    return j.select(key, state.alias("state")).where("state is not null")


def resolve_endpoints(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges with source_id and target_id, edges of which an endpoint is missing).

    edges name an endpoint by key column and value (source_key, source_value, …); nodes has key, value and id.
    """
    n = nodes.select("key", "value", "id").distinct()
    j = edges.join(n.select(F.col("key").alias("source_key"), F.col("value").alias("source_value"), F.col("id").alias("source_id")), ["source_key", "source_value"], "left")
    j = j.join(n.select(F.col("key").alias("target_key"), F.col("value").alias("target_value"), F.col("id").alias("target_id")), ["target_key", "target_value"], "left")
    return j.where("source_id is not null and target_id is not null"), j.where("source_id is null or target_id is null")


def union_layers(layers: dict[str, DataFrame]) -> DataFrame:
    """Layers of a graph in one table, with the layer's name."""
    out = None
    for name, df in layers.items():
        part = df.withColumn("layer", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def report(violations: dict[str, DataFrame]) -> DataFrame:
    """Number of rows that break each rule, zeros included: rule, n."""
    out = None
    for name, df in violations.items():
        part = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("rule"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def graph_report(nodes: DataFrame, edges: DataFrame, *, root: str, covered: DataFrame | None = None, expected: dict[str, int] | None = None, policy: DataFrame | None = None) -> DataFrame:
    """What is wrong with a graph, a row for each rule: rule, n, examples (up to five least ids).

    nodes has id and kind, edges child and parent. Rules: repeated_nodes, missing_endpoints, repeated_edges, self_edges,
    cyclic_nodes, unreachable (nodes that no path leads to from the root), uncovered (nodes that covered, a table of ids,
    lacks), wrong_count (of nodes or edges, against expected), wrong_parents (numbers of parents outside a policy of kind,
    least and most). Rules without their input are left out. Nulls are no ids.
    """
    ids = nodes.where("id is not null").select(F.col("id").cast("string").alias("id"), "kind")
    e = materialize(edges.select(F.col("child").cast("string").alias("child"), F.col("parent").cast("string").alias("parent")), "report-edges")
    once = materialize(ids.select("id").distinct(), "report-nodes")
    pair = F.concat_ws(">", "child", "parent").alias("id")
    ends = e.select(F.explode(F.array("child", "parent")).alias("id")).distinct()
    sound = e.where("child <> parent").select("child", "parent").distinct()
    reached = descendants(sound, nodes.sparkSession.createDataFrame([(root,)], "node string")).select(F.col("node").alias("id"))
    core = cyclic_core(sound.select(F.col("child").alias("a"), F.col("parent").alias("b")))
    rules = {
        "repeated_nodes": ids.groupBy("id").count().where("count > 1").select("id"),
        "missing_endpoints": ends.join(once, "id", "left_anti"),
        "repeated_edges": e.groupBy("child", "parent").count().where("count > 1").select(pair),
        "self_edges": e.where("child = parent").select(F.col("child").alias("id")).distinct(),
        "cyclic_nodes": core.select(F.col("a").alias("id")).distinct(),
        "unreachable": once.join(reached, "id", "left_anti").where(F.col("id") != root),
    }
    if covered is not None:
        rules["uncovered"] = once.join(covered.select(F.col("id").cast("string").alias("id")).distinct(), "id", "left_anti")
    if expected:
        found = {"nodes": once, "edges": e}
        off = [found[k].agg(F.count("*").alias("n")).where(F.col("n") != n).select(F.concat(F.lit(f"{k} "), F.col("n").cast("string")).alias("id")) for k, n in expected.items()]
        rules["wrong_count"] = off[0] if len(off) == 1 else off[0].union(off[1])
    if policy is not None:
        counts = ids.distinct().join(sound.groupBy(F.col("child").alias("id")).agg(F.count("*").alias("n")), "id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        rules["wrong_parents"] = cardinality(counts, policy, "kind").select("id")
    out = None
    for name, df in rules.items():
        few = df.orderBy("id").limit(5).agg(F.sort_array(F.collect_list("id")).alias("examples"))
        part = df.agg(F.count("*").alias("n")).join(few).select(F.lit(name).alias("rule"), "n", "examples")
        out = part if out is None else out.unionByName(part)
    return out


def verdict(report: DataFrame, warnings: tuple[str, ...] = ()) -> DataFrame:
    """One row for a report of (rule, n): passed, errors and warnings (rules with findings, sorted); named rules only warn."""
    found = F.col("n") > 0
    warns = F.col("rule").isin(*warnings) if warnings else F.lit(False)
    names = lambda c: F.sort_array(F.collect_list(F.when(found & c, F.col("rule"))))
    return report.agg(names(~warns).alias("errors"), names(warns).alias("warnings")).select((F.size("errors") == 0).alias("passed"), "errors", "warnings")


def gate(report: DataFrame, warnings: tuple[str, ...] = ()) -> list[str]:
    """Rules that only warn, of a report with findings; any other finding is an error. Reports have a row for each rule."""
    got = verdict(report, warnings).first()
    if not got.passed:
        raise ValueError(f"upstream report fails: {', '.join(got.errors)}")
    return got.warnings


def uncovered_rows(rows: DataFrame, chunks: DataFrame, group: list[str], index: str) -> DataFrame:
    """Rows (group, index) that no chunk (group, first, last, both included) covers.

    A chunk names its rows, so the rows are compared by key; chunks are a few rows long.
    """
    named = chunks.where("first <= last").select(*group, F.explode(F.sequence(F.col("first").cast("long"), F.col("last").cast("long"))).alias(index))
    return rows.select(*group, F.col(index).cast("long").alias(index)).distinct().join(named.distinct(), [*group, index], "left_anti")


def recount(rows: DataFrame, group: list[str], stated: DataFrame) -> DataFrame:
    """Groups whose stated number (n) isn't that of their rows, on either side: group, stated, found."""
    found = rows.groupBy(*group).agg(F.count("*").alias("found"))
    j = stated.select(*group, F.col("n").alias("stated")).join(found, group, "full_outer")
    return j.where(F.coalesce("stated", F.lit(0)) != F.coalesce("found", F.lit(0))).select(*group, F.coalesce("stated", F.lit(0)).alias("stated"), F.coalesce("found", F.lit(0)).alias("found"))
