"""Queries that assemble groups, identities, differences and layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.operators import assemble, graph
from weft.plans.tables import table


def merged_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("g"), F.when(F.col("p_partkey") % 3 > 0, F.col("p_brand")).alias("code"), F.col("p_type").alias("type"), (F.col("p_size") / 50).alias("confidence"))
    return assemble.merge_groups(p, "g")


def identity_minting(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").withColumn("code", F.when(F.col("p_partkey") % 2 == 0, F.concat("p_brand", F.lit("-"), F.col("p_size").cast("string"))))
    return assemble.identity_keys(p, F.lit("doc"), "code", F.col("p_name"), F.col("p_partkey").cast("string")).select("p_partkey", "identity_key", "id")


def scope_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_name", F.create_map(F.lit("brand"), "p_brand", F.lit("type"), "p_type").alias("scope"))
    return assemble.scope_conflicts(p, "p_name")


def bounded_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("component"), "p_type", "p_size", "p_partkey")
    got = assemble.split_components(p, most=20, keys=["p_type", "p_size"])
    return got.groupBy("part", "review").agg(F.count("*").alias("n"))


def decisions_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 11 > 0, F.col("value") / 100).alias("confidence"))
    return assemble.by_confidence(e, 0.1).groupBy("skipped", "why").agg(F.count("*").alias("n"))


def cached_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as requests, orders as decisions: answered with the first one, or pending."""
    req = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    dec = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("replicate"), F.col("o_orderpriority").alias("decision"))
    done, todo = assemble.with_decisions(req, dec, ["k"])
    return done.select("k", "replicate", "decision").unionByName(todo.select("k", F.lit(None).cast("long").alias("replicate"), F.lit("pending").alias("decision")))


def property_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each event, as a nested object, differs from the user's event before."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    big = F.when(F.col("k") % 4 == 0, F.struct(F.col("k").alias("a/b"), F.lit("x").alias("c")))
    now = F.to_json(F.struct(F.struct("event_type", (F.col("k") % 3).alias("m")).alias("kind"), (F.col("k") % 5).alias("k"), big.alias("big")))
    e = e.withColumn("now", now).withColumn("prev", F.lag("now").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    got = assemble.json_differences(e.where("prev is not null"), "event_id", "prev", "now")
    return got.groupBy("path").agg(F.count("*").alias("n"), F.count("old").alias("n_old"), F.count("new").alias("n_new"))


def heading_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns whose length is a multiple of three as headings, with any number of other turns between them."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length(F.coalesce("text", F.lit(""))).alias("n"))
    return assemble.neighbour_headings(t, "conv_id", "turn", F.when(F.col("n") % 3 == 0, F.concat("role", F.col("turn").cast("string")))).select("conv_id", "turn", "headings_before", "headings_after")


def covering_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as cells of a grid of two columns: even rows' left cells reach down one row."""
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("table"), (F.col("l_linenumber") - 1).cast("int").alias("row")).distinct()
    grid = l.withColumn("col", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("source_row", F.when((F.col("col") == 0) & (F.col("row") % 2 == 1), F.col("row") - 1).otherwise(F.col("row")))
    child = l.select("table", F.col("row").alias("unit"), "row", F.concat(F.lit("c"), F.col("row").cast("string")).alias("id"))
    parent = l.where("row % 2 = 0").select("table", F.lit(-1).alias("unit"), "row", F.concat(F.lit("p"), F.col("row").cast("string")).alias("id"), F.lit(0).alias("first_col"), F.lit(0).alias("last_col"))
    return assemble.cell_relations(child, parent, grid)


def placeholder_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_quantity") % 3).alias("x"), (F.col("l_linenumber") % 2).cast("double").alias("y"))
    return assemble.placeholder_boxes(l, "l_suppkey", ["x", "y"], F.lit(0.9))


def cycle_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shortest cycle of each strong component of customers whose orders follow one another, over all orders."""
    from weft.plans.graphs import order_edges

    e = order_edges(spark, sf_dir)
    return assemble.shortest_cycle(e, graph.strong_components(e)).select("component", "length")


def stitched_row_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max(F.col("l_quantity") % 4).cast("int").alias("n"))
    got = assemble.row_boxes(s.withColumns({"top": F.lit(0.0), "bottom": F.col("n") * 10.0}), "l_orderkey", "l_linenumber", "n", "top", "bottom")
    return got.groupBy("l_orderkey").agg(F.count("*").alias("n_rows"), F.max("row").alias("last_row"), F.sum("y1").alias("y1"))


def collapsed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_quantity") % 4).cast("int").alias("w"), (F.col("l_linenumber") == 1).alias("head"))
    return assemble.collapsed_tables(l.withColumn("w", F.when(F.col("head"), 3).otherwise(F.greatest(F.col("w"), F.lit(1)))), "l_orderkey", F.col("w"), F.col("head"))


def overlapping_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_id") * 37 % 5000).alias("start")).withColumn("end", F.col("start") + F.col("event_id") % 90)
    return assemble.overlapping_anchors(e, ["user_id"], ("event_id",)).select("event_id")


def mapped_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    got = assemble.map_grades(F.array(F.concat(F.lit("G"), (F.col("n_nationkey") % 4).cast("string")), F.lit("G1")), {"G0": ["K"], "G1": ["1", "2"], "G2": ["2", "3"]})
    return n.select("n_nationkey", F.array_join(got, ",").alias("grades"))


QUERIES = {f.__name__: f for f in (merged_groups, identity_minting, scope_conflicts, bounded_components, decisions_split, cached_decisions, property_changes, heading_neighbours, covering_cells, placeholder_pages, cycle_examples, stitched_row_boxes, collapsed_tables, overlapping_spans, mapped_grades)}

SQL = {
    "merged_groups": """
with p as (select p_name g, case when p_partkey % 3 > 0 then p_brand end code, p_type t, p_size / 50 c from part),
m as (select g, count(*) n, min(c) lowest, max(c) highest, count(distinct code) n_codes, min(code) code, count(distinct t) n_types, min(t) as type from p group by 1)
select *, case n_codes when 0 then 'none' when 1 then 'single' else 'unresolved' end code_choice, case when n_types = 1 then 'single' else 'needs selection' end type_choice from m""",
    "identity_minting": r"""
with p as (select p_partkey, p_name b, case when p_partkey % 2 = 0 then 'doc:code:' || p_brand || '-' || p_size else 'doc:text:' || substr(sha256(p_name), 1, 16) end f from part),
c as (select *, count(*) over (partition by f) n, count(*) over (partition by f, b) m from p),
k as (select p_partkey, case when n = 1 then f when m = 1 then f || ':' || substr(sha256(b), 1, 12) else f || ':' || substr(sha256(b || '|' || p_partkey), 1, 12) end identity_key from c),
h as (select *, sha1('\x6B\xA7\xB8\x11\x9D\xAD\x11\xD1\x80\xB4\x00\xC0\x4F\xD4\x30\xC8'::blob || identity_key::blob) h from k)
select p_partkey, identity_key, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', (('0x' || substr(h, 17, 1))::integer & 3) + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) id from h""",
    "scope_conflicts": """
select p_name, 'brand' as name, count(distinct p_brand) n from part group by 1 having count(distinct p_brand) > 1
union all select p_name, 'type', count(distinct p_type) from part group by 1 having count(distinct p_type) > 1""",
    "bounded_components": """
with a as (select *, count(*) over (partition by p_brand) n from part), b as (select *, case when n > 20 then p_brand || '/' || p_type else p_brand end q from a),
c as (select *, count(*) over (partition by q) m from b), d as (select case when m > 20 then q || '/' || p_size else q end part from c)
select part, count(*) > 20 review, count(*) n from d group by 1""",
    "decisions_split": """
with e as (select case when event_id % 11 > 0 then value / 100 end c from events), w as (select case when c is null then 'no confidence' when c < 0.1 then 'under threshold' end why from e)
select why is not null skipped, why, count(*) n from w group by 1, 2""",
    "cached_decisions": """
with d as (select o_custkey k, o_orderkey r, o_orderpriority p, row_number() over (partition by o_custkey order by o_orderkey) i from orders where o_orderkey % 3 = 0)
select c_custkey k, r replicate, coalesce(p, 'pending') decision from customer left join d on k = c_custkey and i = 1""",
    "heading_neighbours": """
with h as (select conv_id, turn, case when length(coalesce(text, '')) % 3 = 0 then role || turn end h from conversations)
select conv_id, turn, array_to_string(coalesce(list(h) filter (h is not null) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), [])[-2:], ' | ') headings_before,
  array_to_string(coalesce(list(h) filter (h is not null) over (partition by conv_id order by turn rows between 1 following and unbounded following), [])[:2], ' | ') headings_after from h""",
    "property_changes": """
with e as (select user_id, event_type t, (props::json ->> 'k')::integer k, lag(event_type) over w pt, (lag(props) over w)::json ->> 'k' pk from events window w as (partition by user_id order by ts, event_id)),
p as (select t, k, pt, pk::integer j from e where pk is not null),
d as (select '/kind/event_type' path, 1 o, 1 n from p where t <> pt union all select '/kind/m', 1, 1 from p where k % 3 <> j % 3 union all select '/k', 1, 1 from p where k % 5 <> j % 5
  union all select '/big', (j % 4 = 0)::int, (k % 4 = 0)::int from p where (k % 4 = 0) <> (j % 4 = 0) union all select '/big/a~1b', 1, 1 from p where k % 4 = 0 and j % 4 = 0 and k <> j)
select path, count(*) n, sum(o)::bigint n_old, sum(n)::bigint n_new from d group by 1""",
    "covering_cells": """
with l as (select distinct l_orderkey t, l_linenumber - 1 r from lineitem)
select c.t as table, 'c' || c.r child, 'p' || p.r parent, case when c.r = p.r then 'same_row' else 'covering' end relation from l c join l p on c.t = p.t and p.r % 2 = 0 and (c.r = p.r or c.r = p.r + 1)""",
    "placeholder_pages": """
with b as (select l_suppkey, l_quantity % 3 x, l_linenumber % 2 y, count(*) n from lineitem group by 1, 2, 3),
r as (select *, row_number() over (partition by l_suppkey order by n desc, x, y) k, sum(n) over (partition by l_suppkey) total from b)
select l_suppkey, round(n / total, 6) share from r where k = 1 and total >= 3 and ((x = 0 and y = 0 and n / total >= 0.3) or n / total >= 0.2)""",
    "stitched_row_boxes": """
with s as (select l_orderkey, l_linenumber, max(l_quantity % 4)::integer n from lineitem group by 1, 2)
select l_orderkey, sum(n)::bigint n_rows, (sum(n) - 1)::bigint last_row, sum(10.0 * n * (n + 1) / 2)::double y1 from s group by 1 having sum(n) > 0""",
    "collapsed_tables": """
with l as (select l_orderkey, l_linenumber = 1 h, case when l_linenumber = 1 then 3 else greatest((l_quantity % 4)::integer, 1) end w from lineitem),
g as (select l_orderkey, max(w) filter (h) h, quantile_cont(w, 0.5) filter (not h) m, avg((w = 1)::integer) filter (not h) s from l group by 1)
select l_orderkey, 'collapsed' why from g where h >= 3 and m <= 1 and s >= 0.6""",
    "overlapping_spans": """
with e as (select user_id, event_id, event_id * 37 % 5000 s, event_id * 37 % 5000 + event_id % 90 t from events), p as (select *, lag(t) over (partition by user_id order by s, t) q from e)
select event_id from p where s < q""",
    "mapped_grades": """
select n_nationkey, case n_nationkey % 4 when 0 then 'K,1,2' when 1 then '1,2' when 2 then '2,3,1' end grades from nation""",
}
