"""Queries on hierarchies and graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.operators import graph
from weft.plans.tables import HIERARCHY, hierarchy, table


def hierarchy_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.ancestor_distances(hierarchy(spark, sf_dir))


def ancestor_paths_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hierarchy with a second, direct edge of every third supplier to its region, so that some have two paths."""
    e = hierarchy(spark, sf_dir)
    direct = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).where("s_suppkey % 3 = 0").select(F.concat(F.lit("s"), "s_suppkey").alias("child"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))
    return graph.ancestor_paths(e.select("child", "parent").unionByName(direct), depth=4, paths=1)


def nearest_ancestor_of_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = hierarchy(spark, sf_dir)
    kinds = e.select(F.col("child").alias("node"), F.col("child_kind").alias("kind")).union(e.select("parent", F.lit("region")).where("parent like 'r%'")).distinct()
    return graph.nearest_of_type(e, kinds, "region")


def tainted_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All below nations in which some supplier owes more than 500."""
    bad = table(spark, sf_dir, "supplier").where("s_acctbal < -500").select(F.concat(F.lit("n"), F.col("s_nationkey")).alias("node"))
    return graph.descendants(hierarchy(spark, sf_dir), bad)


def longest_root_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest way up from each part through parts of smaller size that share its brand and first word: a DAG.

    Sizes stand for their parts: whatever the number of parts, a brand and word has one node for each size.
    """
    p = table(spark, sf_dir, "part").select("p_brand", "p_size", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("w")).distinct()
    e = p.alias("c").join(p.alias("q"), ["p_brand", "w"]).where("q.p_size < c.p_size")
    name = lambda n: F.concat_ws("/", "p_brand", "w", F.lpad(F.col(f"{n}.p_size").cast("string"), 2, "0"))
    return graph.longest_depth(e.select(name("c").alias("child"), name("q").alias("parent")))


def siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many siblings each nation, supplier and customer has, and the first of them; no pairs are made."""
    return graph.sibling_counts(hierarchy(spark, sf_dir))


def sibling_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations of one region, as pairs."""
    return graph.siblings(hierarchy(spark, sf_dir).where("child_kind = 'nation'"))


def order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed edges between customers: the one of each order to the one of the next order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("a"))
    nxt = o.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("a").alias("b"))
    return o.join(nxt, "o_orderkey").where("a <> b").select("a", "b").distinct()


_ORDER_EDGES = "e as (select distinct o.o_custkey a, n.o_custkey b from orders o join orders n on n.o_orderkey = o.o_orderkey + 1 where o.o_custkey <> n.o_custkey)"


def cyclic_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in cycles of orders that follow one another, or between such, with their edges left after peeling."""
    core = graph.cyclic_core(order_edges(spark, sf_dir))
    return core.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("n"))


def scc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strong components of two or more customers whose orders follow one another, over all orders."""
    return graph.strong_components(order_edges(spark, sf_dir))


def node_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.adjacency(hierarchy(spark, sf_dir))


def common_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest common ancestor of each two suppliers that ship lines of one order."""
    s = table(spark, sf_dir, "lineitem").select("l_orderkey", F.concat(F.lit("s"), "l_suppkey").alias("s")).distinct()
    pairs = s.alias("a").join(s.alias("b"), "l_orderkey").where("a.s < b.s").select(F.col("a.s").alias("a"), F.col("b.s").alias("b")).distinct()
    d = graph.ancestor_distances(hierarchy(spark, sf_dir).where("child_kind <> 'customer'"))
    up = lambda n: d.select(F.col("node").alias(n), "ancestor", F.col("distance").alias(f"d{n}"))
    both = pairs.join(up("a"), "a").join(up("b"), ["b", "ancestor"])
    return both.groupBy("a", "b").agg(F.min_by("ancestor", F.struct(F.col("da") + F.col("db"), "ancestor")).alias("ancestor"), F.min(F.col("da") + F.col("db")).alias("distance"))


QUERIES = {f.__name__: f for f in (hierarchy_closure, ancestor_paths_bounded, nearest_ancestor_of_type, tainted_descendants, longest_root_distance, siblings, sibling_pairs, cyclic_nodes, scc, node_degrees, common_ancestors)}

_CLOSURE = f"with recursive {HIERARCHY}, up(node, ancestor, distance) as (select child, parent, 1 from edges union select up.node, edges.parent, up.distance + 1 from up join edges on up.ancestor = edges.child)"
SQL = {
    "hierarchy_closure": f"{_CLOSURE} select node, ancestor, min(distance)::integer distance from up group by 1, 2",
    "ancestor_paths_bounded": f"""
with recursive {HIERARCHY}, e as (select child, parent from edges union select 's' || s_suppkey, 'r' || n_regionkey from supplier join nation on s_nationkey = n_nationkey where s_suppkey % 3 = 0),
p(node, top, path, length) as (select child, parent, child || '>' || parent, 1 from e union all select p.node, e.parent, p.path || '>' || e.parent, length + 1 from p join e on p.top = e.child),
r as (select node, path, length, row_number() over (partition by node order by length, path) k, count(*) over (partition by node) n from p where top like 'r%')
select node, path, length::integer length, n > 1 truncated from r where k <= 1""",
    "nearest_ancestor_of_type": f"{_CLOSURE} select distinct node, ancestor from up where ancestor like 'r%'",
    "tainted_descendants": f"{_CLOSURE} select distinct node from up where ancestor in (select 'n' || s_nationkey from supplier where s_acctbal < -500)",
    "longest_root_distance": """
with recursive p as (select distinct p_brand, p_size, split_part(p_name, ' ', 1) w from part),
e as (select p_brand || '/' || w || '/' || lpad(c.p_size::varchar, 2, '0') child, p_brand || '/' || w || '/' || lpad(q.p_size::varchar, 2, '0') parent from p c join p q using (p_brand, w) where q.p_size < c.p_size),
up(node, d) as (select child, 1 from e union select e.child, d + 1 from up join e on up.node = e.parent)
select node, max(d)::integer depth from up group by 1""",
    "siblings": f"""
with {HIERARCHY}, g as (select parent, count(*) n, min(child) lo, min(child, 2)[2] nxt from edges group by 1)
select child node, n - 1 n, case when child = lo then nxt else lo end first_sibling from edges join g using (parent) where n > 1""",
    "sibling_pairs": "select 'n' || a.n_nationkey node, 'n' || b.n_nationkey sibling from nation a join nation b on a.n_regionkey = b.n_regionkey and a.n_nationkey <> b.n_nationkey",
    "scc": f"""
with recursive {_ORDER_EDGES}, r(x, y) as (select a, b from e union select r.x, e.b from r join e on r.y = e.a)
select f.x node, min(f.y) component from r f join r g on f.x = g.y and f.y = g.x where f.x in (select x from r where x = y) group by 1 having count(*) > 1""",
    "cyclic_nodes": f"""
with recursive {_ORDER_EDGES}, r(x, y) as (select a, b from e union select r.x, e.b from r join e on r.y = e.a),
c as (select x from r where x = y), live as (select x from c union select r.y from r join c using (x)), back as (select x from c union select r.x from r join c on r.y = c.x),
ok as (select x from live intersect select x from back)
select a node, count(*) n from e where a in (from ok) and b in (from ok) group by 1""",
    "node_degrees": f"""
with {HIERARCHY}, d as (select parent node, count(distinct child) children from edges group by 1), u as (select child node, count(distinct parent) parents from edges group by 1)
select node, coalesce(children, 0)::bigint children, coalesce(parents, 0)::bigint parents from d full join u using (node)""",
    "common_ancestors": """
with l as (select distinct l_orderkey o, l_suppkey s from lineitem), p as (select distinct 's' || x.s a, 's' || y.s b from l x join l y using (o) where 's' || x.s < 's' || y.s),
u as (select 's' || s_suppkey s, 'n' || s_nationkey t, 1 d from supplier union all select 's' || s_suppkey, 'r' || n_regionkey, 2 from supplier join nation on s_nationkey = n_nationkey),
m as (select a, b, x.t, x.d + y.d d, row_number() over (partition by a, b order by x.d + y.d, x.t) i from p join u x on x.s = a join u y on y.s = b and x.t = y.t)
select a, b, t ancestor, d::integer distance from m where i = 1""",
}
