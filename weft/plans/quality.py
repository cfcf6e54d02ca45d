"""Queries on rules, rates and agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.operators import checks, metrics
from weft.plans.tables import table


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")


def exactly_once_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against their first lines: missing, unknown or repeated keys."""
    return checks.exactly_once(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")), table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("k")), "k")


def functional_dependency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.functional_dependency(table(spark, sf_dir, "part"), ["p_brand", "p_type"], F.col("p_size"))


def cardinality_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n")).join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey")
    policy = spark.createDataFrame([("1-URGENT", 2, 6), ("2-HIGH", 1, None), ("3-MEDIUM", None, 5)], "o_orderpriority string, least int, most int")
    return checks.cardinality(n, policy, "o_orderpriority").select("l_orderkey", "o_orderpriority", "n")


def id_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.collisions({"supplier": table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")), "nation": table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k")), "lineitem": table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"))}, "k")


def endpoint_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose part or supplier is among the even keys only."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    p = table(spark, sf_dir, "part").where("p_partkey % 2 = 0")
    s = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0")
    return checks.orphans(l, "l_partkey", p, "p_partkey").select("l_orderkey", "l_linenumber", F.lit("part").alias("end")).unionByName(checks.orphans(l, "l_suppkey", s, "s_suppkey").select("l_orderkey", "l_linenumber", F.lit("supplier").alias("end")))


def reconciled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation totals of two halves of the customers: added, removed or changed."""
    c = table(spark, sf_dir, "customer")
    half = lambda cond: c.where(cond).groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return checks.differences(half("c_custkey % 2 = 0"), half("c_custkey % 2 = 1 and c_nationkey > 2"), "c_nationkey")


def wire_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of the hierarchy on the wire: all properties are text."""
    n = table(spark, sf_dir, "nation")
    nodes = n.select(F.lit("n_nationkey").alias("key"), F.col("n_nationkey").cast("string").alias("value"), F.concat(F.lit("nation:"), "n_name").alias("id")).unionByName(table(spark, sf_dir, "region").select(F.lit("r_name"), F.col("r_name"), F.concat(F.lit("region:"), "r_name")).toDF("key", "value", "id"))
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    e = n.join(F.broadcast(r), "n_regionkey").select(F.lit("r_name").alias("source_key"), F.col("r_name").alias("source_value"), F.lit("n_nationkey").alias("target_key"), F.col("n_nationkey").cast("string").alias("target_value"), (F.col("n_nationkey") < 5).alias("fallback"))
    return checks.resolve_endpoints(e, nodes)[0].select("source_id", "target_id", F.col("fallback").cast("string").alias("fallback"))


def rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    return checks.report({"negative_tax": l.where("l_tax < 0"), "late": l.where("l_shipdate > '1998-08-01'"), "discounted": l.where("l_discount >= 0.1")})


def pass_rate_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.sliced(_judged(spark, sf_dir), ["lang", "source"], metrics.rate(F.col("quality") == 1))


def precision_recall_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality guessed from the share of capitals against the label."""
    guess = F.length(F.regexp_replace("text", "[^A-Z]", "")) * 10 < F.length("text")
    return metrics.precision_recall(_judged(spark, sf_dir).where("text is not null"), ["lang"], guess, F.col("quality") == 1)


def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.majority(table(spark, sf_dir, "events"), ["user_id", "event_type"], F.col("value") > 10, "event_id")


def direction_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.agreement(_judged(spark, sf_dir), ["source", "lang"], (F.col("quality") == 0) & (F.col("toxic") == 0), F.col("toxic") == 1)


def confidence_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(metrics.histogram(F.col("l_quantity") / 50).alias("bin")).agg(F.count("*").alias("n"))


def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.bootstrap(_judged(spark, sf_dir), ["lang"], F.col("quality") == 1)


def replicate_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one user and day as judgments: type is the condition, the value's size the answer."""
    e = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "event_id", "event_type", (F.col("value") > 10).alias("big"))
    return metrics.compare_replicates(e, ["user_id", "day"], "event_id", "event_type", "big", "view").groupBy("kind").agg(F.count("*").alias("n"), F.count_if("same").alias("same"))


def supports_edges_min_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.min("l_discount").alias("confidence"), F.count_distinct("l_orderkey").alias("requests"))


def decision_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.counts_with_zeros(table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NEVER"])


def usage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("tokens", F.when(F.col("user_id") % 7 > 0, F.col("event_id") % 100))
    return metrics.usage(e, ["user_id"], "tokens")


def panel_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.crosstab(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"])


QUERIES = {f.__name__: f for f in (exactly_once_check, functional_dependency, cardinality_policy, id_collisions, endpoint_antijoin, reconciled_rows, wire_projection, rule_report, pass_rate_slices, precision_recall_f1, majority_vote, direction_agreement, confidence_histogram, bootstrap_ci, replicate_comparison, supports_edges_min_conf, decision_counts, usage_totals, panel_crosstab)}

_J = "j as (select * from labels join documents using (doc_id))"
SQL = {
    "exactly_once_check": """
with c as (select l_orderkey key, count(*) c from lineitem where l_linenumber = 1 group by 1)
select coalesce(c.key, o.key) key, case when c is null then 'missing' when o.key is null then 'unknown' else 'repeated' end problem
from (select distinct o_orderkey key from orders) o full join c using (key) where c is null or o.key is null or c > 1""",
    "functional_dependency": "select p_brand, p_type, count(distinct p_size) n_values from part group by 1, 2 having count(distinct p_size) > 1",
    "cardinality_policy": """
with n as (select l_orderkey, count(*) n from lineitem group by 1)
select l_orderkey, o_orderpriority, n from n join orders on o_orderkey = l_orderkey
where (o_orderpriority = '1-URGENT' and n not between 2 and 6) or (o_orderpriority = '2-HIGH' and n < 1) or (o_orderpriority = '3-MEDIUM' and n > 5)""",
    "id_collisions": """
with k as (select s_suppkey::varchar key, 's' t from supplier union all select n_nationkey::varchar, 'n' from nation union all select l_suppkey::varchar, 'l' from lineitem)
select key, count(*) n, count(distinct t) n_tables from k group by 1 having count(*) > 1""",
    "endpoint_antijoin": """
select l_orderkey, l_linenumber, 'part' as end from lineitem where l_partkey not in (select p_partkey from part where p_partkey % 2 = 0)
union all select l_orderkey, l_linenumber, 'supplier' from lineitem where l_suppkey not in (select s_suppkey from supplier where s_suppkey % 2 = 0)""",
    "reconciled_rows": """
with a as (select c_nationkey, count(*) n from customer where c_custkey % 2 = 0 group by 1), b as (select c_nationkey, count(*) m from customer where c_custkey % 2 = 1 and c_nationkey > 2 group by 1)
select c_nationkey, case when m is null then 'added' when n is null then 'removed' else 'changed' end state from a full join b using (c_nationkey) where n is distinct from m""",
    "wire_projection": "select 'region:' || r_name source_id, 'nation:' || n_name target_id, (n_nationkey < 5)::varchar fallback from nation join region on r_regionkey = n_regionkey",
    "rule_report": """
select 'negative_tax' as rule, count(*) n from lineitem where l_tax < 0 union all select 'late', count(*) from lineitem where l_shipdate > '1998-08-01'
union all select 'discounted', count(*) from lineitem where l_discount >= 0.1""",
    "pass_rate_slices": f"""
with {_J}, s as (select 'all' slice, null as value, quality from j union all select 'lang', lang, quality from j union all select 'source', source, quality from j)
select slice, value, count(*) filter (quality = 1) numerator, count(*) denominator, round(count(*) filter (quality = 1) / count(*), 9) rate from s group by 1, 2""",
    "precision_recall_f1": f"""
with {_J}, g as (select lang, length(regexp_replace(text, '[^A-Z]', '', 'g')) * 10 < length(text) p, quality = 1 a from j where text is not null),
c as (select lang, count(*) filter (p and a) tp, count(*) filter (p and not a) fp, count(*) filter (not p and a) fn, count(*) n from g group by 1)
select *, round(tp / nullif(tp + fp, 0), 9) as precision, round(tp / nullif(tp + fn, 0), 9) recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 9) f1 from c""",
    "majority_vote": """
with v as (select user_id, event_type, count(*) filter (value > 10) n_pass, count(*) n, min(event_id) filter (value > 10) y, min(event_id) filter (not value > 10) z from events group by 1, 2)
select user_id, event_type, n_pass, n, n_pass * 2 >= n majority, case when n_pass * 2 >= n then y else z end first_replicate, n_pass in (0, n) stable from v""",
    "direction_agreement": f"""
with {_J}, c as (select source, lang, bool_or(quality = 0 and toxic = 0) f, bool_or(toxic = 1) b from j group by 1, 2)
select source, lang, case when f and b then 'both' when f then 'forward' when b then 'backward' else 'none' end agreement from c""",
    "confidence_histogram": "select case when l_quantity / 50 >= 1 then '1.0' else format('{:.1f}', floor(l_quantity / 50 * 10) / 10) end bin, count(*) n from lineitem group by 1",
    "replicate_comparison": """
with e as (select user_id, ts::date d, event_id i, event_type t, value > 10 big from events),
p as (select case when a.t = b.t then 'repetition' when a.t = 'view' or b.t = 'view' then 'variant' end kind, a.big = b.big same from e a join e b on a.user_id = b.user_id and a.d = b.d and a.i < b.i)
select kind, count(*) n, count(*) filter (same) same from p where kind is not null group by 1""",
    "supports_edges_min_conf": "select l_partkey, l_suppkey, min(l_discount) confidence, count(distinct l_orderkey) requests from lineitem group by 1, 2",
    "decision_counts": """
with d(o_orderpriority) as (values ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW'), ('6-NEVER'))
select o_orderpriority, count(o_orderkey) n from d left join orders using (o_orderpriority) group by 1""",
    "usage_totals": """
with e as (select user_id, case when user_id % 7 > 0 then event_id % 100 end t from events)
select user_id, sum(t)::bigint known, count(*) filter (t is null) unknown, case when count(*) filter (t is null) = 0 then sum(t)::bigint end total from e group by 1""",
    "panel_crosstab": "select l_returnflag, count(*) filter (l_linestatus = 'F') \"F\", count(*) filter (l_linestatus = 'O') \"O\" from lineitem group by 1",
}
