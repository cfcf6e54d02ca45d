"""Queries on nominated pairs, parents and evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.functions.text import words
from weft.operators import dedup, pairs, resolve
from weft.plans.tables import table
from weft.sources.scratch import materialize, small


def contamination_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and benchmark items that share at least 20 distinct runs of 5 words, from an index of the runs.

    Runs are 64-bit hashes, and documents keep those of the benchmark only, by broadcast where these are few (counted). Two
    different runs with one hash would have to meet in one pair to count.
    """

    def runs(df: DataFrame, i: str) -> DataFrame:
        w = df.select(F.col(i), words(F.coalesce("text", F.lit(""))).alias("w")).where(F.size("w") >= 5)
        grams = F.transform(F.sequence(F.lit(1), F.size("w") - 4), lambda k: F.xxhash64(F.slice("w", k, 5)))
        return w.select(i, F.explode(F.array_distinct(grams)).alias("g"))

    items = materialize(runs(table(spark, sf_dir, "benchmark"), "item_id"), "benchmark-runs")
    return runs(table(spark, sf_dir, "documents"), "doc_id").join(small(items, 1_000_000), "g").groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared")).where("n_shared >= 20")


def shared_components_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers by the parts they ship: all pairs that have a tenth of their parts or more in common."""
    s = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").repartition("l_suppkey").distinct().groupBy("l_suppkey").agg(F.collect_list("l_partkey").alias("parts"))
    both = dedup.similar_pairs(s, "l_suppkey", "parts", 0.1)
    return both.select("item_a", "item_b", "n_common", "n_total", F.round(F.col("n_common") / F.col("n_total"), 9).alias("jaccard"))


def _part_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part with the next three of its brand and name, by key."""
    w = Window.partitionBy("p_brand", "p_name").orderBy("p_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_brand", F.array(*[F.lead(F.struct("p_partkey", "p_type", "p_size"), k).over(w) for k in (1, 2, 3)]).alias("next"))
    return p.withColumn("b", F.explode("next")).where("b is not null").select(
        F.col("p_partkey").alias("item_a"), F.col("b.p_partkey").alias("item_b"), F.col("p_type").alias("type_a"), F.col("b.p_type").alias("type_b"), F.col("p_size").alias("rank_a"), F.col("b.p_size").alias("rank_b"), F.col("p_brand").alias("brand")
    )


_PAIRS = "pq as (select *, row_number() over (partition by p_brand, p_name order by p_partkey) i from part), pp as (select a.p_partkey item_a, b.p_partkey item_b, a.p_type type_a, b.p_type type_b, a.p_size rank_a, b.p_size rank_b, a.p_brand brand from pq a join pq b on a.p_brand = b.p_brand and a.p_name = b.p_name and b.i - a.i between 1 and 3)"


def pair_admissibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "part").select("p_type").distinct().orderBy("p_type").limit(3)
    n = t.withColumnRenamed("p_type", "source").join(t.withColumnRenamed("p_type", "target"), F.col("source") < F.col("target")).select("source", "target", F.lit(True).alias("directed"))
    policy = n.unionByName(t.select(F.col("p_type").alias("source"), F.col("p_type").alias("target"), F.lit(False).alias("directed")))
    got = pairs.admissible(_part_pairs(spark, sf_dir), policy)
    return got.select("item_a", "item_b", F.array_join("decisions", ",").alias("decisions"))


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _part_pairs(spark, sf_dir)
    e = F.array_compact(F.array(F.when(F.col("type_a") == F.col("type_b"), F.lit("sfi_text_token_overlap")), F.when(F.abs(F.col("rank_a") - F.col("rank_b")) <= 1, F.lit("local_rank_proximity")), F.when(F.col("item_a") % 10 == F.col("item_b") % 10, F.lit("source_page_proximity")), F.lit("sfi_text_trigram_overlap")))
    return p.withColumn("evidence", e).withColumn("pair_id", F.concat_ws(":", "item_a", "item_b"))


def pair_ranked_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pairs.shortlist(_evidence(spark, sf_dir), pairs.rank_order(F.col("evidence")), 2)
    return got.select("pair_id", F.array_join("evidence", ",").alias("evidence"))


def pair_budget_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = pairs.shortlist(_evidence(spark, sf_dir), pairs.rank_order(F.col("evidence")), 2)
    ranked = e.withColumn("place", F.row_number().over(Window.partitionBy("brand").orderBy(*pairs.rank_order(F.col("evidence")), "pair_id"))).select("brand", "place", "item_a", "item_b")
    return pairs.within_budgets(ranked, "brand", "place", 1, 40)


def nominated_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers that share a nation or a balance bucket (keys v - 1 and v, so neighbours meet)."""
    s = table(spark, sf_dir, "supplier").withColumn("v", F.floor(F.col("s_acctbal") / 500))
    return pairs.bucket_pairs(s, "s_suppkey", {"hierarchy": F.array(F.col("s_nationkey").cast("long")), "rank": F.array(F.col("v") - 1, F.col("v"))}, most=None)


def cyclic_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 1000 pairs of parts by rotation distance."""
    return pairs.cyclic_pairs(table(spark, sf_dir, "part"), "p_partkey", 1000)


def parent_topk_with_reserved_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    own = n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("own_region"))
    both = s.join(F.broadcast(own), "s_nationkey").join(F.broadcast(n), F.abs(F.col("s_nationkey") - F.col("n_nationkey")) <= 6)
    same, far = F.col("s_nationkey") == F.col("n_nationkey"), F.abs(F.col("s_nationkey") - F.col("n_nationkey"))
    rules = {"identity_scope_complete_parent_match": same, "same_table_context": F.col("own_region") == F.col("n_regionkey"), "active_outline_stack_parent": F.col("n_nationkey") % 3 == 0, "nearby_source_context_key": far <= 2, "statement_type_compatible": F.lit(True), "identity_scope_direct_parent_conflict": far > 4}
    return resolve.bounded_parents(resolve.collect_evidence(both, rules), "s_suppkey", "n_nationkey", most=4, must=("identity_scope_complete_parent_match",), children=s).withColumnRenamed("child", "supplier")


def tied_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", F.array(F.lit("active_outline_stack_parent"), F.lit("nearby_source_context_key")).alias("reasons"), F.lit("supplier").alias("kind"), (F.col("s_suppkey") % 2).alias("priority"))
    got = resolve.suppress_ties(s, "s_nationkey", "kind", "priority", list(resolve.OUTLINE))
    return got.select("s_suppkey", F.array_join("reasons", ",").alias("reasons"))


def controlled_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical colour of part names: the longest alias that is in them; two equally long ones give none."""
    vocabulary = spark.createDataFrame([("blue", "BLUE"), ("old blue", "BLUE"), ("red", "RED"), ("small", "SMALL"), ("anvil", "ANVIL"), ("widget", "WIDGET"), ("small widget", "MINI")], "alias string, canonical string")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.lower("p_name").alias("key"))
    return resolve.match_controlled(p, vocabulary).select("id", "canonical")


QUERIES = {f.__name__: f for f in (contamination_pairs, shared_components_jaccard, pair_admissibility, pair_ranked_topk, pair_budget_greedy, nominated_pairs, cyclic_pairs, parent_topk_with_reserved_root, tied_evidence, controlled_values)}

_EV = f"{_PAIRS}, ev as (select *, item_a || ':' || item_b pair_id, type_a = type_b t, abs(rank_a - rank_b) <= 1 r, item_a % 10 = item_b % 10 g from pp), evs as (select *, 1 + t::int + r::int + g::int k from ev)"
SQL = {
    "contamination_pairs": r"""
with d as (select doc_id i, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{M}\p{N}_]+') w from documents), b as (select item_id i, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+') w from benchmark),
dg as (select distinct i doc_id, array_to_string(w[k:k + 4], ' ') g from (select i, w, unnest(range(1, len(w) - 3)) k from d where len(w) >= 5)),
bg as (select distinct i item_id, array_to_string(w[k:k + 4], ' ') g from (select i, w, unnest(range(1, len(w) - 3)) k from b where len(w) >= 5))
select doc_id, item_id, count(*) n_shared from dg join bg using (g) group by 1, 2 having count(*) >= 20""",
    "shared_components_jaccard": """
with s as (select distinct l_suppkey s, l_partkey p from lineitem), n as (select s, count(*) n from s group by 1),
c as (select a.s item_a, b.s item_b, count(*) n_common from s a join s b on a.p = b.p and a.s < b.s group by 1, 2),
j as (select item_a, item_b, n_common, x.n + y.n - n_common n_total from c join n x on x.s = item_a join n y on y.s = item_b)
select *, round(n_common / n_total, 9) jaccard from j where 10 * n_common >= n_total""",
    "pair_admissibility": f"""
with {_PAIRS}, t as (select distinct p_type from part order by 1 limit 3)
select item_a, item_b, array_to_string(list_filter([case when type_a in (from t) and type_b in (from t) and type_a < type_b and rank_a <= rank_b then 'builds_forward' end,
  case when type_a in (from t) and type_b in (from t) and type_b < type_a and rank_b <= rank_a then 'builds_backward' end,
  case when type_a = type_b and type_a in (from t) then 'relates' end, 'none', 'unsure'], lambda x: x is not null), ',') decisions from pp""",
    "pair_ranked_topk": f"""
with {_EV}, ends as (select *, unnest([item_a, item_b]) e from evs),
r as (select *, row_number() over (partition by e order by k desc, t desc, r desc, g desc, pair_id) i from ends)
select distinct pair_id, array_to_string(list_filter([case when t then 'sfi_text_token_overlap' end, case when r then 'local_rank_proximity' end, case when g then 'source_page_proximity' end, 'sfi_text_trigram_overlap'], lambda x: x is not null), ',') evidence from r where i <= 2""",
    "nominated_pairs": """
with s as (select s_suppkey k, s_nationkey n, floor(s_acctbal / 500) v from supplier)
select a.k item_a, b.k item_b, 'hierarchy' signal from s a join s b on a.n = b.n and a.k < b.k
union all select a.k, b.k, 'rank' from s a join s b on abs(a.v - b.v) <= 1 and a.k < b.k""",
    "cyclic_pairs": """
with i as (select p_partkey p, row_number() over (order by p_partkey) - 1 i, count(*) over () n from part),
r as (select least(a.p, b.p) item_a, greatest(a.p, b.p) item_b, row_number() over (order by d, a.i) k
  from i a, range(1, 50) t(d), i b where b.i = (a.i + d) % a.n and (2 * d <> a.n or a.i < b.i) and 2 * d <= a.n)
select item_a, item_b from r where k <= 1000""",
    "parent_topk_with_reserved_root": """
with c as (select s_suppkey supplier, s.s_nationkey = n.n_nationkey own, o.n_regionkey = n.n_regionkey st, n.n_nationkey % 3 = 0 ol, abs(s.s_nationkey - n.n_nationkey) <= 2 nb, abs(s.s_nationkey - n.n_nationkey) > 4 far, n.n_nationkey::varchar parent
  from supplier s join nation o on o.n_nationkey = s.s_nationkey join nation n on abs(s.s_nationkey - n.n_nationkey) <= 6),
w as (select *, case when own then 0 when st then 3 else 7 end tier, own::int * 180 + st::int * 85 + ol::int * 70 + nb::int * 35 + 10 - far::int * 140 weight from c),
r as (select *, row_number() over (partition by supplier order by own desc, tier, weight desc, parent) place from w), k as (select * from r where place <= 3)
select supplier, parent, tier::integer tier, weight::integer weight, place::integer place, false overflow from k
union all select supplier, 'root', 90, 0, (max(place) + 1)::integer, false from k group by 1""",
    "tied_evidence": "select s_suppkey, case when count(*) over (partition by s_nationkey, s_suppkey % 2) > 1 then 'nearby_source_context_key' else 'active_outline_stack_parent,nearby_source_context_key' end reasons from supplier",
    "controlled_values": """
with v(alias, canonical) as (values ('blue', 'BLUE'), ('old blue', 'BLUE'), ('red', 'RED'), ('small', 'SMALL'), ('anvil', 'ANVIL'), ('widget', 'WIDGET'), ('small widget', 'MINI')),
h as (select p_partkey id, canonical, rank() over (partition by p_partkey order by case when lower(p_name) = alias then 1000000 else length(alias) end desc) r from part join v on ' ' || lower(p_name) || ' ' like '% ' || alias || ' %')
select p_partkey id, case when count(distinct canonical) = 1 then min(canonical) end canonical from part left join h on h.id = p_partkey and r = 1 group by 1""",
}
