"""Queries on samples, nested tables and page sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions.text import words
from weft.operators import metrics, nested, sample
from weft.plans.tables import table
from weft.sources import files
from weft.sources.scratch import small


def stratified_sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    target = F.when(F.col("lang") == "en", 40).otherwise(25)
    return sample.stratified(d, ["lang"], "doc_id", target, "rubric").select("doc_id", "lang")


def sample_shortfalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.shortfalls(table(spark, sf_dir, "documents"), ["lang", "source"], F.lit(30))


def tiered_distractors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each nation, suppliers of its own nation, its region and elsewhere, among those its customers order from."""
    return sample.tiered(_offers(spark, sf_dir), "n_nationkey", "tier", "s_suppkey", per_tier=2, total=6, seed="d").select("n_nationkey", "s_suppkey", "tier")


def _offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_nationkey, s_suppkey, tier) of all suppliers that ship to a nation's customers."""
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("s_suppkey"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    met = l.join(o, "o_orderkey").join(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), "c_custkey").select("n_nationkey", "s_suppkey").distinct()
    n = small(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("sn")).join(n.withColumnsRenamed({"n_nationkey": "sn", "n_regionkey": "sr"}), "sn")
    j = met.join(s, "s_suppkey").join(n, "n_nationkey")
    return j.select("n_nationkey", "s_suppkey", F.when(F.col("sn") == F.col("n_nationkey"), "sibling").when(F.col("sr") == F.col("n_regionkey"), "near").otherwise("distant").alias("tier"))


def distance_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the suppliers offered to nations, how many of each distance are among the six drawn."""
    return metrics.tier_acceptance(_offers(spark, sf_dir), tiered_distractors(spark, sf_dir), "tier", ["n_nationkey", "s_suppkey"])


def topped_up_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    return sample.topped_up(p, ["p_brand"], "p_partkey", {"small": F.col("p_size") <= 5, "large": F.col("p_size") >= 45}, uniform=10, per_tag=3, seed="t").select("p_partkey", "p_brand", "route")


def pair_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 97th of all pairs of parts of one brand, by its number alone."""
    g = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("size"))
    total = g.agg(F.sum(F.col("size") * (F.col("size") - 1) / 2)).first()[0] or 0
    index = spark.range(0, int(total), 97).withColumnRenamed("id", "index")
    return sample.pair_at(g, index, "p_brand", "size")


def request_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark").select("item_id")
    return sample.schedule(b, "item_id", ["swapped", "bare", "shuffled"], 1).groupBy("condition", "replicate").agg(F.count("*").alias("n"))


def lexical_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_extendedprice").alias("l_extendedprice"), F.max("l_returnflag").alias("l_returnflag"))
    return sample.selectors(l, "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag").groupBy("strategy").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("s"))


def corrupted_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts' sentences as parts; four strands of one curriculum."""
    t = table(spark, sf_dir, "benchmark").select("item_id", F.split("text", r"\. ").alias("parts"), F.lit("all").alias("curriculum"), (F.col("item_id") % 4).alias("strand"))
    return sample.corruptions(t, "item_id", "parts", curriculum="curriculum", strand="strand").groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.size("parts")).alias("n_parts"))


def span_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables made from lines, an order each, with spans by quantity: grids in long form."""
    from pyspark.sql import Window

    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    l = l.withColumn("cell", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber")))
    # The first cell of a row may reach down, the second one to the right, so that spans don't overlap.
    first = F.col("cell") % 2 == 1
    c = l.select("l_orderkey", ((F.col("cell") - 1) / 2).cast("int").alias("row"), "cell", F.col("q").cast("string").alias("text"), F.when(first, F.col("q") % 2 + 1).otherwise(1).cast("int").alias("row_span"), F.when(first, 1).otherwise(F.col("q") % 3 + 1).cast("int").alias("col_span"))
    return nested.expand_grid(c, "l_orderkey").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.max("col").alias("width"), F.countDistinct("source_row", "source_cell").alias("cells"))


def page_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of web pages, and of pages that show orders: a head over two columns, then a row for each line."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("q")).alias("r"))
    rows = l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("r")).alias("r"))
    line = lambda x: F.concat(F.lit("<tr><td>"), x["l_partkey"].cast("string"), F.lit(" &amp; <i>"), x["l_suppkey"].cast("string"), F.lit("</i><td rowspan='"), (x["q"] % 2 + 1).cast("string"), F.lit("'>"), x["q"].cast("string"), F.lit("</tr>"))
    html = F.concat(F.lit("<p>Order</p><TABLE><tr><th colspan=2>Lines</th></tr>"), F.array_join(F.transform("r", line), "\n"), F.lit("</TABLE>"))
    orders = rows.select((-F.col("l_orderkey")).alias("page_id"), html.alias("html"))
    pages = table(spark, sf_dir, "pages").select("page_id", "html").unionByName(orders)
    got = nested.html_cells(pages, "page_id", "html")
    return got.groupBy("page", "table").agg(F.count("*").alias("n_cells"), F.max("row").alias("last_row"), F.sum("row_span").alias("row_spans"), F.sum("col_span").alias("col_spans"), F.sum(F.length("text")).alias("n_chars"))


def header_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 5).alias("t"), "p_partkey", F.when(F.col("p_partkey") % 5 < F.col("p_size") % 3, F.array("p_name", "p_brand", "p_type")).otherwise(F.array(F.col("p_size").cast("string"), F.col("p_retailprice").cast("string"), F.lit(""))).alias("cells"))
    return nested.header_rows(r, "t", "p_partkey", "cells")


def stitched_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as chains of slices: each line flag's rows follow a repeated header."""
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.array_sort(F.collect_list(F.array(F.lpad(F.col("l_linenumber").cast("string"), 3, "0"), F.col("l_linestatus")))).alias("body"))
    s = l.select("l_orderkey", "l_returnflag", F.concat(F.array(F.array(F.lit(" Line"), F.lit("Status"))), F.col("body")).alias("rows"), F.lit(1).alias("header"), F.lit(None).cast("boolean").alias("repeats"))
    return nested.stitch_rows(s, "l_orderkey", "l_returnflag", "rows", "header", "repeats").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.max("row").alias("last_row"))


def html_text_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").withColumn("text", F.regexp_replace("html", r"<[^>]*>", " "))
    return p.groupBy(F.coalesce(files.text_gate(F.col("text")), F.lit("fine")).alias("gate")).agg(F.count("*").alias("n"))


def page_word_bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of pages' texts with how many pages have them, in at least a tenth of all."""
    p = table(spark, sf_dir, "pages").withColumn("text", F.regexp_replace("html", r"<[^>]*>", " "))
    n = p.count()
    return p.select(F.explode(F.array_distinct(words(F.col("text")))).alias("word")).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") * 10 >= n)


QUERIES = {f.__name__: f for f in (stratified_sample_exact, sample_shortfalls, tiered_distractors, distance_acceptance, topped_up_sample, pair_access, request_schedule, lexical_selectors, corrupted_controls, span_grid, page_tables, header_inference, stitched_tables, html_text_gate, page_word_bags)}

SQL = {
    "stratified_sample_exact": "with r as (select doc_id, lang, row_number() over (partition by lang order by md5('rubric:' || doc_id), doc_id) k from documents) select doc_id, lang from r where k <= case when lang = 'en' then 40 else 25 end",
    "sample_shortfalls": "select lang, source, count(*) n, greatest(30 - count(*), 0) missing from documents group by 1, 2",
    "tiered_distractors": """
with x as (select distinct c_nationkey n, l_suppkey s from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey),
o as (select n.n_nationkey, s_suppkey, case when s_nationkey = n.n_nationkey then 'sibling' when m.n_regionkey = n.n_regionkey then 'near' else 'distant' end tier
  from x join nation n on x.n = n.n_nationkey join supplier on s_suppkey = x.s join nation m on m.n_nationkey = s_nationkey),
k as (select *, md5('d:' || n_nationkey || ':' || s_suppkey) h from o), a as (select *, row_number() over (partition by n_nationkey, tier order by h, s_suppkey) i from k),
b as (select *, row_number() over (partition by n_nationkey order by i > 2, h, s_suppkey) r from a) select n_nationkey, s_suppkey, tier from b where r <= 6""",
    "topped_up_sample": """
with u as (select *, row_number() over (partition by p_brand order by md5('t:' || p_partkey), p_partkey) k from part), t0 as (select p_partkey, p_brand, p_size, 'uniform' route from u where k <= 10),
s as (select p.p_partkey, p.p_brand, p.p_size, row_number() over (partition by p.p_brand order by md5('t:small:' || p.p_partkey), p.p_partkey) k from part p where p_size <= 5 and p_partkey not in (select p_partkey from t0)),
t1 as (from t0 union all select p_partkey, p_brand, p_size, 'small' from s where k <= 3 - (select count(*) from t0 where t0.p_brand = s.p_brand and t0.p_size <= 5)),
l as (select p.p_partkey, p.p_brand, p.p_size, row_number() over (partition by p.p_brand order by md5('t:large:' || p.p_partkey), p.p_partkey) k from part p where p_size >= 45 and p_partkey not in (select p_partkey from t1)),
t2 as (from t1 union all select p_partkey, p_brand, p_size, 'large' from l where k <= 3 - (select count(*) from t1 where t1.p_brand = l.p_brand and t1.p_size >= 45))
select p_partkey, p_brand, route from t2""",
    "pair_access": """
with g as (select p_brand, count(*) n from part group by 1), m as (select p_brand, unnest(range(0, n)) i, n from g),
p as (select p_brand, i, j, row_number() over (order by p_brand, i, j) - 1 index from m, lateral (select unnest(range(i + 1, n)) j) t)
select index, p_brand, i, j from p where index % 97 = 0""",
    "request_schedule": """
with c(condition, replicate) as (values ('base', 0), ('base', 1), ('swapped', 0), ('bare', 0), ('shuffled', 0)) select condition, replicate, count(*) n from c, benchmark group by 1, 2""",
    "lexical_selectors": """
with l as (select l_orderkey o, l_linenumber i, max(l_extendedprice) p, max(l_returnflag) g from lineitem group by 1, 2),
w as (select *, avg(p) over (partition by o) m, row_number() over (partition by o order by p desc, i) t, count(*) over (partition by o, g) c from l),
b as (select *, first_value(g) over (partition by o order by c desc, g) best from w),
s as (select i, 'all' strategy from b union all select i, 'top1' from b where t = 1 union all select i, 'above_mean' from b where p > m union all select i, 'largest_group' from b where g = best)
select strategy, count(*) n, sum(i)::bigint s from s group by 1""",
    "corrupted_controls": r"""
with p as (select item_id, string_split(text, '. ') p, len(string_split(text, '. ')) n from benchmark),
l as (select *, list_count(list_filter(p, lambda x: len(regexp_extract_all(trim(x), '\S+')) >= 5)) long from p),
d as (select item_id, count(*) filter (len(regexp_extract_all(trim(list_last(string_split(regexp_replace(x, '\.+$', ''), ','))), '\S+')) >= 3) c from (select item_id, unnest(p) x from p) group by 1),
k as (select 'bundled_components' kind, n - 1 n from l where n >= 2 union all select 'collapsed_set', 1 from l where n >= 2
  union all select 'cross_strand_swap', n from l where (select count(distinct item_id % 4) from p) > 1 union all select 'forced_redundancy', n + 1 from l
  union all select 'invented_specificity', n from l join d using (item_id) where c < (select sum(c) from d) union all select 'truncation', n from l where long > 0 union all select 'under_decomposition', 1 from l where n >= 3)
select kind, count(*) n, sum(n)::bigint n_parts from k group by 1""",
    "stitched_tables": "select l_orderkey, count(*) + 1 n, count(*)::integer last_row from lineitem group by 1",
    "distance_acceptance": """
with x as (select distinct c_nationkey n, l_suppkey s from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey),
o as (select n.n_nationkey, s_suppkey, case when s_nationkey = n.n_nationkey then 'sibling' when m.n_regionkey = n.n_regionkey then 'near' else 'distant' end tier
  from x join nation n on x.n = n.n_nationkey join supplier on s_suppkey = x.s join nation m on m.n_nationkey = s_nationkey),
k as (select *, md5('d:' || n_nationkey || ':' || s_suppkey) h from o), a as (select *, row_number() over (partition by n_nationkey, tier order by h, s_suppkey) i from k),
b as (select *, row_number() over (partition by n_nationkey order by i > 2, h, s_suppkey) r from a)
select tier, count(*) offered, count(*) filter (r <= 6) accepted, round(count(*) filter (r <= 6) / count(*), 9) rate from b group by 1""",
    "page_tables": """
with l as (select l_orderkey o, l_linenumber, l_partkey p, l_suppkey s, l_quantity::integer q from lineitem)
select -o page, 0::integer as table, 2 * count(*) + 1 n_cells, count(*)::integer last_row, sum(q % 2 + 1)::bigint + count(*) + 1 row_spans, 2 * count(*) + 2 col_spans,
  (5 + sum(length(p::varchar) + 3 + length(s::varchar) + length(q::varchar)))::bigint n_chars from l group by 1""",
    "header_inference": r"""
with r as (select p_partkey // 5 t, p_partkey k, case when p_partkey % 5 < p_size % 3 then [p_name, p_brand, p_type] else [p_size::varchar, p_retailprice::varchar, ''] end c from part),
x as (select *, array_to_string(list_filter(c, lambda v: trim(v) <> ''), ' ') s, row_number() over (partition by t order by k) i from r),
y as (select *, (2.0 * len(regexp_extract_all(s, '[A-Za-z]')) - 1.5 * len(regexp_extract_all(s, '[0-9]'))) / greatest(length(regexp_replace(s, '\s+', '', 'g')), 1) + len(list_filter(c, lambda v: trim(v) <> '')) / len(c) score from x where i <= 3),
z as (select *, min(case when score < 1.15 then 0 else 1 end) over (partition by t order by i) ok from y)
select t, sum(ok)::bigint n_header, case when sum(ok) = 0 then 0.0 else round(least(1.0, 0.55 + 0.15 * (sum(ok) - 1) + 0.20 * greatest(0.0, avg(score) filter (ok = 1) - 1.15)), 6) end confidence from z group by 1""",
    "html_text_gate": r"""
with t as (select regexp_replace(html, '<[^>]*>', ' ', 'g') t from pages),
g as (select case when length(trim(t)) < 20 then 'short' when (length(t) - length(replace(t, chr(65533), ''))) / greatest(length(t), 1) > 0.02 then 'replaced'
  when len(regexp_extract_all(t, '[\p{L}\p{N}\p{P}\p{S}\p{Z}\s]')) / greatest(length(t), 1) < 0.9 then 'unprintable' else 'fine' end gate from t)
select gate, count(*) n from g group by 1""",
    "page_word_bags": r"""
with w as (select page_id, unnest(list_distinct(regexp_extract_all(lower(regexp_replace(html, '<[^>]*>', ' ', 'g')), '[\p{L}\p{M}\p{N}_]+'))) word from pages)
select word, count(*) n from w group by 1 having count(*) * 10 >= (select count(*) from pages)""",
}
