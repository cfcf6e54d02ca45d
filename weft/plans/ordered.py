"""Queries on ordered rows: carries, chunks, chains and bands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.operators import carry, match
from weft.plans.tables import table

#: Levels of an outline that event types stand for.
LEVELS = {"signup": 0, "purchase": 1, "click": 2, "view": 3}


def fill_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("cell", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.lit(" ")))
    return carry.fill_down(e, "cell", ["user_id"], ["ts", "event_id"]).select("event_id", "filled")


def running_heading_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "conversations").withColumn("heading", F.when(F.col("role") != "assistant", F.coalesce("text", F.lit(""))))
    return carry.heading_path(t.select("conv_id", "turn", "heading"), "heading", ["conv_id"], ["turn"], most=2).select("conv_id", "turn", F.md5(F.col("path").cast("binary")).alias("path_md5"))


def active_outline_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("level", (F.col("event_id") * 7 % 4).cast("int"))
    return carry.active_parent(e.select("event_id", "user_id", "ts", "level"), "level", "event_id", ["user_id"], ["ts", "event_id"], 4).select("event_id", "level", "parent")


def code_carry_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("code", F.when(F.col("event_id") % 5 == 0, F.col("event_type")))
    from pyspark.sql import Window

    gap = F.lag("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    e = e.withColumn("broken", F.unix_timestamp("ts") - F.unix_timestamp(gap) > 86_400)
    return carry.carry_islands(e, "code", F.col("broken"), ["user_id"], ["ts", "event_id"]).select("event_id", "island", "carried")


def chunks_with_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = carry.chunks(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber"), ["l_suppkey"], ["l_orderkey", "l_linenumber"], 20, 1)
    return got.groupBy("l_suppkey", "chunk").agg(F.count("*").alias("n"), F.min("row_index").alias("first"), F.max("row_index").alias("last"), F.max("chunk_last").alias("stated_last"))


def continuation_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_extendedprice")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_extendedprice")
    linked = (F.lag("l_returnflag").over(w) == F.col("l_returnflag")) & (F.lag("l_linenumber").over(w) + 1 == F.col("l_linenumber"))
    return carry.chains(t.withColumn("linked", linked), F.col("linked"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_extendedprice"]).groupBy("l_orderkey", "chain").agg(F.count("*").alias("n"), F.min("l_linenumber").alias("first"), F.max("place").alias("last_place"))


def preceding_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events").withColumn("pos", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    got = carry.preceding_band(e, ["user_id"], "pos", F.col("event_id") % 2 == 0, F.col("event_id") % 3 == 0)
    return got.groupBy("user_id", "c", "reason").agg(F.count("*").alias("n"), F.max("p").alias("nearest"))


def interval_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose lines' ship dates all lie in the 60 days after the order, and the overlap with the first 30."""
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select("o_orderkey", match.contains(F.col("o_orderdate"), F.col("o_orderdate") + F.expr("interval 60 days"), F.col("lo"), F.col("hi")).alias("inside"), match.overlaps(F.col("o_orderdate"), F.col("o_orderdate") + F.expr("interval 30 days"), F.col("lo"), F.col("hi")).alias("meets"))


def reading_order_jumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("x", F.col("event_id") % 7 / 7)
    return carry.jumps(e, "x", "value", ["user_id"], ["ts", "event_id"], 15.0, 0.2).select("event_id", "user_id")


def contiguous_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities of each part from 1 up to the first that it was never ordered in."""
    from weft.streaming.state import contiguous_prefix as prefix

    done = table(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_quantity") - 1).cast("long").alias("idx")).distinct()
    return prefix(done, ["l_partkey"], "idx").groupBy("l_partkey").agg(F.count("*").alias("n"))


def greedy_page_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of neighbouring conversations, matched one to one by shared words."""
    from weft.functions.text import words

    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_distinct(words(F.coalesce("text", F.lit("")))).alias("w"))
    both = t.alias("a").join(t.alias("b"), F.col("a.conv_id") + 1 == F.col("b.conv_id"))
    scored = both.select(F.col("a.conv_id").alias("pair"), F.col("a.turn").alias("left"), F.col("b.turn").alias("right"), F.size(F.array_intersect("a.w", "b.w")).cast("double").alias("score"))
    return match.greedy_match(scored, "pair", "left", "right", "score", least=3.0)


def page_pair_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 9 ranked pairs of the last three turns of a conversation with the first three of the next."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return match.edge_pairs(t, "conv_id", "turn", window=3, most=9)


QUERIES = {f.__name__: f for f in (fill_down, running_heading_path, active_outline_parent, code_carry_islands, chunks_with_overlap, continuation_chains, preceding_band, interval_cover, reading_order_jumps, contiguous_prefix, greedy_page_match, page_pair_candidates)}

SQL = {
    "fill_down": "select event_id, last_value(case when event_id % 3 = 0 then event_type end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) filled from events",
    "running_heading_path": r"""
with h as (select conv_id, turn, case when role <> 'assistant' and trim(coalesce(text, '')) <> '' then trim(text) end heading from conversations),
k as (select *, lower(regexp_replace(heading, '\s+', ' ', 'g')) folded from h),
p as (select *, last_value(folded ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) prev from k),
n as (select *, case when folded is not null and folded is distinct from prev then heading end fresh from p),
l as (select conv_id, turn, list(fresh) filter (fresh is not null) over (partition by conv_id order by turn rows between unbounded preceding and current row) fs from n)
select conv_id, turn, md5(array_to_string(coalesce(fs, [])[-2:], ' > ')) path_md5 from l""",
    "active_outline_parent": """
with p as (select event_id, user_id, (event_id * 7 % 4)::integer as lev, row_number() over (partition by user_id order by ts, event_id) pos from events)
select c.event_id, c.lev as level, (select arg_max(q.event_id, q.pos) from p q where q.user_id = c.user_id and q.pos < c.pos and q.lev < c.lev
  and q.pos = (select max(r.pos) from p r where r.user_id = c.user_id and r.pos < c.pos and r.lev < c.lev)) parent from p c""",
    "code_carry_islands": """
with g as (select *, case when event_id % 5 = 0 then event_type end code, epoch(date_trunc('second', ts)) - epoch(date_trunc('second', lag(ts) over (partition by user_id order by ts, event_id))) gap from events),
i as (select *, sum(case when gap is null or gap > 86400 then 1 else 0 end) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) island from g)
select event_id, island::bigint island, last_value(code ignore nulls) over (partition by user_id, island order by ts, event_id rows between unbounded preceding and current row) carried from i""",
    "chunks_with_overlap": """
with r as (select l_suppkey, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber) - 1 i, count(*) over (partition by l_suppkey) n from lineitem),
c as (select l_suppkey, max(n) n, unnest(range(0, greatest(1, ceil((max(n) - 1) / 19))::bigint)) chunk from r group by 1)
select c.l_suppkey, c.chunk::integer chunk, count(*) n, min(i)::integer as first, max(i)::integer as last, (least(c.chunk * 19 + 20, max(c.n)) - 1)::integer stated_last from c join r on c.l_suppkey = r.l_suppkey where i between c.chunk * 19 and c.chunk * 19 + 19 group by c.l_suppkey, c.chunk""",
    "continuation_chains": """
with x as (select *, case when lag(l_returnflag) over w = l_returnflag and lag(l_linenumber) over w + 1 = l_linenumber then 0 else 1 end fresh from lineitem window w as (partition by l_orderkey order by l_linenumber, l_partkey, l_extendedprice)),
c as (select *, sum(fresh) over (partition by l_orderkey order by l_linenumber, l_partkey, l_extendedprice rows unbounded preceding) chain from x)
select l_orderkey, chain::bigint chain, count(*) n, min(l_linenumber) as first, count(*)::integer last_place from c group by 1, 2""",
    "preceding_band": """
with p as (select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) pos from events)
select c.user_id, c.pos::integer c, case when c.pos - q.pos <= 8 then 'preceding' else 'compatible' end reason, count(*) n, max(q.pos)::integer nearest
from p c join p q on c.user_id = q.user_id and q.pos < c.pos and c.pos - q.pos <= 12 and c.event_id % 2 = 0 and q.event_id % 3 = 0 group by 1, 2, 3""",
    "interval_cover": """
with l as (select l_orderkey, min(l_shipdate) lo, max(l_shipdate) hi from lineitem group by 1)
select o_orderkey, lo >= o_orderdate and hi <= o_orderdate + interval 60 day inside, hi >= o_orderdate and lo <= o_orderdate + interval 30 day meets from orders join l on o_orderkey = l_orderkey""",
    "reading_order_jumps": """
with x as (select event_id, user_id, value, event_id % 7 / 7 x, lag(value) over w pv, lag(event_id % 7 / 7) over w px from events window w as (partition by user_id order by ts, event_id))
select event_id, user_id from x where pv - value > 15 and abs(px - x) < 0.2""",
    "contiguous_prefix": """
with d as (select distinct l_partkey, l_quantity::bigint - 1 idx from lineitem), r as (select *, row_number() over (partition by l_partkey order by idx) - 1 k from d)
select l_partkey, count(*) n from r where idx = k group by 1""",
    "page_pair_candidates": """
with t as (select conv_id, turn, row_number() over (partition by conv_id order by turn desc) back, row_number() over (partition by conv_id order by turn) forth from conversations),
p as (select a.conv_id page, a.turn left_item, b.turn right_item, row_number() over (partition by a.conv_id order by a.back + b.forth, a.back, b.forth) k from t a join t b on a.conv_id + 1 = b.conv_id and a.back <= 3 and b.forth <= 3)
select page, left_item, right_item, k::integer as rank from p where k <= 9""",
}
