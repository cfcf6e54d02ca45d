"""Queries on pages, page breaks, captions, stitched slices and layout rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.operators import assemble, match, nested
from weft.plans.tables import table


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as items of pages: an order is a page, a line an item."""
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("page"), F.col("l_linenumber").cast("int").alias("item")).agg(F.max("l_quantity").cast("int").alias("q"), F.max("l_returnflag").alias("flag"), F.max("l_linestatus").alias("status"), F.max("l_partkey").alias("part"))
    return l


_ITEMS = "i as (select l_orderkey page, l_linenumber::integer item, max(l_quantity)::integer q, max(l_returnflag) flag, max(l_linestatus) status, max(l_partkey) part from lineitem group by 1, 2)"


def caption_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes that lines standing for captions hand on to lines standing for tables and figures."""
    i = _items(spark, sf_dir)
    kind = F.element_at(F.array(*map(F.lit, ["caption", "table", "figure", "artifact", "other"])), F.col("q") % 5 + 1)
    word = F.when(F.col("part") % 2 == 0, "Tableau ").otherwise("Fig. ")
    text = F.when(F.col("q") % 5 == 0, F.concat(word, F.col("q").cast("string"), F.lit(".1: of "), F.col("part").cast("string")))
    code = F.when(F.col("part") % 7 == 0, F.concat(F.lit("Table "), F.col("q").cast("string")))
    got = match.caption_codes(i.select("page", "item", kind.alias("kind"), code.alias("code"), text.alias("text")))
    return got.select("page", "item", "code", "conflict")


def break_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why lines that claim to go on to the next order, or to come from the one before, can't; pages follow one another."""
    i = _items(spark, sf_dir)
    boundary = F.element_at(F.array(*map(F.lit, ["complete", "truncated", "resumed", "both"])), F.col("q") % 4 + 1)
    items = i.select("page", "item", "status", "q", boundary.alias("boundary"))
    got = match.break_candidates(items, F.col("a.status") == F.col("b.status"), F.col("x.q") < 25, window=2)
    return got.groupBy("page", "side").agg(F.count("*").alias("n"), F.count("reason").alias("n_refused"), F.min("reason").alias("least_reason"), F.min(F.when(F.col("reason").isNull(), F.col("item"))).alias("first"))


def break_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as page breaks and their lines as verdicts: the surest one decides if it is sure enough."""
    v = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), (F.col("l_linenumber") % 2 == 0).alias("continues"), (F.col("l_discount") * 10).alias("confidence"))
    return match.by_verdict(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page")), v, 0.85)


def lowest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest line of each order, those with return flag N first, and the highest."""
    i = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("y0"), (F.col("l_quantity") + F.col("l_partkey") % 9).alias("y1"), (F.col("l_returnflag") == "N").alias("n"), F.struct("l_linenumber", "l_partkey").alias("item"))
    got = [assemble.edge_item(i, "l_orderkey", bottom=b, prefer=[F.col("n")]).select("l_orderkey", F.lit("bottom" if b else "top").alias("edge"), F.col("item.l_linenumber").alias("line")) for b in (True, False)]
    return got[0].unionByName(got[1])


def _slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as chains of table slices, one for each return flag: a head that is repeated, then lines; some have codes."""
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.array_sort(F.collect_list(F.array(F.lpad(F.col("l_linenumber").cast("string"), 3, "0"), F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0")))).alias("body"), F.min("l_partkey").alias("part"))
    rows = F.concat(F.array(F.array(F.lit(" Line"), F.lit("Quantity"))), F.col("body"))
    code = F.when(F.col("part") % 3 == 0, F.concat(F.lit("Tab. "), (F.col("part") % 4).cast("string")))
    repeats = F.when(F.col("part") % 5 == 0, F.lit(False))
    return l.select("l_orderkey", "l_returnflag", rows.alias("rows"), (F.col("l_orderkey") % 2).cast("int").alias("header"), repeats.alias("repeats"), code.alias("code"))


def stitched_table_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stitched tables: rows left, depth of the head (declared or guessed), first code and whether codes disagree."""
    return nested.stitch_tables(_slices(spark, sf_dir), "l_orderkey", "l_returnflag")[1]


def stitched_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as chains of text slices."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 < 2, F.col("text")).alias("text"), F.when(F.col("role") == "user", "fr").otherwise("en").alias("language"), F.array(F.col("role")).alias("items"), F.when(F.col("turn") == 2, "figure").alias("figure"), F.when(F.col("turn") > 0, F.concat(F.lit(" C"), F.col("turn").cast("string"))).alias("code"), F.col("role").alias("block_type"))
    got = nested.stitch_blocks(t, "conv_id", "turn")
    return got.select("conv_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"), "language", F.array_join("items", ",").alias("items"), "figure", "code", "block_type", "n_slices")


def padded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order as ragged rows, filled up to four cells."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_linenumber") == 1).alias("head"), F.lit(4).alias("width"), F.slice(F.array(F.when(F.col("l_partkey") % 3 > 0, "").otherwise("a"), F.lit("b"), F.lit("c"), F.lit("d")), F.lit(1), (F.col("l_partkey") % 4 + 1).cast("int")).alias("cells"))
    got = nested.pad_rows(l, "l_orderkey", "cells", header="head", width="width")
    return got.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("cells", "|").alias("cells"))


def table_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on tables, over orders whose lines stand for rows."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_quantity") % 4).cast("int").alias("q"), (F.col("l_linenumber") == 1).alias("head"), (F.col("l_partkey") % 6 > 3).alias("text"), F.when(F.col("l_orderkey") % 11 == 0, 51).alias("n_cols"))
    width = F.when(F.col("head"), F.col("q") + 2).when(F.col("q") == 3, 1).otherwise(F.greatest(F.col("q"), F.lit(1)))
    return assemble.table_faults(l, "l_orderkey", width, F.col("head"), F.col("text"), F.col("n_cols"))


def box_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on boxes, over orders whose lines stand for items."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("item"), "l_quantity", "l_returnflag", "l_partkey")
    y0 = F.col("l_quantity") * 20
    box = F.when(F.col("l_partkey") % 13 > 0, F.array((F.col("l_partkey") % 3) * 10.0 - 8, y0, F.lit(500.0), y0 + (F.col("l_partkey") % 4) * 120))
    i = l.select("l_orderkey", "item", box.alias("box"), F.when(F.col("l_returnflag") == "N", "footnote").otherwise("paragraph").alias("kind"), F.when(F.col("l_partkey") % 2 == 0, "complete").otherwise("truncated").alias("boundary"))
    got = assemble.box_faults(i, "l_orderkey", "item", width=F.lit(600), height=F.lit(1000))
    return got.groupBy("l_orderkey", "fault").agg(F.count("*").alias("n"))


def anchor_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Excerpts of conversations' turns, cited in the order of other turns: what is wrong with them."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    unit = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    units = t.select(unit.alias("unit"), F.col("turn").alias("order"), "text")
    start = (F.col("turn") * 3 % 5 + 1).cast("int")
    cited = t.select("conv_id", "turn", "text", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    anchors = cited.select(F.col("conv_id").alias("candidate"), (F.col("turn") * 2 + F.col("k")).alias("place"), F.when(F.col("turn") == 3, F.lit("nowhere")).otherwise(unit).alias("unit"), F.substring("text", F.lit(1) + start + F.col("k") * 4, F.lit(8)).alias("excerpt"), F.when((F.col("turn") == 2) & (F.col("k") == 1), 50).otherwise(1).alias("nth"))
    return assemble.anchor_faults(anchors, units)


def layout_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items without two fields that hint at the answer, and the order of their sources."""
    i = _items(spark, sf_dir).withColumn("rec", F.struct("flag", "status", "q", "part"))
    kept = F.col("rec").dropFields("flag", "status")
    key = assemble.source_order(F.when(F.col("q") % 3 > 0, F.col("q") % 3), F.col("item"), F.lit(0), F.col("part"), F.col("part"))
    r = i.select("page", "item", F.to_json(kept).alias("rec"), F.row_number().over(Window.partitionBy("page").orderBy(key)).alias("place"))
    return r


QUERIES = {f.__name__: f for f in (caption_propagation, break_reasons, break_routes, lowest_items, stitched_table_heads, stitched_blocks, padded_rows, table_faults, box_faults, anchor_faults, layout_strings)}

SQL = {
    "caption_propagation": f"""
with {_ITEMS}, x as (select page, item, q, part, list_extract(['caption', 'table', 'figure', 'artifact', 'other'], q % 5 + 1) kind,
  case when part % 7 = 0 then 'Table ' || q end code, case when q % 5 = 0 then case when part % 2 = 0 then 'Tableau ' else 'Fig. ' end || q || '.1' end label from i),
y as (select *, case when kind = 'caption' then coalesce(code, label) end own from x),
z as (select *, count(own) over (partition by page order by item) island from y),
w as (select *, max(own) over (partition by page, island) handed from z),
k as (select *, case when handed like 'Tab%' then 'table' else 'figure' end wanted, regexp_extract(handed, '[0-9.]+$') name from w),
f as (select *, row_number() over (partition by page, island, kind order by item) n from k)
select page, item, case when own is not null and code is null then own when island > 0 and kind = wanted and n = 1 and code is null then handed else code end code,
  coalesce(island > 0 and kind = wanted and n = 1 and code is not null and 'table ' || q <> wanted || ' ' || name, false) conflict from f""",
    "break_reasons": f"""
with {_ITEMS}, x as (select *, q % 4 b, row_number() over (partition by page order by item) f, row_number() over (partition by page order by item desc) k from i),
l as (select *, page p from x where b in (1, 3)), r as (select *, page - 1 p from x where b in (2, 3)),
m as (select l.p, l.item li, r.item ri from l join r on l.p = r.p and l.k <= 2 and r.f <= 2 and l.status = r.status),
s as (select l.p, 'before' side, l.item, case when l.k > 2 then 'outside_edge_window' when l.item not in (select li from m where m.p = l.p) then 'no_compatible_partner'
    when exists (select 1 from x where x.page = l.page and x.k < l.k and x.q >= 25) then 'blocked_by_intervening_content' end reason from l
  union all select r.p, 'after', r.item, case when r.f > 2 then 'outside_edge_window' when r.item not in (select ri from m where m.p = r.p) then 'no_compatible_partner'
    when exists (select 1 from x where x.page = r.page and x.f < r.f and x.q >= 25) then 'blocked_by_intervening_content' end from r)
select p page, side, count(*) n, count(reason) n_refused, min(reason) least_reason, min(item) filter (reason is null) as first from s group by 1, 2""",
    "break_routes": """
with v as (select l_orderkey page, l_linenumber % 2 = 0 c, l_discount * 10 s, row_number() over (partition by l_orderkey order by l_discount * 10 desc, l_linenumber % 2 = 0 desc) k from lineitem)
select o_orderkey page, case when s >= 0.85 and c then 'linked' when s >= 0.85 then 'apart' else 'candidates' end route from (select distinct o_orderkey from orders) left join v on page = o_orderkey and k = 1""",
    "lowest_items": """
with i as (select l_orderkey, l_linenumber l, l_partkey p, l_quantity y0, l_quantity + l_partkey % 9 y1, l_returnflag = 'N' n from lineitem),
r as (select *, row_number() over (partition by l_orderkey order by n desc, y1 desc, l desc, p desc) b, row_number() over (partition by l_orderkey order by n desc, y0, l, p) t from i)
select l_orderkey, 'bottom' edge, l line from r where b = 1 union all select l_orderkey, 'top', l from r where t = 1""",
    "stitched_table_heads": """
with s as (select l_orderkey, l_returnflag f, count(*) n, min(l_partkey) part from lineitem group by 1, 2),
x as (select *, row_number() over (partition by l_orderkey order by f) k, case when part % 3 = 0 then part % 4 end code from s)
select l_orderkey, count(*) n_slices, (sum(n) + 1 + count(*) filter (k > 1 and part % 5 = 0))::bigint n_rows, 1::bigint n_header,
  'Tab. ' || (first(code order by f) filter (code is not null)) code, count(distinct code) > 1 conflict from x group by 1""",
    "padded_rows": """
with l as (select l_orderkey, l_linenumber, l_partkey, l_linenumber = 1 h, (l_partkey % 4 + 1)::integer n, list_slice([case when l_partkey % 3 > 0 then '' else 'a' end, 'b', 'c', 'd'], 1, l_partkey % 4 + 1) c from lineitem),
t as (select l_orderkey, coalesce(max(n) filter (h) = 4, false) or (count(*) filter (not h and n = 4) >= 3 and count(*) filter (not h and n = 4 and c[1] = '') >= 0.6 * count(*) filter (not h and n = 4)) as to_left from l group by 1)
select l_orderkey, l_linenumber, l_partkey, array_to_string(case when to_left then list_concat(list_resize([]::varchar[], 4 - n, ''), c) else list_concat(c, list_resize([]::varchar[], 4 - n, '')) end, '|') cells from l join t using (l_orderkey)""",
    "table_faults": """
with l as (select l_orderkey, l_linenumber = 1 h, l_partkey % 6 > 3 x, case when l_orderkey % 11 = 0 then 51 end c, (l_quantity % 4)::integer q from lineitem),
w as (select *, case when h then q + 2 when q = 3 then 1 else greatest(q, 1) end w from l),
g as (select l_orderkey, max(w) filter (h) head, list_sort(list(w) filter (not h)) b, count(*) filter (w = 1 and not h) ob, count(*) filter (not h) nb, count(*) filter (w = 1) oa, count(*) n, max(w) widest, bool_or(x) x, max(c) c from w group by 1),
f as (select l_orderkey, max(k) top, max(k) filter (w = 1) singles from (select l_orderkey, w, count(*) k from w group by 1, 2) group by 1)
select l_orderkey, unnest(list_filter([case when head >= 3 and b[len(b) // 2 + 1] <= 1 and ob >= 0.6 * nb and nb > 0 then 'collapsed' end, case when widest >= 4 and singles = top and oa >= 0.7 * n then 'mostly_single' end,
  case when coalesce(c, widest) > 50 then 'too_wide' end, case when not x then 'no_text' end], lambda v: v is not null)) fault from g join f using (l_orderkey)""",
    "box_faults": """
with l as (select l_orderkey, l_partkey p, l_returnflag = 'N' note, l_partkey % 2 = 0 complete, (l_partkey % 3) * 10.0 - 8 x0, l_quantity * 20 y0, l_quantity * 20 + (l_partkey % 4) * 120 y1, l_partkey % 13 > 0 known from lineitem),
s as (select *, count(*) over (partition by l_orderkey, known, x0, y0, y1) same from l),
f as (select l_orderkey, unnest(list_filter([case when not known then 'missing_box' end, case when known and (x0 < -2 or y0 < -2 or y1 > 1002) then 'out_of_bounds' end, case when known and same > 1 then 'duplicate_box' end,
  case when note and not complete then 'incomplete' end, case when known and note and y0 < 550 then 'high' end, case when known and note and (y1 - y0) / 1000 > 0.35 then 'tall' end], lambda v: v is not null)) fault from s)
select l_orderkey, fault, count(*) n from f group by 1, 2""",
    "layout_strings": f"""
with {_ITEMS} select page, item, '{{"q":' || q || ',"part":' || part || '}}' rec, (row_number() over (partition by page order by case when q % 3 > 0 then q % 3 else 99 end, item, part))::integer place from i""",
}
