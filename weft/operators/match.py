"""Matching items across page breaks: predicates, candidates, scores and one-to-one assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Block types whose texts may go on in one another.
TEXT_TYPES = ("footnote", "list", "paragraph")


def contains(outer_lo: Column, outer_hi: Column, lo: Column, hi: Column, tolerance=0) -> Column:
    """Whether an interval lies in another."""
    if tolerance:
        outer_lo, outer_hi = outer_lo - tolerance, outer_hi + tolerance
    return (lo >= outer_lo) & (hi <= outer_hi)


def overlaps(a_lo: Column, a_hi: Column, lo: Column, hi: Column) -> Column:
    """Whether two intervals meet."""
    return (hi >= a_lo) & (lo <= a_hi)


def box_contains(outer: Column, inner: Column, tolerance: float = 2.0) -> Column:
    """Whether a rectangle (x0, y0, x1, y1) lies in another."""
    return contains(outer[0], outer[2], inner[0], inner[2], tolerance) & contains(outer[1], outer[3], inner[1], inner[3], tolerance)


def page_noise(text: Column, y0: Column, y1: Column, height: Column) -> Column:
    """Running heads and feet: a low text block that reaches into the outer 6 % of the page and holds a page number only."""
    t = F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")))
    edge = (y0 <= height * 0.06) | (y1 >= height * 0.94)
    low = (y1 - y0) <= F.greatest(F.lit(90.0), height * 0.05)
    bare = (F.length(t) <= 12) & t.rlike(r"\A(?:[0-9]+|[ivxlcdm]+)\z")
    paged = (F.length(t) <= 20) & t.rlike(r"\A(?:page\s*)?[0-9]+(?:\s*/\s*[0-9]+)?\z")
    return edge & low & (bare | paged)


def filter_or_all(df: DataFrame, group: list[str], drop: Column) -> DataFrame:
    """Rows that aren't to be dropped; a group of which nothing would be left stays whole."""
    w = Window.partitionBy(*group)
    return df.withColumn("_d", drop).withColumn("_left", F.sum((~F.col("_d")).cast("int")).over(w)).where(~F.col("_d") | (F.col("_left") == 0)).drop("_d", "_left")


def compatible(prev_kind: Column, next_kind: Column, prev_type: Column, next_type: Column, prev_code: Column, next_code: Column) -> Column:
    """Whether two items may be one: tables with tables, captions with equal codes, equal block types but headings, text types with each other."""
    blocks = (prev_kind == "block") & (next_kind == "block")
    heading = (prev_type == "heading") | (next_type == "heading")
    caption = (prev_type == "caption") & (next_type == "caption")
    mixed = prev_type.isin("paragraph", "list") & next_type.isin("paragraph", "list")
    return ((prev_kind == "table") & (next_kind == "table")) | (blocks & ~heading & F.when(caption, prev_code == next_code).otherwise((prev_type == next_type) | mixed))


def block_score(prev_type: Column, next_type: Column, aligned: Column, near_edges: Column, same_code: Column) -> Column:
    """Evidence that a block goes on in another; equal caption codes add 4 and end a caption's score."""
    text_like = prev_type.isin(*TEXT_TYPES) & next_type.isin(*TEXT_TYPES)
    captions = (prev_type == "caption") & (next_type == "caption")
    n = lambda c, v: F.when(c, F.lit(float(v))).otherwise(0.0)
    return n((prev_type == next_type) | text_like, 2) + n(aligned & text_like, 1) + n(near_edges, 1) + F.when(captions, n(same_code, 4)).otherwise(n(same_code, 1))


def table_score(codes: Column, same_code: Column, strong: Column, weak: Column, near_edges: Column, same_width: Column, aligned: Column, width_ratio: Column) -> Column:
    """Evidence that a table goes on in another; header signatures count less, the more codes there are (0, 1 or 2)."""
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (codes + 1).cast("int"))
    n = lambda c, v: F.when(c, F.lit(float(v))).otherwise(0.0)
    header = F.when(strong, pick([4.0, 3.0, 0.5])).when(weak, pick([2.0, 1.5, 0.25])).otherwise(0.0)
    return n(same_code, 5) + header + n(near_edges, 1) + n(same_width, 1) + n(aligned & same_width, 0.5) + n(width_ratio >= 0.90, 0.5)


def near_edges(prev_bottom: Column, prev_height: Column, next_top: Column, next_height: Column, share: float = 0.17) -> Column:
    """Whether one item ends near its page's bottom and the other starts near its page's top."""
    return (prev_bottom >= prev_height * (1 - share)) & (next_top <= next_height * share)


def edge_pairs(items: DataFrame, page: str, order: str, *, window: int = 5, most: int = 9) -> DataFrame:
    """Pairs of the last items of a page with the first of the next: page, left_item, right_item, rank; nearest the break first."""
    last = items.withColumn("b", F.row_number().over(Window.partitionBy(page).orderBy(F.desc(order)))).where(F.col("b") <= window)
    first = items.withColumn("f", F.row_number().over(Window.partitionBy(page).orderBy(order))).where(F.col("f") <= window)
    both = last.select(F.col(page).alias("page"), F.col(order).alias("left_item"), "b").join(first.select((F.col(page) - 1).alias("page"), F.col(order).alias("right_item"), "f"), "page")
    ranked = both.withColumn("rank", F.row_number().over(Window.partitionBy("page").orderBy(F.col("b") + F.col("f"), "b", "f")))
    return ranked.where(F.col("rank") <= most).select("page", "left_item", "right_item", "rank")


def greedy_match(scored: DataFrame, group: str, left: str, right: str, score: str, least: float) -> DataFrame:
    """One-to-one pairs within groups: left items from the last up, each with its best unused right item of at least a score.

    Ties go to the earlier right item. Each choice depends on the ones before it, so a group is solved in one piece; it
    holds the few candidates of a page break.
    """

    def run(pdf):
        used, rows = set(), []
        for _, own in sorted(pdf.groupby(left), key=lambda x: -x[0]):
            fit = own[(own[score] >= least) & ~own[right].isin(used)].sort_values([score, right], ascending=[False, True])
            if len(fit):
                used.add(fit.iloc[0][right])
                rows.append(fit.iloc[:1])
        import pandas as pd

        return pd.concat(rows) if rows else pdf.iloc[:0]

    return scored.groupBy(group).applyInPandas(run, scored.schema)


def by_verdict(breaks: DataFrame, verdicts: DataFrame, least: float) -> DataFrame:
    """Page breaks (page, joined with page + 1) and what decides them: page, route (linked, apart or candidates).

    A verdict of at least this confidence decides alone, for or against a link; without one candidates are scored. verdicts
    has page, continues and confidence; of several for one break the surest counts, and of equally sure ones a link.
    """
    best = verdicts.groupBy("page").agg(F.max(F.struct("confidence", "continues")).alias("v"))
    sure = F.coalesce(F.col("v.confidence") >= least, F.lit(False))
    return breaks.select("page").distinct().join(best, "page", "left").select("page", F.when(sure & F.col("v.continues"), "linked").when(sure, "apart").otherwise("candidates").alias("route"))


def break_candidates(items: DataFrame, compatible: Column, ignorable: Column, *, window: int = 5) -> DataFrame:
    """Items that claim to go on across a page break, and why some can't: page, side, item, reason (null: a candidate).

    items has page, item, boundary and whatever the two conditions need. Truncated items of a page stand against resumed
    ones of the next. outside_edge_window: not among the last or first ``window`` items; no_compatible_partner: no item of
    the other side within its window fits, by a condition on structs a (before the break) and b (after it);
    blocked_by_intervening_content: something between the item and the break isn't ignorable, a condition on structs a (the
    item) and x (what lies between).
    """
    w = Window.partitionBy("page")
    rows = items.withColumns({"_front": F.row_number().over(w.orderBy("item")), "_back": F.row_number().over(w.orderBy(F.desc("item")))})
    whole = F.struct(*[F.col(c) for c in items.columns])
    before = rows.where(F.col("boundary").isin("truncated", "both")).select("page", "item", F.col("_back").alias("n"), whole.alias("me"))
    after = rows.where(F.col("boundary").isin("resumed", "both")).select((F.col("page") - 1).alias("page"), "item", F.col("_front").alias("n"), whole.alias("me"))
    edge = lambda df: df.where(F.col("n") <= window)
    met = edge(before).select("page", F.col("item").alias("left"), F.col("me").alias("a")).join(edge(after).select("page", F.col("item").alias("right"), F.col("me").alias("b")), "page").where(compatible)
    sides = []
    for side, df, key, order in (("before", before, "left", "_back"), ("after", after, "right", "_front")):
        partner = met.select("page", F.col(key).alias("item")).distinct().withColumn("_met", F.lit(True))
        near = rows.where(F.col(order) < window).select("page" if side == "before" else (F.col("page") - 1).alias("page"), F.col(order).alias("_m"), whole.alias("x"))
        held = edge(df).select("page", "item", "n", F.col("me").alias("a")).join(near, "page").where((F.col("_m") < F.col("n")) & ~F.coalesce(ignorable, F.lit(False))).select("page", "item").distinct().withColumn("_held", F.lit(True))
        j = df.select("page", "item", "n").join(partner, ["page", "item"], "left").join(held, ["page", "item"], "left")
        why = F.when(F.col("n") > window, "outside_edge_window").when(F.col("_met").isNull(), "no_compatible_partner").when(F.col("_held"), "blocked_by_intervening_content")
        sides.append(j.select("page", F.lit(side).alias("side"), "item", why.alias("reason")))
    return sides[0].unionByName(sides[1])


def caption_codes(items: DataFrame) -> DataFrame:
    """Items of pages with the codes that captions hand on: the columns of items, code replaced, and conflict.

    items has page, item, kind (caption, table, figure, artifact or other), code and text. A caption's own code is its stored
    one if that is a label, else the label its text starts with, kept as written. It goes to the first table or figure (as
    the label says) after it, before the next caption with a label; that takes it if it has no code of its own, and is a
    conflict if it has another. Items in one place go by kind and text.
    """
    from weft.functions.codes import local_code, parse_caption

    w = Window.partitionBy("page").orderBy("item", "kind", "text")
    stored = F.when(parse_caption(F.col("code")).isNotNull(), F.trim("code"))
    label = parse_caption(F.col("text"))
    written = F.when(label.isNotNull(), F.regexp_extract(F.col("text"), r"(?s)^\s*(.*)", 1))
    shown = F.rtrim(F.regexp_replace(F.left(written, F.length(written) - F.length(label["rest"])), r"[\s:.\-–—]+$", ""))
    own = F.when(F.col("kind") == "caption", F.coalesce(stored, shown))
    t = items.withColumn("_own", own).withColumn("_of", local_code(F.col("_own"))).withColumn("_island", F.count("_own").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    isle = Window.partitionBy("page", "_island")
    t = t.withColumns({"_label": F.max("_own").over(isle), "_key": F.max("_of").over(isle)})
    fits = (F.col("kind") == F.split_part("_key", F.lit(" "), F.lit(1))) & (F.col("_island") > 0)
    t = t.withColumn("_fits", F.coalesce(fits, F.lit(False))).withColumn("_first", F.col("_fits") & (F.row_number().over(Window.partitionBy("page", "_island", "_fits").orderBy("item", "kind", "text")) == 1))
    had = local_code(F.col("code"))
    code = F.when(F.col("_own").isNotNull() & (F.trim(F.coalesce("code", F.lit(""))) == ""), F.col("_own")).when(F.col("_first") & had.isNull(), F.col("_label")).otherwise(F.col("code"))
    return t.withColumn("conflict", F.coalesce(F.col("_first") & had.isNotNull() & (had != F.col("_key")), F.lit(False))).withColumn("code", code).select(*items.columns, "conflict")
