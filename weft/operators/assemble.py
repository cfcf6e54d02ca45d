"""Assembling records, groups and graphs."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.functions.ids import short_hash, uuid5
from weft.functions.text import truncate


def excerpt(text: Column, items: Column, *, most_text: int = 400, most_items: int = 6, most_item: int = 120) -> Column:
    """A short view of an item: its text and first list items, each cut."""
    return F.struct(truncate(text, most_text).alias("text"), F.transform(F.slice(items, 1, most_items), lambda x: truncate(x, most_item)).alias("items"), F.size(items).alias("n_items"))


def by_confidence(decisions: DataFrame, least: float) -> DataFrame:
    """decisions with skipped and why: those under the threshold and those without a confidence."""
    c = F.col("confidence")
    why = F.when(c.isNull(), "no confidence").when(c < least, "under threshold")
    return decisions.withColumns({"skipped": why.isNotNull(), "why": why})


def with_decisions(requests: DataFrame, decisions: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(requests with their decision, requests that still need one). Decisions come from people or models as a table; of
    several for one key the one with the smallest replicate counts."""
    w = Window.partitionBy(*key).orderBy("replicate")
    first = decisions.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
    return requests.join(first, key), requests.join(first.select(*key), key, "left_anti")


def canonical_direction(direction: Column, swapped: Column) -> Column:
    """A displayed direction in the pair's own order."""
    return F.when(~swapped, direction).when(direction == "forward", "backward").when(direction == "backward", "forward").otherwise(direction)


def json_differences(df: DataFrame, key: str, before: str, after: str) -> DataFrame:
    """Changes between two JSON objects of each row: key, path (JSON pointer), old, new. Only objects are looked into; what is
    absent differs from null, and is given as null here."""

    def walk(a, b, path):
        if isinstance(a, dict) and isinstance(b, dict):
            for k in sorted({*a, *b}):
                yield from walk(a.get(k, ...), b.get(k, ...), path + "/" + k.replace("~", "~0").replace("/", "~1"))
        elif a is ... or b is ... or type(a) is not type(b) or a != b:
            yield path, *(None if x is ... else json.dumps(x, sort_keys=True) for x in (a, b))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [(k, *d) for k, a, b in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True) for d in walk(json.loads(a or "{}"), json.loads(b or "{}"), "")]
            cols = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.column(0).type), *[pa.array(c, pa.string()) for c in cols[1:]]], [key, "path", "old", "new"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, before, after).mapInArrow(run, f"{key} {kind}, path string, old string, new string")


def cell_relations(children: DataFrame, parents: DataFrame, grid: DataFrame) -> DataFrame:
    """How a parent's cell stands to a child's in one table: same_unit, same_row, or covering: the parent's raw cell fills all
    its columns at the child's row. children and parents have table, unit, row, id; parents also first_col and last_col; grid
    is in long form (table, row, col, source_row)."""
    c = children.select("table", F.col("unit").alias("cu"), F.col("row").alias("cr"), F.col("id").alias("child"))
    p = parents.select("table", F.col("unit").alias("pu"), F.col("row").alias("pr"), F.col("id").alias("parent"), "first_col", "last_col")
    both = c.join(p, "table")
    earlier = both.where("pr < cr").withColumn("col", F.explode(F.sequence("first_col", "last_col")))
    filled = earlier.join(grid.select("table", F.col("row").alias("cr"), "col", "source_row"), ["table", "cr", "col"], "left")
    covering = filled.groupBy("table", "child", "parent").agg(F.min(F.coalesce(F.col("source_row") == F.col("pr"), F.lit(False))).alias("all")).where("all").select("table", "child", "parent", F.lit("covering").alias("relation"))
    direct = both.withColumn("relation", F.when(F.col("cu") == F.col("pu"), "same_unit").when(F.col("cr") == F.col("pr"), "same_row")).where("relation is not null")
    return direct.select("table", "child", "parent", "relation").unionByName(covering)


def neighbour_headings(items: DataFrame, page: str, order: str, heading: Column, *, most: int = 2) -> DataFrame:
    """The nearest headings of the same page before and after each item, in the page's order, joined by " | ".

    However many other items lie between. Blank headings are none; items that ``order`` doesn't tell apart go by heading.
    """
    h = items.withColumn("_h", F.when(F.trim(heading) != "", heading))
    h = h.withColumn("_at", F.row_number().over(Window.partitionBy(page).orderBy(order, F.col("_h").asc_nulls_last())))
    out, names = h, {}
    for side, by, pick in (("before", F.col("_at"), F.reverse), ("after", F.desc("_at"), lambda a: a)):
        w = Window.partitionBy(page).orderBy(by)
        ahead = w.rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn(f"_n{side}", F.count("_h").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        got = [F.last(F.when(F.col("_h").isNotNull() & (F.col(f"_n{side}") % most == k), F.struct(F.col(f"_n{side}").alias("n"), "_h")), True).over(ahead) for k in range(most)]
        nearest = F.transform(F.sort_array(F.array_compact(F.array(*got)), asc=False), lambda x: x["_h"])
        names[side] = F.array_join(pick(nearest), " | ")
        out = out.withColumn(f"headings_{side}", names[side])
    return out.select(*items.columns, "headings_before", "headings_after")


def merge_groups(members: DataFrame, group: str) -> DataFrame:
    """One row for each group: members, confidences from lowest to highest, codes and types, how its code is chosen."""
    got = members.groupBy(group).agg(F.count("*").alias("n"), F.min("confidence").alias("lowest"), F.max("confidence").alias("highest"), F.count_distinct("code").alias("n_codes"), F.min("code").alias("code"), F.count_distinct("type").alias("n_types"), F.min("type").alias("type"))
    return got.withColumns({"code_choice": F.when(F.col("n_codes") == 0, "none").when(F.col("n_codes") == 1, "single").otherwise("unresolved"), "type_choice": F.when(F.col("n_types") == 1, "single").otherwise("needs selection")})


def scope_conflicts(scopes: DataFrame, group: str) -> DataFrame:
    """Scope names of a group (column scope, a map) that have more than one value: group, name, n."""
    entries = scopes.select(group, F.explode("scope").alias("name", "value"))
    return entries.groupBy(group, "name").agg(F.count_distinct("value").alias("n")).where("n > 1")


def split_components(members: DataFrame, *, most: int, keys: list[str]) -> DataFrame:
    """Components over a size are cut by the keys in turn; part names what a row ends up in, review marks parts still too large."""
    out = members.withColumn("part", F.col("component").cast("string"))
    for k in keys:
        size = F.count("*").over(Window.partitionBy("part"))
        out = out.withColumn("_n", size).withColumn("part", F.when(F.col("_n") > most, F.concat_ws("/", "part", F.coalesce(F.col(k).cast("string"), F.lit("")))).otherwise(F.col("part")))
    return out.withColumn("_n", F.count("*").over(Window.partitionBy("part"))).withColumn("review", F.col("_n") > most).drop("_n")


def identity_keys(rows: DataFrame, doc: Column, code: str, basis: Column, exact: Column) -> DataFrame:
    """rows with identity_key and id: coded rows share a family key; in a family of several, a digest of the basis tells them
    apart, or of basis and exact partition where the basis isn't unique."""
    family = F.when(F.col(code).isNotNull(), F.concat_ws(":", doc, F.lit("code"), code)).otherwise(F.concat_ws(":", doc, F.lit("text"), short_hash(basis)))
    r = rows.withColumns({"_f": family, "_b": basis, "_e": exact})
    r = r.withColumns({"_n": F.count("*").over(Window.partitionBy("_f")), "_m": F.count("*").over(Window.partitionBy("_f", "_b"))})
    key = F.when(F.col("_n") == 1, F.col("_f")).when(F.col("_m") == 1, F.concat_ws(":", "_f", short_hash(F.col("_b"), 12))).otherwise(F.concat_ws(":", "_f", short_hash(F.concat_ws("|", "_b", "_e"), 12)))
    return r.withColumn("identity_key", key).withColumn("id", uuid5(F.col("identity_key"))).drop("_f", "_b", "_e", "_n", "_m")


def map_grades(grades: Column, mapping: dict[str, list[str]]) -> Column:
    """Standard grades of local ones, each once, in order; null if one is unknown."""
    table = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    got = F.transform(grades, lambda g: F.element_at(table, g))
    return F.when(~F.exists(got, lambda x: x.isNull()), F.array_distinct(F.flatten(got)))


def date_order(created: Column, modified: Column) -> Column:
    """Why two ISO dates don't stand: unreadable, or modified before created; null if they do."""
    a, b = F.try_to_timestamp(created), F.try_to_timestamp(modified)
    return F.when((created.isNotNull() & a.isNull()) | (modified.isNotNull() & b.isNull()), "unreadable").when(b < a, "modified before created")


def placeholder_boxes(items: DataFrame, page: str, box: list[str], area: Column) -> DataFrame:
    """Pages whose most frequent box looks filled in: at the origin with 30 % of items or more, or 20 % with 85 % of the area."""
    n = items.groupBy(page).agg(F.count("*").alias("items"))
    top = items.groupBy(page, *box).agg(F.count("*").alias("n"), F.max(area).alias("area"))
    best = top.withColumn("_k", F.row_number().over(Window.partitionBy(page).orderBy(F.desc("n"), *box))).where("_k = 1")
    j = best.join(n, page).withColumn("share", F.col("n") / F.col("items"))
    origin = (F.col(box[0]) == 0) & (F.col(box[1]) == 0)
    return j.where((F.col("items") >= 3) & ((origin & (F.col("share") >= 0.30)) | ((F.col("share") >= 0.20) & (F.col("area") >= 0.85)))).select(page, F.round("share", 6).alias("share"))


def shortest_cycle(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Shortest closed path through the smallest node of each strong component (node, component): component, cycle, length.

    Breadth-first from all those nodes, keeping one path, the first by text, for each node. Few edges inside components,
    which are counted first, are walked by one task; many in rounds over tables.
    """
    from itertools import count

    from weft.operators.graph import LOCAL_EDGES, in_one_task, joined
    from weft.sources.scratch import materialize

    m = members.select(F.col("node").alias("a"), "component")
    inner = edges.join(m, "a").join(members.select(F.col("node").alias("b"), F.col("component").alias("_c")), "b").where("component = _c").select("component", "a", "b").distinct()
    kind = edges.schema["a"].dataType.simpleString()
    inner = materialize(inner, "cycle")
    if kind in ("int", "bigint", "string") and inner.limit(LOCAL_EDGES + 1).count() <= LOCAL_EDGES:

        def solve(rows):
            nexts: dict = {}
            for c, a, b in rows:
                nexts.setdefault((c, a), []).append(b)
            out = []
            for c in sorted({r[0] for r in rows}):
                front, seen, length = {b: f"{c}>{b}" for b in nexts.get((c, c), [])}, set(), 1
                while front and c not in front:
                    seen.update(front)
                    grown: dict = {}
                    for at, path in front.items():
                        for b in nexts.get((c, at), []):
                            if b not in seen:
                                grown[b] = min(grown.get(b, f"{path}>{b}"), f"{path}>{b}")
                    front, length = grown, length + 1
                if c in front:
                    out.append((c, front[c], length))
            return out

        return in_one_task(inner, solve, f"component {kind}, cycle string, length int")
    front = inner.where("a = component").select("component", F.col("b").alias("at"), F.concat_ws(">", "a", "b").alias("path"))
    known, out = None, None
    for length in count(1):
        closed = materialize(front.where("at = component").groupBy("component").agg(F.min("path").alias("cycle")).withColumn("length", F.lit(length)), "closed")
        if out is None or not closed.isEmpty():
            out = joined(out, closed, length)
        left = front.where("at <> component").groupBy("component", "at").agg(F.min("path").alias("path"))
        left = left.join(out.select("component"), "component", "left_anti")
        if known is not None:
            left = left.join(known, ["component", "at"], "left_anti")
        left = materialize(left, "cycle")
        if left.isEmpty():
            break
        seen = left.select("component", "at")
        known = joined(known, seen, length)
        front = materialize(left.join(inner.withColumnRenamed("a", "at"), ["component", "at"]).select("component", F.col("b").alias("at"), F.concat_ws(">", "path", "b").alias("path")), "cycle")
    return out


def row_boxes(slices: DataFrame, chain: str, order: str, n_rows: str, top: str, bottom: str) -> DataFrame:
    """Where each stitched row lies: chain, row, slice, source_row, y0, y1; a slice's height is shared evenly."""
    before = Window.partitionBy(chain).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    s = slices.withColumn("_b", F.coalesce(F.sum(n_rows).over(before), F.lit(0))).where(F.col(n_rows) > 0).withColumn("source_row", F.explode(F.sequence(F.lit(0), F.col(n_rows).cast("int") - 1)))
    h = (F.col(bottom) - F.col(top)) / F.col(n_rows)
    return s.select(chain, (F.col("_b") + F.col("source_row")).alias("row"), F.col(order).alias("slice"), "source_row", (F.col(top) + h * F.col("source_row")).alias("y0"), (F.col(top) + h * (F.col("source_row") + 1)).alias("y1"))


def widen_short_rows(cells: Column, spans: Column, width: Column) -> Column:
    """Column spans of a row of one or two cells, the last one widened to fill the table."""
    missing = width - F.aggregate(spans, F.lit(0), lambda s, x: s + x)
    return F.when(F.size(cells).between(1, 2) & (missing > 0), F.concat(F.slice(spans, F.lit(1), F.size(spans) - 1), F.array(F.element_at(spans, -1) + missing))).otherwise(spans)


def table_faults(rows: DataFrame, table: str, width: Column, header: Column, text: Column, n_cols: Column | None = None) -> DataFrame:
    """Rules that tables break, a row each: table, fault.

    collapsed: a header of three columns or more over a body whose middle width is 1 and of which 60 % are single cells.
    mostly_single: the widest row has four columns or more, but 1 is the most frequent width and that of 70 %. too_wide: more
    than 50 columns, as declared or else as the widest row has. no_text: no cell with text. width is a row's number of
    columns, spans included; an even number of body rows takes the upper one of the middle two. Of equally frequent widths
    the first row's counts.
    """
    t = rows.select(F.col(table).alias("_t"), width.alias("w"), F.coalesce(header, F.lit(False)).alias("h"), F.coalesce(text, F.lit(False)).alias("x"), (n_cols if n_cols is not None else F.lit(None).cast("int")).alias("c"))
    counts = t.groupBy("_t", "h", "w").agg(F.count("*").alias("n"), F.max("x").alias("x"), F.max("c").alias("c"))
    body = Window.partitionBy("_t", "h").orderBy("w")
    placed = counts.withColumns({"upto": F.sum("n").over(body), "all": F.sum("n").over(Window.partitionBy("_t", "h"))})
    middle = F.min(F.when(~F.col("h") & (F.col("upto") > F.floor(F.col("all") / 2)), F.col("w")))
    one = lambda c: F.coalesce(F.sum(F.when(c & (F.col("w") == 1), F.col("n"))), F.lit(0))
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    widths = counts.groupBy("_t", "w").agg(F.sum("n").alias("n")).groupBy("_t").agg(F.max("n").alias("top"), F.max(F.when(F.col("w") == 1, F.col("n"))).alias("singles"))
    got = placed.groupBy("_t").agg(F.max(F.when(F.col("h"), F.col("w"))).alias("head"), middle.alias("mid"), one(~F.col("h")).alias("one_body"), total(~F.col("h")).alias("body"), one(F.lit(True)).alias("one_all"), total(F.lit(True)).alias("rows"), F.max("w").alias("widest"), F.max("x").alias("x"), F.max("c").alias("c"))
    j = got.join(widths, "_t")
    faults = {
        "collapsed": (F.col("head") >= 3) & (F.col("mid") <= 1) & (F.col("one_body") >= 0.6 * F.col("body")) & (F.col("body") > 0),
        "mostly_single": (F.col("widest") >= 4) & (F.col("singles") == F.col("top")) & (F.col("one_all") >= 0.7 * F.col("rows")),
        "too_wide": F.coalesce("c", "widest") > 50,
        "no_text": ~F.col("x"),
    }
    return j.select(F.col("_t").alias(table), F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in faults.items()]))).alias("fault"))


def box_faults(items: DataFrame, page: str, item: str, *, width: Column, height: Column, tolerance: float = 2.0) -> DataFrame:
    """Rules that items' boxes break, a row each: page, item, fault.

    items has box (x0, y0, x1, y1), kind and boundary. missing_box; out_of_bounds; duplicate_box: another item of the page
    has the very same; and of footnotes incomplete (boundary other than complete), high (starts above 55 % of the page) and
    tall (more than 35 % of it).
    """
    b = F.col("box")
    known = b.isNotNull() & (F.size(b) == 4)
    at = lambda k: F.when(known, b[k])
    t = items.withColumn("_same", F.count("*").over(Window.partitionBy(page, "box")))
    note = F.col("kind") == "footnote"
    faults = {
        "missing_box": ~F.coalesce(known, F.lit(False)),
        "out_of_bounds": (at(0) < -tolerance) | (at(1) < -tolerance) | (at(2) > width + tolerance) | (at(3) > height + tolerance),
        "duplicate_box": known & (F.col("_same") > 1),
        "incomplete": note & (F.col("boundary") != "complete"),
        "high": note & (at(1) < 0.55 * height),
        "tall": note & ((at(3) - at(1)) / height > 0.35),
    }
    return t.select(page, item, F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in faults.items()]))).alias("fault"))


def anchor_faults(anchors: DataFrame, units: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """What is wrong with the excerpts that candidates cite, a row each: candidate, place, fault.

    anchors has candidate, place (the given order), unit, excerpt and nth (which occurrence); units has unit, order and text.
    unknown_unit; absent: fewer occurrences; out_of_order: before the one ahead of it; overlap: begins inside the one ahead of
    it in the same unit. texts (candidate, text) must be the excerpts one after another with optional white space between:
    else text_differs, at place null.
    """
    from weft.functions.ids import occurrence_span

    u = units.select("unit", F.col("order").alias("_o"), F.col("text").alias("_t")).dropDuplicates(["unit"])
    j = anchors.join(u, "unit", "left").withColumn("_s", F.when(F.col("_t").isNotNull(), occurrence_span(F.col("_t"), F.col("excerpt"), F.col("nth"))))
    w = Window.partitionBy("candidate").orderBy("place")
    here = F.struct(F.col("_o").alias("o"), F.col("_s.start").alias("a"), F.col("_s.end").alias("b"))
    placed = F.when(F.col("_s").isNotNull(), here)
    j = j.withColumns({"_p": placed, "_q": F.lag(placed).over(w), "_before": F.lag("unit").over(w)})
    key = lambda c: F.struct(c["o"], c["a"], c["b"])
    overlap = (F.col("_before") == F.col("unit")) & (F.col("_p.a") < F.col("_q.b"))
    why = F.when(F.col("_t").isNull(), "unknown_unit").when(F.col("_s").isNull(), "absent").when(key(F.col("_p")) < key(F.col("_q")), "out_of_order").when(overlap, "overlap")
    out = j.withColumn("fault", why).where("fault is not null").select("candidate", "place", "fault")
    if texts is None:
        return out
    quoted = F.transform(F.array_sort(F.collect_list(F.struct("place", "excerpt"))), lambda x: F.concat(F.lit(r"\Q"), F.replace(F.trim(x["excerpt"]), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")))
    patterns = anchors.groupBy("candidate").agg(F.concat(F.lit(r"(?s)\A\s*"), F.array_join(quoted, r"\s*"), F.lit(r"\s*\z")).alias("_pattern"))
    differs = texts.join(patterns, "candidate").where(~F.rlike(F.coalesce("text", F.lit("")), F.col("_pattern")))
    return out.unionByName(differs.select("candidate", F.lit(None).cast(anchors.schema["place"].dataType).alias("place"), F.lit("text_differs").alias("fault")))


def source_order(segment: Column, row: Column, column: Column, start: Column, item: Column) -> Column:
    """A total order of items by where their source stands; unknown places come last, the item settles ties."""
    last = lambda c: F.coalesce(c.cast("long"), F.lit((1 << 62)))
    return F.struct(last(segment).alias("segment"), last(row).alias("row"), last(column).alias("column"), last(start).alias("start"), item.cast("string").alias("item"))


def neighbour_windows(members: DataFrame, windows: DataFrame, group: str, index: str, radius: int) -> DataFrame:
    """(group, index) of the windows there are within a radius of any member's window, each once."""
    reach = members.select(group, F.explode(F.sequence(F.col(index) - radius, F.col(index) + radius)).alias(index)).distinct()
    return reach.join(windows.select(index).distinct(), index).select(group, index)


def edge_item(items: DataFrame, page: str, *, bottom: bool, prefer: list[Column], top: str = "y0", low: str = "y1", item: str = "item") -> DataFrame:
    """The item of each page that stands lowest (bottom) or highest, after preferences: those that fulfil the first condition
    come before others, then by the second, and so on; then by edge, then the later or earlier item. A row for each page."""
    keys = [(~F.coalesce(c, F.lit(False))).cast("int") for c in prefer]
    order = [*keys, F.desc(low), F.desc(item)] if bottom else [*keys, F.col(top), F.col(item)]
    return items.withColumn("_k", F.row_number().over(Window.partitionBy(page).orderBy(*order))).where("_k = 1").drop("_k")


def flatten_windows(windows: DataFrame, doc: str, window: str, candidates: str) -> DataFrame:
    """Window-local candidates (an array of structs with local_id) as one table with a key each: doc, window, place, key, and
    the candidates' fields. A key is made of document, window and local id, or the place where there is none."""
    rows = windows.select(F.col(doc).alias("doc"), F.col(window).alias("window"), F.posexplode(candidates).alias("place", "c"))
    name = F.coalesce(F.col("c.local_id").cast("string"), F.concat(F.lit("#"), F.col("place").cast("string")))
    return rows.select("doc", "window", "place", F.concat_ws(":", F.col("doc").cast("string"), F.col("window").cast("string"), name).alias("key"), "c.*")


def signals_within(signals: DataFrame, members: DataFrame) -> DataFrame:
    """Signals that two or more members of one component share: component, kind, value, n, ids; a component's members are few.

    signals has kind, value and id; members id and component.
    """
    j = signals.select("kind", "value", "id").distinct().join(members.select("id", "component").distinct(), "id")
    return j.groupBy("component", "kind", "value").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("id")).alias("ids")).where("n >= 2")


def collapsed_tables(rows: DataFrame, table: str, width: Column, header: Column) -> DataFrame:
    """Tables that lost their columns: a header of three or more over a body whose median is 1 at most and mostly single cells;
    or more than 50 columns."""
    got = rows.groupBy(table).agg(F.max(F.when(header, width)).alias("h"), F.percentile(F.when(~header, width), F.lit(0.5)).alias("m"), F.avg(F.when(~header, (width == 1).cast("double"))).alias("single"), F.max(width).alias("widest"))
    why = F.when(F.col("widest") > 50, "too wide").when((F.col("h") >= 3) & (F.col("m") <= 1) & (F.col("single") >= 0.6), "collapsed")
    return got.withColumn("why", why).where("why is not null").select(table, "why")


def overlapping_anchors(anchors: DataFrame, group: list[str], ties: tuple[str, ...] = ()) -> DataFrame:
    """Anchors (start, end) that begin before the one ahead of them in their unit ends. ties order equal spans; without them
    it is open which of these comes first."""
    w = Window.partitionBy(*group).orderBy("start", "end", *ties)
    return anchors.withColumn("_e", F.lag("end").over(w)).where(F.col("start") < F.col("_e")).drop("_e")
