"""Tables with spans and stitched slices."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def grid_of(rows: list[list[tuple[str, int, int]]]) -> list[tuple[int, int, str, int, int]]:
    """(row, column, text, source row, source cell) of ragged rows of (text, row span, column span).

    A cell takes the first free column at or after the end of the one before it; a span that would leave the table below is
    cut at its end. A span that runs into a cell from above is an error, as two texts can't have one place.
    """
    taken: dict[tuple[int, int], tuple[str, int, int]] = {}
    for r, cells in enumerate(rows):
        c = 0
        for k, (text, down, across) in enumerate(cells):
            while (r, c) in taken:
                c += 1
            for y in range(min(down, len(rows) - r)):
                for x in range(across):
                    if (r + y, c + x) in taken:
                        raise ValueError(f"cells overlap at row {r + y}, column {c + x}")
                    taken[r + y, c + x] = (text, r, k)
            c += across
    return [(r, c, *v) for (r, c), v in sorted(taken.items())]


def expand_grid(cells: DataFrame, table: str) -> DataFrame:
    """Long form of tables' grids: table, row, col, text, source_row, source_cell.

    cells has table, row, cell, text, row_span and col_span, spans at least 1. Placing a cell depends on all before it in its
    table, so a task holds one table at a time; tables come from pages and are small. Overlapping spans are an error. Null
    tables are one table.
    """
    kind = cells.schema[table].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        here, rows, out = None, [], []

        def placed():
            if rows:
                out.extend((here[0], *x) for x in grid_of(rows))

        def made():
            cols = list(zip(*out, strict=True)) or [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kinds), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int32()), pa.array(cols[5], pa.int32())], [table, "row", "col", "text", "source_row", "source_cell"])

        for b in batches:
            kinds = b.column(0).type
            for t, r, text, down, across in zip(*[b.column(k).to_pylist() for k in range(5)], strict=True):
                if here is None or here[0] != t:
                    placed()
                    here, rows = (t,), []
                while len(rows) <= r:
                    rows.append([])
                rows[r].append((text, max(1, int(down or 1)), max(1, int(across or 1))))
            if len(out) > 50_000:
                yield made()
                out.clear()
        placed()
        if out:
            yield made()

    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.select(table, "row", "cell", "text", "row_span", "col_span").repartition(n, table).sortWithinPartitions(table, "row", "cell")
    return dealt.select(table, "row", "text", "row_span", "col_span").mapInArrow(run, f"{table} {kind}, row int, col int, text string, source_row int, source_cell int")


def column_signature(rows: Column, header_rows: Column, strong: bool) -> Column:
    """Texts of all header rows (strong) or the first one (weak) as one comparable string."""
    take = F.greatest(header_rows, F.lit(1)) if strong else F.lit(1)
    return F.array_join(F.transform(F.slice(rows, F.lit(1), take), lambda r: F.array_join(F.transform(r, lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))), "|")), "||")


def header_score(cells: Column) -> Column:
    """How much a row looks like a header: the shares of Latin letters and of digits among its characters other than white
    space, and of filled cells among its cells; 0 for a row without text."""
    text = F.array_join(F.filter(F.transform(cells, lambda c: F.trim(F.coalesce(c, F.lit("")))), lambda c: c != ""), " ")
    n = F.greatest(F.length(F.regexp_replace(text, r"(?U)\s+", "")), F.lit(1))
    filled = F.size(F.filter(cells, lambda c: F.trim(F.coalesce(c, F.lit(""))) != "")) / F.greatest(F.size(cells), F.lit(1))
    score = 2.0 * F.regexp_count(text, F.lit("[A-Za-zÀ-ÖØ-öø-ÿ]")) / n + filled - 1.5 * F.regexp_count(text, F.lit(r"\p{Nd}")) / n
    return F.when(text == "", 0.0).otherwise(score)


def header_rows(rows: DataFrame, table: str, order: str, cells: str, *, least: float = 1.15, most: int = 3) -> DataFrame:
    """Leading rows (at most three) that score as a header, with a confidence: table, n_header, confidence."""
    first = rows.withColumn("_i", F.row_number().over(Window.partitionBy(table).orderBy(order))).where(F.col("_i") <= most).withColumn("_s", header_score(F.col(cells)))
    stop = first.groupBy(table).agg(F.coalesce(F.min(F.when(F.col("_s") < least, F.col("_i"))), F.max("_i") + 1).alias("_stop"))
    run = first.join(stop, table).where(F.col("_i") < F.col("_stop")).groupBy(table).agg(F.count("*").alias("n_header"), F.avg("_s").alias("_avg"))
    grown = F.least(F.lit(1.0), 0.55 + 0.15 * (F.col("n_header") - 1) + 0.20 * F.greatest(F.lit(0.0), F.col("_avg") - least))
    return stop.select(table).join(run, table, "left").select(table, F.coalesce("n_header", F.lit(0)).alias("n_header"), F.when(F.col("n_header").isNull(), 0.0).otherwise(F.round(grown, 6)).alias("confidence"))


def stitch_rows(slices: DataFrame, chain: str, place: str, rows: str, header: str, repeats: str, declared: str | None = None) -> DataFrame:
    """Rows of a chain's slices in order, repeated headers left out: chain, row, cells, slice, source_row.

    A later slice loses its leading rows only if they equal the first slice's header row by row: the whole header unless its
    flag (repeats) denies it, or, where the flag affirms it, as many rows as the slice itself declares (column declared,
    fewer than the header has). A slice that declares a number other than the header's is held against the smaller one.
    rows is an array of arrays of texts, header the first slice's number of header rows.
    """
    w = Window.partitionBy(chain).orderBy(place)
    sig = lambda r: F.transform(r, lambda row: F.transform(row, lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))))
    own = F.coalesce(F.col(declared), F.lit(0)) if declared else F.lit(0)
    s = slices.withColumns({"_base": F.first(rows).over(w), "_h": F.first(header).over(w), "_no": F.row_number().over(w), "_own": own})
    k = F.when(F.col("_own") > 0, F.least("_h", "_own")).otherwise(F.col("_h"))
    same = (k > 0) & (F.size(rows) >= k) & (sig(F.slice(rows, F.lit(1), k)) == sig(F.slice(F.col("_base"), F.lit(1), k)))
    drop = F.when((F.col("_no") > 1) & same & F.coalesce(F.col(repeats), F.lit(True)), k).otherwise(0)
    s = s.withColumn("_drop", drop).withColumn("_before", F.coalesce(F.sum(F.size(rows) - F.col("_drop")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = s.select(chain, F.col(place).alias("slice"), "_drop", "_before", F.posexplode(rows).alias("source_row", "cells")).where(F.col("source_row") >= F.col("_drop"))
    return out.select(chain, (F.col("_before") + F.col("source_row") - F.col("_drop")).cast("int").alias("row"), "cells", "slice", "source_row")


def stitch_tables(slices: DataFrame, chain: str, place: str, *, least: float = 0.65) -> tuple[DataFrame, DataFrame]:
    """(rows of stitched tables as stitch_rows() gives them, one row for each table).

    slices has rows, header, repeats and code. A first slice that declares no header gets the number of rows that look like
    one, if header_rows() is that sure. A table's code is the first slice's that has one; conflict tells whether a later
    slice has another one, compared as captions. n_slices, n_rows and n_header go with it.
    """
    from weft.functions.codes import comparable_code

    w = Window.partitionBy(chain).orderBy(place)
    first = slices.withColumn("_no", F.row_number().over(w)).where("_no = 1")
    leading = first.select(chain, F.posexplode_outer("rows").alias("_i", "_cells")).where("_cells is not null")
    guessed = header_rows(leading, chain, "_i", "_cells").where(F.col("confidence") >= least).select(chain, "n_header")
    resolved = first.join(guessed, chain, "left").select(chain, F.when(F.coalesce("header", F.lit(0)) > 0, F.col("header")).otherwise(F.coalesce("n_header", "header", F.lit(0))).alias("n_header"))
    s = slices.join(resolved, chain).withColumn("_code", comparable_code(F.col("code")))
    rows = stitch_rows(s.withColumn("_declared", F.coalesce("header", F.lit(0))), chain, place, "rows", "n_header", "repeats", "_declared")
    coded = F.struct(F.col(place).alias("at"), F.trim("code").alias("code"), "_code")
    tables = s.groupBy(chain).agg(F.count("*").alias("n_slices"), F.max("n_header").alias("n_header"), F.min(F.when(F.col("_code").isNotNull(), coded)).alias("_c"), F.count_distinct("_code").alias("_n"))
    counts = rows.groupBy(chain).agg(F.count("*").alias("n_rows"))
    tables = tables.join(counts, chain, "left").select(chain, "n_slices", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "n_header", F.col("_c.code").alias("code"), (F.col("_n") > 1).alias("conflict"))
    return rows, tables


def stitch_blocks(slices: DataFrame, chain: str, place: str, *, repair_hyphens: bool = True) -> DataFrame:
    """One row for each chain of block slices: text folded from the slices', list items one after another, the first figure
    and code there is, language ("mul" where texts differ in it), the first slice's block type, n_slices.

    slices has text, language, items (array of texts), figure, code and block_type.
    """
    from weft.functions.text import join_units

    parts = F.array_sort(F.collect_list(F.struct(F.col(place).alias("at"), "text", "language", "items", "figure", "code", "block_type")))
    s = slices.groupBy(chain).agg(parts.alias("s"))
    first = lambda test, name: F.element_at(F.transform(F.filter("s", test), lambda x: x[name]), 1)
    some = lambda name: F.try_element_at(F.transform(F.filter("s", lambda x: F.trim(F.coalesce(x[name], F.lit(""))) != ""), lambda x: F.trim(x[name])), F.lit(1))
    texts = F.filter("s", lambda x: x["text"].isNotNull())
    languages = F.array_distinct(F.transform(texts, lambda x: x["language"]))
    return s.select(
        chain,
        F.when(F.size(texts) > 0, join_units(F.transform(texts, lambda x: x["text"]), repair_hyphens)).alias("text"),
        F.when(F.size(languages) > 1, F.lit("mul")).otherwise(F.try_element_at(languages, F.lit(1))).alias("language"),
        F.flatten(F.transform("s", lambda x: F.coalesce(x["items"], F.array().cast("array<string>")))).alias("items"),
        some("figure").alias("figure"),
        some("code").alias("code"),
        first(lambda x: x["at"].isNotNull(), "block_type").alias("block_type"),
        F.size("s").alias("n_slices"),
    )


def pad_rows(rows: DataFrame, table: str, cells: str, *, header: str | None = None, width: str | None = None, synthetic: str | None = None) -> DataFrame:
    """Rows filled up with empty cells to their table's width (column width; default its widest row's).

    On the left if the header (rows for which the column header is true) has a row as wide as the table, or if at least three
    full rows below it, whose first cell isn't made up (column synthetic), have at least 60 % blank first cells; else on the
    right. Wider rows stay as they are.
    """
    w = Window.partitionBy(table)
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)) if c else F.lit(False)
    r = rows.withColumns({"_w": F.col(width) if width else F.max(F.size(cells)).over(w), "_head": flag(header), "_made": flag(synthetic)})
    headed = F.max(F.when(F.col("_head"), F.size(cells))).over(w) == F.col("_w")
    full = ~F.col("_head") & ~F.col("_made") & (F.size(cells) >= F.col("_w")) & (F.size(cells) > 0)
    n_full = F.sum(full.cast("int")).over(w)
    blank = F.sum((full & (F.trim(F.coalesce(F.get(F.col(cells), F.lit(0)), F.lit(""))) == "")).cast("int")).over(w)
    fill = F.array_repeat(F.lit(""), F.greatest(F.lit(0), F.col("_w") - F.size(cells)).cast("int"))
    left = F.coalesce(headed, F.lit(False)) | ((n_full >= 3) & (blank >= n_full * 0.6))
    return r.withColumn("_left", left).withColumn(cells, F.when(F.col("_left"), F.concat(fill, F.col(cells))).otherwise(F.concat(F.col(cells), fill))).select(*rows.columns)


def blank_cells(cells: Column) -> Column:
    """Cells that are blank or hold a dash only as empty texts."""
    return F.transform(cells, lambda c: F.when(F.trim(F.coalesce(c, F.lit(""))).rlike(r"^[-–—\s]*$"), F.lit("")).otherwise(F.trim(c)))


def fold_flags(items: DataFrame, edges: DataFrame, least: float) -> DataFrame:
    """Boundary of each item after verdicts (prev_id, next_id, continues, confidence): complete, truncated, resumed or both.

    A verdict of enough confidence sets or clears the outgoing side of the one and the incoming side of the other item;
    sides without one keep their value. items has id and boundary.
    """
    e = edges.where(F.col("confidence") >= least)
    out = e.groupBy(F.col("prev_id").alias("id")).agg(F.max("continues").alias("_out"))
    into = e.groupBy(F.col("next_id").alias("id")).agg(F.max("continues").alias("_in"))
    j = items.join(out, "id", "left").join(into, "id", "left")
    o = F.coalesce("_out", F.col("boundary").isin("truncated", "both"))
    i = F.coalesce("_in", F.col("boundary").isin("resumed", "both"))
    return j.withColumn("boundary", F.when(o & i, "both").when(o, "truncated").when(i, "resumed").otherwise("complete")).drop("_out", "_in")


def html_cells(pages: DataFrame, page: str, html: str) -> DataFrame:
    """Cells of the tables in pages' HTML: page, table, row, cell, text, row_span, col_span."""
    from html.parser import HTMLParser

    class Cells(HTMLParser):
        def __init__(self) -> None:
            super().__init__()
            self.rows: list[tuple] = []
            self.table, self.row, self.cell, self.text, self.spans = -1, -1, -1, None, (1, 1)

        def close_cell(self) -> None:
            if self.text is not None:
                self.rows.append((self.table, self.row, self.cell, " ".join("".join(self.text).split()), *self.spans))
                self.text = None

        def handle_starttag(self, tag, attrs):
            if tag == "table":
                self.close_cell()
                self.table, self.row = self.table + 1, -1
            elif tag == "tr" and self.table >= 0:
                self.close_cell()
                self.row, self.cell = self.row + 1, -1
            elif tag in ("td", "th") and self.table >= 0 and self.row >= 0:
                self.close_cell()
                span = {k: int(v) if (v or "").isdigit() else 1 for k, v in attrs if k in ("rowspan", "colspan")}
                self.cell, self.text = self.cell + 1, []
                self.spans = max(1, span.get("rowspan", 1)), max(1, span.get("colspan", 1))

        def handle_endtag(self, tag):
            if tag in ("td", "th", "tr", "table"):
                self.close_cell()

        def handle_data(self, data):
            if self.text is not None:
                self.text.append(data)

    def run(batches: Iterator):
        import pyarrow as pa

        for b in batches:
            out = []
            for i, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                p = Cells()
                p.feed(h or "")
                p.close_cell()
                out += [{"page": i, "table": t, "row": r, "cell": c, "text": x, "row_span": d, "col_span": a} for t, r, c, x, d, a in p.rows]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("page", pa.int64()), *[(k, pa.int32()) for k in ("table", "row", "cell")], ("text", pa.string()), ("row_span", pa.int32()), ("col_span", pa.int32())]))

    return pages.select(F.col(page).cast("long"), html).mapInArrow(run, "page long, table int, row int, cell int, text string, row_span int, col_span int")
