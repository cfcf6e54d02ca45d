"""Ordered carries and neighbours by window functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fill_down(df: DataFrame, value: str, group: list[str], order: list[str], out: str = "filled") -> DataFrame:
    """The last non-blank value at or above each row."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(F.when(F.trim(value) != "", F.col(value)), ignorenulls=True).over(w))


def heading_path(df: DataFrame, heading: str, group: list[str], order: list[str], most: int = 3) -> DataFrame:
    """The last few headings up to each row, without ones that repeat the one before: path (joined by " > ").

    Headings compare trimmed, single-spaced and folded; blank ones are none. Each row keeps a path of its own, also where
    rows are equal; rows that ``order`` doesn't tell apart go by the heading and then as they come.
    """
    text = F.when(F.trim(heading) != "", F.trim(heading))
    base = df.withColumn("_h", text).withColumn("_f", F.lower(F.regexp_replace("_h", r"\s+", " ")))
    placed = base.withColumn("_at", F.row_number().over(Window.partitionBy(*group).orderBy(*order, F.col("_f").asc_nulls_last())))
    w = Window.partitionBy(*group).orderBy("_at")
    so_far, earlier = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    new = placed.withColumn("_new", F.when(F.col("_f").isNotNull() & ~F.col("_f").eqNullSafe(F.last("_f", True).over(earlier)), F.col("_h")))
    # The k-th last new heading is the last one whose number leaves the same rest as the current count less k.
    out = new.withColumn("_no", F.count("_new").over(so_far))
    parts = []
    for k in range(most):
        out = out.withColumn(f"_r{k}", F.last(F.when(F.col("_new").isNotNull() & (F.col("_no") % most == k), F.struct("_no", "_new")), True).over(so_far))
        parts.append(f"_r{k}")
    path = F.array_join(F.transform(F.array_sort(F.array_compact(F.array(*parts))), lambda x: x["_new"]), " > ")
    return out.withColumn("path", path).select(*df.columns, "path")


def active_parent(df: DataFrame, level: str, item: str, group: list[str], order: list[str], levels: int) -> DataFrame:
    """For each row, the nearest earlier row of a smaller level that no still smaller level has closed: parent.

    One slot for each level holds its last row; a slot counts only if no row of a smaller level came after it.
    """
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    base = df.withColumn("_pos", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    parent = F.lit(None)
    for k in range(levels):
        base = base.withColumn(f"_id{k}", F.last(F.when(F.col(level) == k, F.col(item)), True).over(w)).withColumn(f"_at{k}", F.last(F.when(F.col(level) == k, F.col("_pos")), True).over(w))
        base = base.withColumn(f"_cut{k}", F.coalesce(F.last(F.when(F.col(level) < k, F.col("_pos")), True).over(w), F.lit(0)))
        parent = F.when((F.col(level) > k) & F.col(f"_id{k}").isNotNull() & (F.col(f"_at{k}") > F.col(f"_cut{k}")), F.col(f"_id{k}")).otherwise(parent)
    return base.withColumn("parent", parent).select(*df.columns, "parent")


def chunks(df: DataFrame, group: list[str], order: list[str], size: int = 20, overlap: int = 1) -> DataFrame:
    """Every row in each chunk of its group that holds it: chunk (from 0), first row, last row.

    Chunks start every size - overlap rows; one that would only repeat the end of the last isn't made.
    """
    step = size - overlap
    w = Window.partitionBy(*group)
    rows = df.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    count = F.greatest(F.lit(1), F.ceil((F.col("_n") - overlap) / step)).cast("int")
    first = F.greatest(F.lit(0), F.ceil((F.col("_i") - (size - 1)) / step)).cast("int")
    last = F.least(count - 1, F.floor(F.col("_i") / step).cast("int"))
    out = rows.withColumn("chunk", F.explode(F.sequence(first, last)))
    return out.withColumns({"chunk_first": F.col("chunk") * step, "chunk_last": F.least(F.col("chunk") * step + size, F.col("_n")).cast("int") - 1, "row_index": F.col("_i")}).drop("_i", "_n")


def carry_islands(df: DataFrame, code: str, broken: Column, group: list[str], order: list[str]) -> DataFrame:
    """A code carried forward within islands; a row where ``broken`` holds starts a new one: island, carried."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    marked = df.withColumn("_broken", F.coalesce(broken, F.lit(True)))
    marked = marked.withColumn("island", F.sum(F.col("_broken").cast("int")).over(w))
    inside = Window.partitionBy(*group, "island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("carried", F.last(code, True).over(inside)).drop("_broken")


def chains(df: DataFrame, linked: Column, group: list[str], order: list[str]) -> DataFrame:
    """Runs of rows that follow on each other: chain (from 1) and place in it (from 1). ``linked``: goes on from the row before."""
    w = Window.partitionBy(*group).orderBy(*order)
    marked = df.withColumn("_new", (~F.coalesce(linked, F.lit(False))).cast("int"))
    marked = marked.withColumn("chain", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
    return marked.withColumn("place", F.row_number().over(Window.partitionBy(*group, "chain").orderBy(*order)))


def preceding_band(df: DataFrame, group: list[str], order: str, child: Column, parent: Column, near: int = 8, far: int = 12) -> DataFrame:
    """Pairs of a child and every parent row at most ``far`` places before it: reason "preceding" within near, else "compatible".

    The band is an equi-join on blocks of ``far`` places: a parent's own block and the next.
    """
    children = df.where(child).select(*group, F.col(order).alias("c"), F.explode(F.array(F.floor(F.col(order) / far), F.floor(F.col(order) / far) - 1)).alias("_b"))
    parents = df.where(parent).select(*group, F.col(order).alias("p"), F.floor(F.col(order) / far).alias("_b"))
    both = children.join(parents, [*group, "_b"]).where((F.col("p") < F.col("c")) & (F.col("c") - F.col("p") <= far))
    return both.select(*group, "c", "p", F.when(F.col("c") - F.col("p") <= near, "preceding").otherwise("compatible").alias("reason"))


def jumps(df: DataFrame, x: str, y: str, group: list[str], order: list[str], up: float, aside: float) -> DataFrame:
    """Rows that lie more than ``up`` above the row before in the same column (less than ``aside`` away)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumns({"_y": F.lag(y).over(w), "_x": F.lag(x).over(w)}).where((F.col("_y") - F.col(y) > up) & (F.abs(F.col("_x") - F.col(x)) < aside)).drop("_x", "_y")
