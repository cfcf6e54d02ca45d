"""Readers and writers of JSON artifacts, documents and page texts."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.functions.ids import short_hash


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A .json document or .jsonl rows, by extension; anything else is an error, and so are malformed rows."""
    if not path.endswith((".json", ".jsonl")):
        raise ValueError(f"neither .json nor .jsonl: {path}")
    reader = spark.read.option("multiLine", path.endswith(".json")).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def write_json(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Overwrite a folder of JSON lines, sorted within files if an order is given."""
    out = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    out.write.mode("overwrite").json(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed JSON lines; repeated keys of an object and malformed rows end the read."""

    def lines(batches):
        import pyarrow as pa

        def unique(pairs):
            keys = [k for k, _ in pairs]
            if len(keys) != len(set(keys)):
                raise ValueError(f"repeated key in {keys}")
            return dict(pairs)

        for b in batches:
            for x in b.column(0).to_pylist():
                json.loads(x, object_pairs_hook=unique)
            yield pa.RecordBatch.from_arrays([b.column(0)], ["value"])

    checked = spark.read.text(path).where("trim(value) <> ''").mapInArrow(lines, "value string")
    return checked.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_valid_prefix(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines before the first malformed one, in the order of files' names and of lines in a file."""
    line = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s"), F.monotonically_increasing_id().alias("i"))
    rows = spark.read.text(path).select("value", line.alias("_at"))
    parsed = rows.withColumn("_r", F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = parsed.where("_r is null or _r._bad is not null").agg(F.min("_at").alias("_stop"))
    return parsed.join(F.broadcast(bad)).where("_stop is null or _at < _stop").orderBy("_at").select("_r.*").drop("_bad")


def document_keys(spark: SparkSession, path: str, n: int = 16) -> DataFrame:
    """path and content key of each file."""
    return spark.read.format("binaryFile").load(path).select("path", F.substring(F.sha2("content", 256), 1, n).alias("doc_key"))


def png_size(content: Column) -> Column:
    """Width and height in a PNG's header."""
    part = lambda a: F.conv(F.hex(F.substring(content, a, 4)), 16, 10).cast("int")
    return F.struct(part(17).alias("width"), part(21).alias("height"))


def page_range(n: int, start: int | None, end: int | None) -> tuple[int, int]:
    """A page range, by default all; one that leaves the document is an error."""
    a, b = start if start is not None else 1, end if end is not None else n
    if not 1 <= a <= b <= n:
        raise ValueError(f"pages {a} to {b} of {n}")
    return a, b


def text_gate(text: Column) -> Column:
    """Why a page's text layer is of no use: short, replaced or unprintable; null if it is fine."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)
    share = lambda p: F.regexp_count(t, F.lit(p)) / F.greatest(n, F.lit(1))
    return F.when(F.length(F.trim(t)) < 20, "short").when(share("�") > 0.02, "replaced").when(share(r"[\p{L}\p{N}\p{P}\p{S}\p{Z}\s]") < 0.9, "unprintable")


def freeze(df: DataFrame, path: str, key: str) -> DataFrame:
    """Write a versioned copy with a digest for each row; returns the manifest (key, digest)."""
    rows = df.withColumn("_digest", F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256))
    rows.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path).select(key, F.col("_digest").alias("digest"))


def altered(spark: SparkSession, path: str, manifest: DataFrame, key: str) -> DataFrame:
    """Keys of a frozen copy that no longer match its manifest."""
    rows = spark.read.parquet(path)
    now = rows.drop("_digest")
    got = now.select(key, F.sha2(F.to_json(F.struct(*sorted(now.columns))), 256).alias("digest"))
    return got.join(manifest, [key, "digest"], "left_anti").select(key).union(manifest.join(got, [key, "digest"], "left_anti").select(key)).distinct()


def name_agrees(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't the one in their file's name."""
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.[^./]+$", 1)
    return df.withColumn("_f", name).where(F.col("_f") != F.col(key).cast("string")).drop("_f")


def wire(df: DataFrame) -> DataFrame:
    """All columns as text; booleans are "true" and "false"."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows with an id of their content."""
    return df.withColumn("row_id", short_hash(F.to_json(F.struct(*df.columns)))).orderBy(*order)


def latest(df: DataFrame, key: list[str], order: Column) -> DataFrame:
    """The last version of each key."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*key).orderBy(order.desc()))).where("_k = 1").drop("_k")


def discover_runs(spark: SparkSession, root: str, required: list[str], pattern: str = "*.json*") -> DataFrame:
    """Folders below a root that hold artifacts: run (path below the root), status, missing, alias_of.

    status: complete (all required names are there), partial (some) or skipped (none); missing lists the required names that
    aren't there. alias_of is the first run, by name, with the same complete set of required contents. One row for each
    folder with a file of the pattern.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    base = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    top = root.rstrip("/").split("://")[-1].split(":", 1)[-1]
    rows = files.select(base.alias("folder"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.sha2("content", 256).alias("digest"))
    rows = rows.withColumn("run", F.when(F.col("folder").endswith(top), F.lit(".")).otherwise(F.substring_index("folder", f"{top}/", -1)))
    wanted = F.array(*map(F.lit, required))
    got = rows.groupBy("run").agg(F.collect_set(F.when(F.col("name").isin(required), F.col("name"))).alias("have"), F.sort_array(F.collect_list(F.when(F.col("name").isin(required), F.struct("name", "digest")))).alias("content"))
    got = got.withColumn("missing", F.array_sort(F.array_except(wanted, "have")))
    status = F.when(F.size("missing") == 0, "complete").when(F.size("have") > 0, "partial").otherwise("skipped")
    got = got.withColumn("status", status).withColumn("key", F.when(F.col("status") == "complete", F.sha2(F.to_json("content"), 256)).otherwise(F.col("run")))
    first = F.min("run").over(Window.partitionBy("key"))
    return got.withColumn("first", first).select("run", "status", "missing", F.when(F.col("first") != F.col("run"), F.col("first")).alias("alias_of"))


def evaluation_population(requests: DataFrame, edges: DataFrame) -> DataFrame:
    """Request rows (item and more) with their sorted components (edges: component, item); those without any are left out."""
    sets = edges.groupBy("item").agg(F.sort_array(F.collect_set("component")).alias("components"))
    return requests.join(sets, "item")


#: Rows of a sheet; a report is read by people, and Excel has no more.
SHEET_ROWS = 1_048_575


def _cells(df: DataFrame) -> tuple[list[str], list[tuple]]:
    rows = df.limit(SHEET_ROWS + 1).collect()
    if len(rows) > SHEET_ROWS:
        raise ValueError("a report table has more rows than a sheet holds")
    return df.columns, [tuple(r) for r in rows]


def html_report(tables: dict[str, DataFrame], title: str) -> str:
    """One self-contained page with a heading and a table for each of a few small tables."""
    from html import escape

    out = [f"<!doctype html><html><head><meta charset='utf-8'><title>{escape(title)}</title></head><body><h1>{escape(title)}</h1>"]
    for name, df in tables.items():
        columns, rows = _cells(df)
        line = lambda cells, tag: "<tr>" + "".join(f"<{tag}>{escape('' if c is None else str(c))}</{tag}>" for c in cells) + "</tr>"
        out += [f"<h2>{escape(name)}</h2><table>", line(columns, "th"), *[line(r, "td") for r in rows], "</table>"]
    return "".join([*out, "</body></html>"])


def workbook(tables: dict[str, DataFrame]) -> bytes:
    """An Excel workbook with a sheet for each of a few small tables: the fewest parts the format allows."""
    import io
    import zipfile
    from xml.sax.saxutils import escape, quoteattr

    ns, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pack = "http://schemas.openxmlformats.org/package/2006"
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'

    def cell(v) -> str:
        if isinstance(v, (int, float)) and not isinstance(v, bool) and v == v and abs(v) != float("inf"):
            return f"<c><v>{v}</v></c>"
        clean = "".join(c for c in ("" if v is None else str(v)) if c >= " " or c in "\t\n\r")
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(clean)}</t></is></c>'

    sheets, parts = [], {}
    for k, (name, df) in enumerate(tables.items(), 1):
        columns, rows = _cells(df)
        body = "".join("<row>" + "".join(map(cell, r)) + "</row>" for r in [tuple(columns), *rows])
        parts[f"xl/worksheets/sheet{k}.xml"] = f'{head}<worksheet xmlns="{ns}"><sheetData>{body}</sheetData></worksheet>'
        sheets.append(f'<sheet name={quoteattr(name[:31])} sheetId="{k}" r:id="rId{k}"/>')
    kinds = "".join(f'<Override PartName="/{p}" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for p in parts)
    links = "".join(f'<Relationship Id="rId{k}" Type="{rel}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
    parts["xl/workbook.xml"] = f'{head}<workbook xmlns="{ns}" xmlns:r="{rel}"><sheets>{"".join(sheets)}</sheets></workbook>'
    parts["xl/_rels/workbook.xml.rels"] = f'{head}<Relationships xmlns="{pack}/relationships">{links}</Relationships>'
    parts["_rels/.rels"] = f'{head}<Relationships xmlns="{pack}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>'
    book = '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    parts["[Content_Types].xml"] = f'{head}<Types xmlns="{pack}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>{book}{kinds}</Types>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name in ["[Content_Types].xml", *[p for p in parts if p != "[Content_Types].xml"]]:
            z.writestr(name, parts[name])
    return out.getvalue()
