"""Labels and codes inside texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Label words of tables and figures.
TABLE_WORDS = ("jedwali", "tab", "tab.", "table", "tableau", "tbl", "tbl.")
FIGURE_WORDS = ("diagramme", "fig", "fig.", "figure", "kielelezo", "mchoro", "schéma")
#: Words for "number" that may stand before an identifier, as they are tried.
NUMBER_WORDS = (r"(?i)^no\.?\s*", r"(?i)^n\.?\s*")
#: Separators after a label.
SEPARATOR = r"^\s*[:.\-–—]\s*"


def leading_identifier(text: Column) -> Column:
    """What a text starts with: a number with parts joined by ".", "/" or "-", else a Roman numeral, else one letter; or ""."""
    numeral = F.regexp_extract(text, r"(?i)^M{0,3}(?:CM|CD|D?C{0,3})(?:XC|XL|L?X{0,3})(?:IX|IV|V?I{0,3})", 0)
    options = [F.regexp_extract(text, r"^[0-9]+(?:[./-][A-Za-z0-9]+)*", 0), numeral, F.regexp_extract(text, r"^[A-Za-z]", 0)]
    return F.coalesce(*[F.when(o != "", o) for o in options], F.lit(""))


def parse_caption(text: Column) -> Column:
    """(kind, prefix, identifier, rest) of a text that starts with a table's or figure's label; null otherwise.

    A label is a label word, longer ones first, perhaps a word for "number", and an identifier; the identifier is folded to
    lower case, and rest is what follows it and one separator. Nothing is asked of what follows an identifier, so the
    letter after a label word counts as one ("Tables 3" is table s): captions are known by their block type, not by this.
    """
    t = F.trim(F.coalesce(text, F.lit("")))
    labels = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(w).alias("word")) for kind, words in (("table", TABLE_WORDS), ("figure", FIGURE_WORDS)) for w in sorted(words, key=len, reverse=True)])
    begins = F.filter(labels, lambda x: F.lower(F.left(t, F.length(x["word"]))) == x["word"])

    def readings(x: Column) -> Column:
        after = F.ltrim(F.substr(t, F.length(x["word"]) + 1))
        starts = F.array(*[F.regexp_replace(after, n, "") for n in NUMBER_WORDS], after)
        named = F.transform(starts, lambda s: F.struct(s.alias("s"), leading_identifier(s).alias("name")))
        return F.transform(named, lambda n: F.struct(x["kind"].alias("kind"), F.left(t, F.length(x["word"])).alias("prefix"), F.lower(n["name"]).alias("identifier"), F.regexp_replace(F.substr(n["s"], F.length(n["name"]) + 1), SEPARATOR, "").alias("rest")))

    return F.get(F.filter(F.flatten(F.transform(begins, readings)), lambda r: r["identifier"] != ""), F.lit(0))


def local_code(text: Column) -> Column:
    """Comparable code of a caption: kind and identifier."""
    c = parse_caption(text)
    return F.when(c.isNotNull(), F.concat_ws(" ", c["kind"], c["identifier"]))


def comparable_code(code: Column) -> Column:
    """A stored code as it is compared: a caption's kind and identifier, else the folded code; null if blank."""
    plain = F.lower(F.trim(F.regexp_replace(code, r"\s+", " ")))
    return F.when(F.trim(code) != "", F.coalesce(local_code(code), plain))


def code_matches(df: DataFrame, text: str, families: dict[str, str]) -> DataFrame:
    """A row for each match of each family's pattern: family, code, start, end; columns of df stay, overlaps are kept."""
    rows = []
    for family, pattern in families.items():
        gaps = F.transform(F.split(F.col(text), pattern, -1), lambda x: F.char_length(x))
        hits = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))

        def place(acc: Column, m: Column) -> Column:
            start = acc["at"] + m["gap"]
            end = start + F.char_length(m["code"])
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(m["family"].alias("family"), m["code"].alias("code"), start.alias("start"), end.alias("end")))).alias("out"))

        both = _pairs(hits, gaps, family)
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<family:string,code:string,start:int,end:int>>").alias("out"))
        rows.append(F.aggregate(both, zero, place)["out"])
    return df.withColumn("_m", F.explode(F.array_distinct(F.concat(*rows)))).select(*df.columns, "_m.family", "_m.code", "_m.start", "_m.end")


def _pairs(hits: Column, gaps: Column, family: str) -> Column:
    def row(h: Column, g: Column) -> Column:
        return F.struct(F.lit(family).alias("family"), h.alias("code"), g.alias("gap"))

    return F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), row)


def code_family(declared: Column, matching: Column) -> Column:
    """The declared family if it is among the matching ones; without a declaration the only matching one; else null."""
    return F.when(declared.isNotNull(), F.when(F.array_contains(matching, declared), declared)).when(F.size(matching) == 1, matching[0])
