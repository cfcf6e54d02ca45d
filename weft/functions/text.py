"""Text keys, tokens and grams as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

WORDS = r"(?U)\w+"
RUNS = r"(?U)[^\W_]+"


@pandas_udf(StringType())
def nfkc(s):
    """Unicode NFKC; there is no built-in for it. ASCII texts pass as they are."""
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))


@pandas_udf(StringType())
def nfkc_casefold(s):
    return s.map(lambda x: x if x is None else unicodedata.normalize("NFKC", x).casefold())


def collapse(text: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def document_key(text: Column) -> Column:
    """Comparison text of the document stage: NFKC, one space, lower case; null counts as empty."""
    return F.lower(collapse(F.coalesce(nfkc(text), F.lit(""))))


def graph_key(text: Column) -> Column:
    """Comparison text of the graph stage: NFKC and case folding, one space."""
    return collapse(nfkc_casefold(text))


def code_key(code: Column) -> Column:
    """Comparison code: NFKC, case folding, no white space, no punctuation at the ends."""
    return F.regexp_replace(F.regexp_replace(nfkc_casefold(code), r"(?U)\s+", ""), r"^[\p{P}]+|[\p{P}]+$", "")


def controlled_key(value: Column) -> Column:
    """Letters, digits and marks of the folded value; everything else is one space."""
    return F.trim(F.regexp_replace(nfkc_casefold(value), r"[^\p{L}\p{N}\p{M}]+", " "))


def skill_key(text: Column) -> Column:
    """Lower case, trimmed, single spaces, without trailing periods."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), r"\s+", " "), r"\.+$", ""))


def words(text: Column) -> Column:
    """Unicode word runs of the lower-cased text, underscore included."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0))


def alnum_runs(text: Column) -> Column:
    """Letter and digit runs of the folded text, without underscores."""
    return F.regexp_extract_all(nfkc_casefold(text), F.lit(RUNS), F.lit(0))


def grams(text: Column, n: int = 3) -> Column:
    """Distinct character n-grams; a shorter text is one gram, an empty one none."""
    return (
        F.when(F.length(text) == 0, F.array().cast("array<string>"))
        .when(F.length(text) <= n, F.array(text))
        .otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))))
    )


def inner_grams(text: Column, n: int = 3) -> Column:
    """Distinct n-grams that neither start nor end with a space."""
    return F.filter(grams(text, n), lambda g: g == F.trim(g))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two sets; 0 if both are empty."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def overlap(a: Column, b: Column) -> Column:
    """Exact fraction as two integers: common and all elements."""
    return F.struct(F.size(F.array_intersect(a, b)).cast("long").alias("common"), F.size(F.array_union(a, b)).cast("long").alias("total"))


def fold_affixes(token: Column, prefixes: list[str], suffixes: list[str], least: int = 5) -> Column:
    """Without the first prefix that leaves two letters or more, and then the first suffix, if least letters are there."""
    out = None
    for a in prefixes:
        fits = token.startswith(a) & (F.length(token) > len(a) + 1)
        rest = F.substring(token, len(a) + 1, 1 << 30)
        out = F.when(fits, rest) if out is None else out.when(fits, rest)
    token = token if out is None else out.otherwise(token)
    out = None
    for a in suffixes:
        fits = token.endswith(a) & (F.length(token) >= least)
        rest = F.left(token, F.length(token) - len(a))
        out = F.when(fits, rest) if out is None else out.when(fits, rest)
    return token if out is None else out.otherwise(token)


def join_units(units: Column, repair_hyphens: bool = True) -> Column:
    """Text units in one: a trailing hyphen before a lower-case letter is repaired, a line ends after a sentence, else a space."""
    fixed = F.filter(F.transform(units, lambda u: F.trim(u)), lambda u: u != "")

    def step(acc: Column, u: Column) -> Column:
        plain = F.when(acc.rlike(r"[.!?:]$"), F.concat(acc, F.lit("\n"), u)).otherwise(F.concat(acc, F.lit(" "), u))
        if repair_hyphens:
            plain = F.when(acc.rlike(r"\p{L}-$") & u.rlike(r"^\p{Ll}"), F.concat(F.left(acc, F.length(acc) - 1), u)).otherwise(plain)
        return F.when(acc == "", u).otherwise(plain)

    return F.aggregate(fixed, F.lit(""), step)


def unique_nonempty(values: Column, limit: int | None = None) -> Column:
    """Distinct non-blank strings in order of first appearance, perhaps only the first few."""
    out = F.array_distinct(F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v.isNotNull() & (v != "")))
    return F.slice(out, 1, limit) if limit else out


def redact_tokens(text: Column, pattern: str = r"(?i)(token|key|secret)=[^&\s]+") -> Column:
    """Values of named credentials masked."""
    return F.regexp_replace(text, pattern, "$1=***")


def language_base(tag: Column) -> Column:
    """Base subtag of a language tag, underscores accepted, lower case."""
    return F.lower(F.split_part(F.replace(tag, F.lit("_"), F.lit("-")), F.lit("-"), F.lit(1)))


def bounded_text(text: Column, most: int) -> Column:
    """An excerpt with the whole text's length and digest."""
    return F.struct(F.substring(text, 1, most).alias("excerpt"), F.length(text).cast("long").alias("length"), F.sha2(text, 256).alias("sha256"))


def truncate(text: Column, most: int) -> Column:
    """At most so many characters, the last one an ellipsis if any were cut."""
    return F.when(F.length(text) > most, F.concat(F.rtrim(F.substring(text, 1, most - 1)), F.lit("…"))).otherwise(text)


def common_prefix(a: Column, b: Column) -> Column:
    """Longest run of equal leading elements of two arrays."""
    same = F.sequence(F.lit(1), F.least(F.size(a), F.size(b)))
    found = F.filter(same, lambda n: F.slice(a, F.lit(1), n) == F.slice(b, F.lit(1), n))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.slice(a, F.lit(1), F.lit(0))).otherwise(F.slice(a, F.lit(1), F.coalesce(F.array_max(found), F.lit(0))))


def closest_gap(a: Column, b: Column) -> Column:
    """Smallest distance between an element of one integer array and one of the other."""
    return F.array_min(F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.abs(x - y)))))


def row_signature(cells: Column) -> Column:
    """Normalised texts of a row's cells."""
    return F.transform(cells, lambda c: F.lower(collapse(F.coalesce(c, F.lit("")))))


def bool_text(value: Column) -> Column:
    """Booleans on the wire: "true" and "false"."""
    return value.cast("string")


def nonblank(text: Column) -> Column:
    """The text, or null if it is blank."""
    return F.when(F.trim(text) != "", text)
