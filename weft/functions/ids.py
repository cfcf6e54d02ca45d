"""Identifiers that depend on content only."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: The public URL namespace of name-based identifiers.
URL_NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """Version 5 identifier of a name, from the SHA-1 of namespace and name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex((F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3)) + 8))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def pair_key(first: Column, second: Column, prefix: str = "pair") -> Column:
    """A name for two endpoints whatever their order."""
    a, b = first.cast("string"), second.cast("string")
    return F.concat_ws(":", F.lit(prefix), F.least(a, b), F.greatest(a, b))


def pair_id(first: Column, second: Column, prefix: str = "pair") -> Column:
    return uuid5(pair_key(first, second, prefix))


def short_hash(text: Column, n: int = 16) -> Column:
    """The first digits of the text's SHA-256."""
    return F.substring(F.sha2(text, 256), 1, n)


def bucket_id(kind: str, key: Column) -> Column:
    """Name of a group: its kind and the digest of its key."""
    return F.concat_ws(":", F.lit(kind), short_hash(key))


@pandas_udf(StringType())
def canonical_json(s):
    """JSON text with sorted keys, no spaces, no NaN; null where the input isn't JSON or holds NaN."""

    def one(x):
        try:
            return json.dumps(json.loads(x), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
        except (TypeError, ValueError):
            return None

    return s.map(one)


def content_hash(json_text: Column) -> Column:
    return F.sha2(canonical_json(json_text), 256)


def unit_id(segment: Column, kind: Column, index: Column, start: Column, end: Column) -> Column:
    """Position of a text unit as text; parse_unit_id takes it apart."""
    return F.concat_ws("|", segment, kind, index.cast("string"), start.cast("string"), end.cast("string"))


def parse_unit_id(unit: Column) -> Column:
    part = lambda k: F.split_part(unit, F.lit("|"), F.lit(k))
    return F.struct(part(1).alias("segment"), part(2).alias("kind"), part(3).cast("int").alias("index"), part(4).cast("int").alias("start"), part(5).cast("int").alias("end"))


def occurrence_span(text: Column, excerpt: Column, nth: Column) -> Column:
    """(start, end) of the nth (from 1) non-overlapping occurrence of an excerpt; null if there are fewer."""
    before = F.regexp_count(text, F.concat(F.lit(r"\Q"), excerpt, F.lit(r"\E")))
    start = F.char_length(F.call_function("substring_index", text, excerpt, nth.cast("int")))
    return F.when((F.char_length(excerpt) > 0) & (nth >= 1) & (before >= nth), F.struct(start.alias("start"), (start + F.char_length(excerpt)).alias("end")))
