"""Operator 6: secrets found by an incremental ledger of contents.

The base rules are the contract's; further ones find keys by the forms that services give them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.content import joined_back, unseen, with_digest
from weft.sources.scratch import exists, materialize

# The base rules. kind, pattern, group whose length counts, least length, a plain test that every match passes.
BASE = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, r"(?i:password|passwd|secret|token|api_?key)"),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, r"AKIA"),
    ("hex", r"[0-9a-f]{16,}", 0, 16, r"[0-9a-f]{16}"),
]
#: Further rules: forms that public services and standards give their keys.
FURTHER = [
    ("private_key", r"-----BEGIN [A-Z0-9 ]{0,30}PRIVATE KEY-----", 0, 27, r"-----BEGIN "),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30, r"eyJ[A-Za-z0-9_-]{8}"),
    ("forge_token", r"(?:gh[opsur]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{40,}|glpat-[A-Za-z0-9_-]{20,})", 0, 26, r"gh[opsur]_|github_pat_|glpat-"),
    ("chat_token", r"xox[abeoprs]-[A-Za-z0-9-]{10,}", 0, 15, r"xox[abeoprs]-"),
    ("service_key", r"(?:AIza[0-9A-Za-z_-]{35}|[rs]k_live_[0-9A-Za-z]{16,}|SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,})", 0, 24, r"AIza|k_live_|SG\."),
    ("url_password", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,100}:[^\s/:@]{3,200}@", 0, 11, r"://[^\s/:@]+:[^\s/:@]+@"),
]
RULES = [*BASE, *FURTHER]
#: Raised with every change of a rule; contents are scanned again by it under a new one. New rules need none.
RULE_VERSION = 2
LEDGER = "digest binary, rule string, version int, spans array<struct<start:int,end:int>>"


def spans_of(text: Column, pattern: str, group: int, least: int, test: str) -> Column:
    """Code-point spans of the leftmost non-overlapping matches whose group has the least length.

    The pieces between matches and the matches themselves alternate, so a running sum of their lengths gives each
    match its place. Failing matches take up their text like others, and are dropped.
    """
    p = F.lit(pattern)
    between = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    whole = F.transform(F.regexp_extract_all(text, p, F.lit(0)), lambda x: F.char_length(x))
    part = F.transform(F.regexp_extract_all(text, p, F.lit(group)), lambda x: F.char_length(x)) if group else whole
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + m["gap"]
        end = start + m["len"]
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(m["part"] >= least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    matches = F.zip_with(F.arrays_zip(whole.alias("len"), part.alias("part")), between, lambda m, g: F.struct(m["len"].alias("len"), m["part"].alias("part"), g.alias("gap")))
    found = F.aggregate(F.slice(matches, F.lit(1), F.size(whole)), zero, step)["out"]
    return F.when(text.rlike(test), found).otherwise(zero["out"])


def scan(contents: DataFrame, rules=None, version: int = RULE_VERSION) -> DataFrame:
    """Ledger rows: one for each content and rule, with its spans (none: an empty array). Contents may have a column ``done``
    with the rules that needn't be applied to them."""
    rules = rules or RULES
    wanted = (lambda kind: ~F.coalesce(F.array_contains("done", kind), F.lit(False))) if "done" in contents.columns else lambda kind: F.lit(True)
    found = F.array_compact(F.array(*[F.when(wanted(kind), F.struct(F.lit(kind).alias("rule"), F.lit(version).alias("version"), spans_of(F.col("text"), *rest).alias("spans"))) for kind, *rest in rules]))
    return contents.select("digest", F.explode(found).alias("f")).select("digest", "f.rule", "f.version", "f.spans")


def scan_secrets(docs: DataFrame, ledger: str, *, keys: tuple[str, ...] = ("doc_id",), rules=None, version: int = RULE_VERSION) -> DataFrame:
    """Findings of every whole text: the keys, digest and one array of spans for each rule.

    docs holds every historical version of every path: keys name its columns that say which (a document id, or path and
    commit), and text has the content; null contents count as empty. The ledger has one row for each content, rule and rule
    version that was scanned, with or without findings. Only pairs of content and rule that it lacks under this version are
    scanned, the new rows are appended in one commit, and all rows are joined back to every path with the content. Repeated
    and null keys keep a row each; empty tables give no rows. Only SQL functions run.
    """
    spark, rules = docs.sparkSession, rules or RULES
    kinds = [r[0] for r in rules]
    contents = with_digest(docs, *keys)
    stored = lambda: spark.read.schema(LEDGER).parquet(ledger).where((F.col("version") == version) & F.col("rule").isin(kinds))
    if exists(spark, ledger):
        done = stored().groupBy("digest").agg(F.collect_set("rule").alias("done"))
        fresh = unseen(contents, done.where(F.size("done") == len(kinds))).join(done, "digest", "left")
    else:
        fresh = unseen(contents, None)
    scan(fresh, rules, version).write.mode("append").parquet(ledger)
    own = materialize(contents.select(*keys, "digest"), "contents")
    wide = stored().groupBy("digest").agg(*[F.max(F.when(F.col("rule") == k, F.col("spans"))).alias(k) for k in kinds])
    return joined_back(own, wide).select(*keys, F.hex("digest").alias("digest"), *kinds)
