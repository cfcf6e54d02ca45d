"""Operator 10: mixing by iterative proportional fitting, in DataFrame operations only.

The token sums of all (source, language, topic) cells are scaled, one dimension after another, until their totals meet
the target shares of each source, language and topic. A cell's raked share of the token budget over the tokens it has is
the probability with which each of its documents is sampled.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.sources.scratch import materialize, remove_table

DIMENSIONS = ("source", "lang", "topic")
#: Cells that are broadcast to the documents; with more, the join is shuffled.
BROADCAST_CELLS = 100_000


def estimated_tokens(text: Column) -> Column:
    """A quarter of the characters, 1 at least."""
    return F.greatest(F.lit(1), F.ceil(F.coalesce(F.char_length(text), F.lit(0)) / 4)).cast("long")


def form(text: Column) -> Column:
    """A topic for documents that have no such column: the form of the text, from its length, line ends and marks."""
    text = F.coalesce(text, F.lit(""))
    n = F.char_length(text)
    count = lambda c: n - F.char_length(F.replace(text, F.lit(c), F.lit("")))
    return F.when(n < 600, "brief").when(count("|") * 40 > n, "table").when(count("\n") * 120 > n, "lines").when(n >= 8000, "long").otherwise("prose")


def flattened_targets(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(value, share) with shares in proportion to the present ones to a power; under 1 lifts what is rare."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").cast("double").alias("s"))
    raised = sums.select("value", F.pow("s", F.lit(power)).alias("s"))
    total = raised.agg(F.sum("s")).first()[0] or 1.0
    return raised.select("value", (F.col("s") / F.lit(total)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], *, rounds: int = 12, tolerance: float = 0.0) -> DataFrame:
    """cells with raked: shares of 1 whose totals in each dimension meet the targets.

    Each round scales every dimension once and is written to the shared folder. It ends after ``rounds``, or once all
    totals lie within the tolerance. Values without a target, or with one of 0, get nothing; targets of values that
    don't occur are spread over the others.
    """
    now = cells.withColumn("raked", F.col("tokens").cast("double"))
    for d in DIMENSIONS:
        t = targets[d].select(F.col("value").alias(d), F.col("share").alias(f"want_{d}"))
        now = now.join(t, d, "left").withColumn(f"want_{d}", F.coalesce(f"want_{d}", F.lit(0.0)))
    now = materialize(now, "rake")
    for k in range(rounds):
        step = now
        for d in DIMENSIONS:
            step = step.withColumn("raked", F.when(F.col(f"want_{d}") > 0, F.col("raked") * F.col(f"want_{d}") / F.sum("raked").over(Window.partitionBy(d))).otherwise(0.0))
        step = materialize(step, "rake")
        remove_table(now)
        now = step
        if tolerance and k + 1 < rounds:
            off = [now.groupBy(d).agg(F.abs(F.sum("raked") - F.max(f"want_{d}")).alias("off")) for d in DIMENSIONS[:-1]]
            if off[0].unionByName(off[1], allowMissingColumns=True).agg(F.max("off")).first()[0] <= tolerance:
                break
    return now.drop(*[f"want_{d}" for d in DIMENSIONS])


def filled(rows: DataFrame, group: list[str], weight: str, most: str, want: Column) -> DataFrame:
    """rows with each group's weights times one factor, so that they add up to want when each is cut at most.

    Taken by most / weight, rows reach their bound one after another; the factor is that of the first row which the rest
    of want doesn't bring to its bound. Where all bounds add up to less than want, every row reaches its own.
    """
    ratio = F.col(most) / F.col(weight)
    w = Window.partitionBy(*group)
    ahead = F.coalesce(F.sum(most).over(w.orderBy("_ratio", "_tie").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum(weight).over(w.orderBy("_ratio", "_tie").rowsBetween(0, Window.unboundedFollowing))
    got = rows.where(F.col(weight) > 0).withColumn("_ratio", ratio).withColumn("_tie", F.xxhash64(*rows.columns)).withColumn("_f", (want - ahead) / rest)
    factor = F.coalesce(F.max(F.when(F.col("_f") <= F.col("_ratio"), F.col("_f"))).over(w), F.max("_ratio").over(w))
    return got.withColumn(weight, F.col(weight) * factor).drop("_ratio", "_tie", "_f")


def rake_within(cells: DataFrame, targets: dict[str, DataFrame], aimed: float, *, rounds: int = 12) -> DataFrame:
    """cells with raked, as rake() gives, but no cell gets more of the aimed tokens than it has.

    Full cells stay full and the others are raked to what is left of the targets. A value with fewer tokens than its
    target gets all it has, and the other targets of its dimension grow in proportion, so the total is kept.
    """
    now = cells.withColumn("most", F.col("tokens") / F.lit(aimed)).withColumn("raked", F.col("tokens").cast("double"))
    for d in DIMENSIONS:
        has = now.groupBy(d).agg(F.sum("most").alias("most")).join(targets[d].select(F.col("value").alias(d), F.col("share").cast("double").alias("share")), d)
        fits = filled(has.withColumn("_all", F.lit(1)), ["_all"], "share", "most", F.lit(1.0))
        now = now.join(fits.select(d, F.least("share", "most").alias(f"want_{d}")), d)
    now = materialize(now, "rake")
    # Few cells, counted here, are raked in one task, so that no step shuffles; many by shuffles of their values.
    few = now.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS
    for _ in range(rounds):
        step = now.coalesce(1) if few else now
        for d in DIMENSIONS:
            step = filled(step, [d], "raked", "most", F.col(f"want_{d}"))
        step = materialize(step, "rake")
        remove_table(now)
        now = step
    return now.withColumn("raked", F.least("raked", "most")).drop("most", *[f"want_{d}" for d in DIMENSIONS])


def unmet(raked: DataFrame, targets: dict[str, DataFrame], tolerance: float = 0.005) -> DataFrame:
    """(dimension, value, share, got) of targets that the raked shares miss by more than this part of them."""
    parts = []
    for d in DIMENSIONS:
        got = raked.groupBy(F.col(d).alias("value")).agg(F.sum("raked").alias("got"))
        both = targets[d].select("value", "share").join(got, "value", "left").select(F.lit(d).alias("dimension"), "value", "share", F.coalesce("got", F.lit(0.0)).alias("got"))
        parts.append(both.where(F.abs(F.col("got") - F.col("share")) > tolerance * F.col("share")))
    return reduce(DataFrame.unionByName, parts)


def uniform(seed: str, *parts: Column) -> Column:
    """A number from 0 to 1 (excluded), from 32 bits of an MD5 sum."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, *, topic: Column | None = None, tokens: Column | None = None, targets: dict[str, DataFrame] | None = None, power: float = 0.7, budget: float = 0.5, rounds: int = 12, tolerance: float = 0.0, seed: str = "mix", bounded: bool = True) -> DataFrame:
    """Every document with mix_topic, mix_tokens, mix_probability and mix_selected; columns of these names are replaced.

    docs needs doc_id, text, source and lang. topic and tokens default to form() and estimated_tokens(); targets, tables
    of (value, share) for source, lang and topic, default to present shares to the given power. budget is the share of
    all tokens that is aimed at. Cells' tokens bound the raking, so the budget is met in expectation and targets are where
    values have the tokens; a warning names those that aren't. If not bounded, probabilities are cut at 1 afterwards, and
    what is cut is lost. Null sources, languages and topics form a value of their own, "".
    The draw depends on seed and doc_id (for null ids on the text) only: repeated rows share their fate, and order and
    partitions don't matter. Empty tables give no rows.
    """
    docs = docs.drop("mix_topic", "mix_tokens", "mix_probability", "mix_selected")
    text = F.col("text")
    named = docs.withColumns({"mix_topic": F.coalesce(topic if topic is not None else form(text), F.lit("")), "mix_tokens": tokens if tokens is not None else estimated_tokens(text), "mix_source": F.coalesce("source", F.lit("")), "mix_lang": F.coalesce("lang", F.lit(""))})
    cells = named.groupBy(F.col("mix_source").alias("source"), F.col("mix_lang").alias("lang"), F.col("mix_topic").alias("topic")).agg(F.sum("mix_tokens").alias("tokens"))
    cells = materialize(cells, "cells")
    wanted = {d: (targets or {}).get(d, None) for d in DIMENSIONS}
    wanted = {d: t if t is not None else flattened_targets(cells, d, power) for d, t in wanted.items()}
    total, n_cells = cells.agg(F.sum("tokens"), F.count("*")).first()
    if bounded and (total or 0) * budget > 0:
        raked = rake_within(cells, wanted, float(total * budget), rounds=rounds)
        missed = unmet(raked, wanted).orderBy(F.desc(F.abs(F.col("got") - F.col("share")))).limit(21).collect()
        if missed:
            logging.getLogger(__name__).warning("targets not met: %s%s", ", ".join(f"{r.dimension} {r.value!r} {r.got:.4f} for {r.share:.4f}" for r in missed[:20]), ", and more" if len(missed) > 20 else "")
    else:
        raked = rake(cells, wanted, rounds=rounds, tolerance=tolerance)
    p = raked.select(
        F.col("source").alias("mix_source"), F.col("lang").alias("mix_lang"), F.col("topic").alias("mix_topic"),
        F.least(F.lit(1.0), F.lit(float((total or 0) * budget)) * F.col("raked") / F.col("tokens")).alias("mix_probability"),
    )
    found = named.join(F.broadcast(p) if n_cells <= BROADCAST_CELLS else p, ["mix_source", "mix_lang", "mix_topic"])
    draw = uniform(seed, F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    return found.withColumn("mix_selected", draw < F.col("mix_probability")).select(*docs.columns, "mix_topic", "mix_tokens", "mix_probability", "mix_selected")


def sampled(docs: DataFrame, **options) -> DataFrame:
    """The documents that mix() selects, with their own columns as they are, also where these have mix()'s names."""
    names = [f"{c}_own" for c in docs.columns]
    own = docs.select("doc_id", "text", "source", "lang", *[F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)])
    return mix(own, **options).where("mix_selected").select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])


def sql(power: float, budget: float, rounds: int, seed: str) -> str:
    """The same over documents in DuckDB, its rounds written out."""

    def full(rows: str, group: str, weight: str, want: str, order: str) -> list[str]:
        """Steps that give rows (weight, most) one factor in each group, so that they add up to want when cut at most."""
        over = f"over (partition by {group} order by ratio, {order}" if group else f"over (order by ratio, {order}"
        whole = f"over (partition by {group})" if group else "over ()"
        return [
            f"(select *, most / {weight} ratio from {rows} where {weight} > 0)",
            f"(select *, ({want} - coalesce(sum(most) {over} rows between unbounded preceding and 1 preceding), 0)) / sum({weight}) {over} rows between current row and unbounded following) f from %s)",
            f"(select * replace ({weight} * coalesce(max(case when f <= ratio then f end) {whole}, max(ratio) {whole}) as {weight}) from %s)",
        ]

    steps: list[tuple[str, str]] = []
    for d in DIMENSIONS:
        a, b, c = full(f"has_{d}", "", "share", "1.0", "v")
        steps += [(f"has_{d}", f"(select {d} v, sum(most) most, pow(sum(tokens)::double, {power}) / sum(pow(sum(tokens)::double, {power})) over () share from sized group by 1)")]
        steps += [(f"a_{d}", a), (f"b_{d}", b % f"a_{d}"), (f"c_{d}", c % f"b_{d}"), (f"want_{d}", f"(select v, least(share, most) want from c_{d})")]
    wants = ", ".join(f"want_{d}.want want_{d}" for d in DIMENSIONS)
    joins = " ".join(f"join want_{d} on want_{d}.v = {d}" for d in DIMENSIONS)
    steps.append(("r0", f"(select source, lang, topic, tokens, most, tokens::double raked, {wants} from sized {joins})"))
    last = "r0"
    for k in range(rounds):
        for j, d in enumerate(DIMENSIONS):
            n = 3 * k + j
            a, b, c = full(last, d, "raked", f"want_{d}", "source, lang, topic")
            steps += [(f"x{n}", a), (f"y{n}", b % f"x{n}"), (f"z{n}", c % f"y{n}"), (f"r{n + 1}", f"(select * exclude (ratio, f) from z{n})")]
            last = f"r{n + 1}"
    return f"""
with named as (select doc_id, coalesce(source, '') source, coalesce(lang, '') lang, coalesce(text, '') t,
    greatest(1, ceil(length(coalesce(text, '')) / 4))::bigint tokens from documents),
docs as (select *, case when length(t) < 600 then 'brief' when (length(t) - length(replace(t, '|', ''))) * 40 > length(t) then 'table'
    when (length(t) - length(replace(t, chr(10), ''))) * 120 > length(t) then 'lines' when length(t) >= 8000 then 'long' else 'prose' end topic from named),
cells as materialized (select source, lang, topic, sum(tokens)::bigint tokens from docs group by 1, 2, 3),
sized as materialized (select *, tokens / ({budget} * sum(tokens) over ()) most from cells),
{", ".join(f"{n} as materialized {q}" for n, q in steps)},
p as (select source, lang, topic, least(1.0, {budget} * (select sum(tokens) from cells)::double * least(raked, most) / tokens) probability from {last})
select doc_id, topic, tokens, round(probability, 6) probability,
  ('0x' || substr(md5('{seed}:' || coalesce(doc_id::varchar, md5(t))), 1, 8))::ubigint::double / 4294967296.0 < probability selected
from docs join p using (source, lang, topic)"""
