"""Rates, agreement, histograms and resampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rate(hit: Column) -> list[Column]:
    """Numerator, denominator and rate; the rate of nothing is null."""
    return [F.count_if(hit).alias("numerator"), F.count("*").alias("denominator"), F.round(F.try_divide(F.count_if(hit), F.count("*")), 9).alias("rate")]


def sliced(df: DataFrame, dimensions: list[str], measures: list[Column]) -> DataFrame:
    """Measures over all rows and for each value of each dimension: slice, value."""
    sets = df.groupingSets([[], *[[d] for d in dimensions]], *dimensions).agg(*measures, F.grouping_id().alias("_g"))
    n = len(dimensions)
    name, value = F.lit("all"), F.lit(None).cast("string")
    for k, d in enumerate(dimensions):
        own = F.col("_g").bitwiseAND(1 << (n - 1 - k)) == 0
        name, value = F.when(own, F.lit(d)).otherwise(name), F.when(own, F.col(d).cast("string")).otherwise(value)
    return sets.withColumns({"slice": name, "value": value}).drop("_g", *dimensions)


def histogram(value: Column) -> Column:
    """Decile of a confidence as text; 1 has its own."""
    return F.when(value >= 1, "1.0").otherwise(F.format_string("%.1f", F.floor(value * 10) / 10))


def counts_with_zeros(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Number of rows of each of the values, those that don't occur included."""
    every = df.sparkSession.createDataFrame([(v,) for v in values], f"{column} string")
    return every.join(df.groupBy(column).agg(F.count("*").alias("n")), column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def precision_recall(df: DataFrame, group: list[str], predicted: Column, actual: Column) -> DataFrame:
    """Micro counts, precision, recall and F1."""
    out = df.groupBy(*group).agg(F.count_if(predicted & actual).alias("tp"), F.count_if(predicted & ~actual).alias("fp"), F.count_if(~predicted & actual).alias("fn"), F.count("*").alias("n"))
    p, r = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    return out.withColumns({"precision": F.round(p, 9), "recall": F.round(r, 9), "f1": F.round(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), 9)})


def set_scores(df: DataFrame, group: list[str], chosen: Column, gold: Column) -> DataFrame:
    """Micro precision and recall over sets, and the share of exact matches."""
    return df.groupBy(*group).agg(
        F.sum(F.size(F.array_intersect(chosen, gold))).alias("tp"),
        F.sum(F.size(F.array_except(chosen, gold))).alias("fp"),
        F.sum(F.size(F.array_except(gold, chosen))).alias("fn"),
        F.count_if(F.array_sort(chosen) == F.array_sort(gold)).alias("exact"),
        F.count("*").alias("n"),
    )


def majority(df: DataFrame, group: list[str], passed: Column, replicate: str) -> DataFrame:
    """Majority of replicates (ties pass), the first replicate that agrees, and whether all do."""
    votes = df.withColumn("_p", passed)
    out = votes.groupBy(*group).agg(F.count_if("_p").alias("n_pass"), F.count("*").alias("n"), F.min(F.when(F.col("_p"), F.col(replicate))).alias("_yes"), F.min(F.when(~F.col("_p"), F.col(replicate))).alias("_no"))
    won = F.col("n_pass") * 2 >= F.col("n")
    return out.withColumns({"majority": won, "first_replicate": F.when(won, F.col("_yes")).otherwise(F.col("_no")), "stable": (F.col("n_pass") == 0) | (F.col("n_pass") == F.col("n"))}).drop("_yes", "_no")


def agreement(df: DataFrame, group: list[str], forward: Column, backward: Column) -> DataFrame:
    """Class of each group by the directions that confirmed it: both, forward, backward or none."""
    out = df.groupBy(*group).agg(F.max(forward.cast("int")).alias("f"), F.max(backward.cast("int")).alias("b"))
    return out.withColumn("agreement", F.when((F.col("f") == 1) & (F.col("b") == 1), "both").when(F.col("f") == 1, "forward").when(F.col("b") == 1, "backward").otherwise("none")).drop("f", "b")


def compare_replicates(df: DataFrame, group: list[str], order: str, condition: str, answer: str, base: str) -> DataFrame:
    """Pairs of judgments of one subject: repetition (same condition) or variant (base with another); others are left out."""
    b = df.alias("b")
    a = df.alias("a")
    on = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group]
    joined = a.join(b, _all(on) & (F.col(f"a.{order}") < F.col(f"b.{order}")))
    same = F.col(f"a.{condition}") == F.col(f"b.{condition}")
    kind = F.when(same, "repetition").when((F.col(f"a.{condition}") == base) | (F.col(f"b.{condition}") == base), "variant")
    return joined.select(*[F.col(f"a.{g}").alias(g) for g in group], kind.alias("kind"), (F.col(f"a.{answer}") == F.col(f"b.{answer}")).alias("same")).where("kind is not null")


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def bootstrap(df: DataFrame, group: list[str], passed: Column, *, rounds: int = 2000, seed: int = 7) -> DataFrame:
    """Percentile interval of a pass rate: group, rate, low, high.

    A resample of n rows at a rate draws a binomial number of passes, so only counts reach a task, however many rows a
    group has. The generator is seeded by group and seed; low and high are the 2.5 % and 97.5 % order statistics.
    """
    counts = df.groupBy(*group).agg(F.count_if(passed).alias("k"), F.count("*").alias("n"))

    def run(batches):
        import zlib

        import numpy as np

        for pdf in batches:
            low, high = [], []
            for row in pdf.itertuples(index=False):
                rng = np.random.default_rng([seed, zlib.crc32(repr(tuple(row[: len(group)])).encode())])
                draws = np.sort(rng.binomial(int(row.n), row.k / row.n, rounds) / row.n)
                low.append(round(float(draws[int(0.025 * rounds)]), 4))
                high.append(round(float(draws[min(rounds - 1, int(0.975 * rounds))]), 4))
            yield pdf.assign(rate=(pdf.k / pdf.n).round(4), low=low, high=high)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counts.schema) + ", rate double, low double, high double"
    return counts.mapInPandas(run, schema)


def usage(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Known subtotal, number of unknown values, and the total if all are known."""
    out = df.groupBy(*group).agg(F.sum(value).alias("known"), F.count_if(F.col(value).isNull()).alias("unknown"))
    return out.withColumn("total", F.when(F.col("unknown") == 0, F.col("known")))


def crosstab(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Counts of given columns for each row value."""
    return df.groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).fillna(0)


def cohort_rank(pairs: DataFrame, group: list[str], common: str, total: str, most: int) -> DataFrame:
    """The most similar pairs of each group by exact fraction, then endpoints. Fractions compare as integers over 10^12."""
    share = F.floor(F.col(common).cast("decimal(38,0)") * F.lit(10**12).cast("decimal(38,0)") / F.greatest(F.col(total), F.lit(1)).cast("decimal(38,0)"))
    return pairs.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(share.desc(), "item_a", "item_b"))).where(F.col("rank") <= most)


def spread(value: Column) -> Column:
    """Population standard deviation; 0 for fewer than two values."""
    return F.when(F.count(value) < 2, F.lit(0.0)).otherwise(F.stddev_pop(value))


def tier_acceptance(offered: DataFrame, chosen: DataFrame, tier: str, keys: list[str]) -> DataFrame:
    """How many options of each distance tier were offered, and how many of them chosen: tier, offered, accepted, rate."""
    c = chosen.select(*keys).distinct().withColumn("_c", F.lit(True))
    j = offered.select(tier, *keys).distinct().join(c, keys, "left")
    got = j.groupBy(tier).agg(F.count("*").alias("offered"), F.count("_c").alias("accepted"))
    return got.withColumn("rate", F.round(F.col("accepted") / F.col("offered"), 9))


def endpoint_features(edges: DataFrame, uses: DataFrame, *, least: int = 10) -> DataFrame:
    """Features of graph nodes: node, parents, children, components, reused (a component that ``least`` or more items have),
    below_many (it or a node above it has several parents). edges has child and parent, uses item and component."""
    from weft.operators.graph import adjacency, descendants

    degrees = adjacency(edges)
    u = uses.distinct()
    often = u.groupBy("component").agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select("component")
    have = u.join(often.withColumn("_often", F.lit(True)), "component", "left").groupBy(F.col("item").alias("node")).agg(F.count("*").alias("components"), (F.count("_often") > 0).alias("reused"))
    many = degrees.where("parents > 1").select("node")
    below = many.union(descendants(edges, many).select("node")).distinct().withColumn("below_many", F.lit(True))
    j = degrees.join(have, "node", "full_outer").join(below, "node", "left")
    zero, no = F.lit(0), F.lit(False)
    return j.select("node", F.coalesce("parents", zero).alias("parents"), F.coalesce("children", zero).alias("children"), F.coalesce("components", zero).alias("components"), F.coalesce("reused", no).alias("reused"), F.coalesce("below_many", no).alias("below_many"))
