"""Seeded samples that don't depend on order or partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(seed: str, *parts: Column) -> Column:
    """A key to sort by: MD5 of seed and row."""
    return F.md5(F.concat_ws(":", F.lit(seed), *[p.cast("string") for p in parts]).cast("binary"))


def stratified(df: DataFrame, strata: list[str], item: str, target: Column, seed: str) -> DataFrame:
    """The first rows of each stratum in drawn order, up to its target."""
    w = Window.partitionBy(*strata).orderBy(draw(seed, F.col(item)), item)
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= target).drop("_k")


def shortfalls(df: DataFrame, strata: list[str], target: Column) -> DataFrame:
    """Strata with fewer rows than their target: strata, n, missing."""
    return df.groupBy(*strata).agg(F.count("*").alias("n"), F.max(target).alias("_t")).withColumn("missing", F.greatest(F.col("_t") - F.col("n"), F.lit(0))).drop("_t")


def tiered(options: DataFrame, group: str, tier: str, item: str, *, per_tier: int, total: int, seed: str) -> DataFrame:
    """Options of each group: so many of every tier, then the rest in drawn order up to the total."""
    key = draw(seed, F.col(group), F.col(item))
    first = options.withColumn("_k", F.row_number().over(Window.partitionBy(group, tier).orderBy(key, item)))
    ranked = first.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(F.col("_k") > per_tier, key, item)))
    return ranked.where(F.col("_r") <= total).drop("_k", "_r")


def topped_up(df: DataFrame, cell: list[str], item: str, tags: dict[str, Column], *, uniform: int, per_tag: int, seed: str) -> DataFrame:
    """A uniform sample of each cell, then for each tag as many more rows as it lacks; ``route`` tells which."""
    taken = stratified(df, cell, item, F.lit(uniform), seed).withColumn("route", F.lit("uniform"))
    for name, holds in tags.items():
        have = taken.where(holds).groupBy(*cell).agg(F.count("*").alias("_have"))
        rest = df.join(taken.select(item), item, "left_anti").where(holds).join(have, cell, "left")
        w = Window.partitionBy(*cell).orderBy(draw(f"{seed}:{name}", F.col(item)), item)
        more = rest.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= per_tag - F.coalesce("_have", F.lit(0))).drop("_k", "_have").withColumn("route", F.lit(name))
        taken = taken.unionByName(more)
    return taken


def pair_at(groups: DataFrame, index: DataFrame, group: str, size: str) -> DataFrame:
    """The n-th pair (n from 0) of all unordered pairs within groups, without making them: index, group, i, j (from 0).

    groups has a size each; a running sum of s (s - 1) / 2 finds a pair's group, and i and j follow by arithmetic.
    """
    pairs = F.col(size) * (F.col(size) - 1) / 2
    w = Window.orderBy(group)
    cum = groups.select(group, size, F.sum(pairs).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long").alias("_hi"), pairs.cast("long").alias("_n")).where("_n > 0").withColumn("_lo", F.col("_hi") - F.col("_n"))
    # Groups stand in all stretches of numbers that they cover; with the mean group's width these are two a group on average.
    n, total = cum.agg(F.count("*"), F.coalesce(F.max("_hi"), F.lit(1))).first()
    width = max(1, total // max(n, 1))
    spread = cum.withColumn("_b", F.explode(F.sequence(F.floor(F.col("_lo") / width), F.floor((F.col("_hi") - 1) / width))))
    both = index.withColumn("_b", F.floor(F.col("index") / width)).join(spread, "_b").where((F.col("index") >= F.col("_lo")) & (F.col("index") < F.col("_hi")))
    k, s = F.col("index") - F.col("_lo"), F.col(size)
    i = F.floor(((2 * s - 1) - F.sqrt((2 * s - 1) * (2 * s - 1) - 8 * k)) / 2).cast("long")
    return both.withColumn("i", i).withColumn("j", F.col("index") - F.col("_lo") - (F.col("i") * (2 * s - F.col("i") - 1) / 2).cast("long") + F.col("i") + 1).select("index", group, "i", "j")


def schedule(pairs: DataFrame, key: str, variants: list[str], repeats: int) -> DataFrame:
    """Base, repeated and variant requests of each sampled pair: key, condition, replicate."""
    runs = [F.struct(F.lit("base").alias("condition"), F.lit(r).alias("replicate")) for r in range(1 + repeats)] + [F.struct(F.lit(v).alias("condition"), F.lit(0).alias("replicate")) for v in variants]
    return pairs.withColumn("_r", F.explode(F.array(*runs))).select(*pairs.columns, "_r.condition", "_r.replicate")


def selectors(options: DataFrame, item: str, option: str, score: str, path: str) -> DataFrame:
    """Lexical baselines: all, top1, above_mean and the largest path group: item, strategy, option."""
    w = Window.partitionBy(item)
    s = options.withColumns({"_mean": F.avg(score).over(w), "_top": F.row_number().over(w.orderBy(F.desc(score), option)), "_g": F.count("*").over(Window.partitionBy(item, path))})
    s = s.withColumn("_best", F.first(path).over(w.orderBy(F.desc("_g"), path)))
    chosen = F.array_compact(F.array(F.lit("all"), F.when(F.col("_top") == 1, F.lit("top1")), F.when(F.col(score) > F.col("_mean"), F.lit("above_mean")), F.when(F.col(path) == F.col("_best"), F.lit("largest_group"))))
    return s.select(F.col(item), F.explode(chosen).alias("strategy"), F.col(option))


def _donors(rows: DataFrame, curriculum: str, block: str, item: str, seed: str, value: str) -> DataFrame:
    """(item, donor): a value of a drawn row of the same curriculum but of another block; none where there is no other block.

    Rows stand in blocks one after another, so those of other blocks are a stretch of places, in which a draw picks one.
    """
    whole, own = Window.partitionBy(curriculum), Window.partitionBy(curriculum, block)
    placed = rows.withColumns({"_at": F.row_number().over(whole.orderBy(block, item, value)) - 1, "_n": F.count("*").over(whole), "_s": F.count("*").over(own)})
    placed = placed.withColumn("_a", F.min("_at").over(own))
    first = placed.select(curriculum, block, "_n", "_s", "_a").distinct()
    draws = rows.select(curriculum, block, item).distinct().join(first, [curriculum, block]).where("_n > _s")
    number = F.conv(F.substring(draw(seed, F.col(item)), 1, 12), 16, 10).cast("long")
    wanted = draws.select(curriculum, item, ((F.col("_a") + F.col("_s") + number % (F.col("_n") - F.col("_s"))) % F.col("_n")).alias("_at"))
    return wanted.join(placed.select(curriculum, "_at", F.col(value).alias("donor")), [curriculum, "_at"]).select(item, "donor")


def corruptions(rows: DataFrame, item: str, parts: str, *, curriculum: str, strand: str, seed: str = "control") -> DataFrame:
    """Known-bad variants of rows with a list of parts, as negative controls: item, kind, parts.

    bundled_components: one part drawn takes another one in, joined by a semicolon (two parts or more). collapsed_set: all in
    one. cross_strand_swap: a drawn part is replaced by one of a row of another strand. forced_redundancy: a part twice.
    invented_specificity: the last clause, three words or more, of another row's part is put in brackets behind one.
    truncation: a part of five words or more loses the last 40 %. under_decomposition: the first of three or more alone.
    Draws depend on seed and item only. Rows for which a kind isn't possible don't get it; null and empty lists get none.
    """
    n = F.size(parts)
    pick = lambda name, of: F.conv(F.substring(draw(f"{seed}:{name}", F.col(item)), 1, 12), 16, 10).cast("long") % of
    bare = lambda t: F.regexp_replace(t, r"\.+$", "")
    told = rows.where(n > 0).select(item, curriculum, strand, F.col(parts).alias("_parts"))
    single = told.select(item, curriculum, strand, F.explode("_parts").alias("_part"))
    swapped = _donors(single, curriculum, strand, item, f"{seed}:swap", "_part").withColumnRenamed("donor", "_swap")
    tails = single.select(item, curriculum, F.trim(F.element_at(F.split(bare(F.col("_part")), ","), -1)).alias("_tail")).where(F.size(F.split("_tail", r"\s+")) >= 3)
    told_tails = tails.withColumn("_own", F.col(item))
    clause = _donors(told_tails, curriculum, "_own", item, f"{seed}:clause", "_tail").withColumnRenamed("donor", "_clause")
    others = told.join(tails.select(curriculum).distinct(), curriculum, "left_semi").join(clause, item, "left_anti").select(item, curriculum)
    # Rows without a clause of their own draw from all of their curriculum.
    alone = others.withColumn("_tail", F.lit("")).withColumn("_own", F.col(item))
    rest = _donors(told_tails.unionByName(alone), curriculum, "_own", item, f"{seed}:clause", "_tail").withColumnRenamed("donor", "_clause").join(others.select(item), item, "left_semi").where("_clause <> ''")
    j = told.join(swapped, item, "left").join(clause.unionByName(rest), item, "left")
    p, m = F.col("_parts"), F.size("_parts")
    at = lambda i, value: F.transform(p, lambda x, k: F.when(k == i, value).otherwise(x))
    first = pick("first", m)
    second = (first + 1 + pick("second", F.greatest(m - 1, F.lit(1)))) % m
    merged = F.concat(bare(F.get(p, first)), F.lit("; "), F.get(p, second))
    long = F.filter(F.transform(p, lambda x, k: F.struct(k.alias("k"), F.split(F.trim(x), r"\s+").alias("w"))), lambda x: F.size(x["w"]) >= 5)
    cut = F.get(long, pick("cut", F.greatest(F.size(long), F.lit(1))))
    kinds = {
        "bundled_components": F.when(m >= 2, F.filter(at(first, merged), lambda x, k: k != second)),
        "collapsed_set": F.when(m >= 2, F.array(F.array_join(F.transform(p, bare), "; "))),
        "cross_strand_swap": F.when(F.col("_swap").isNotNull(), at(pick("place", m), F.col("_swap"))),
        "forced_redundancy": F.concat(p, F.array(F.get(p, pick("twice", m)))),
        "invented_specificity": F.when(F.col("_clause").isNotNull(), at(pick("vague", m), F.concat(bare(F.get(p, pick("vague", m))), F.lit(" ("), F.col("_clause"), F.lit(")")))),
        "truncation": F.when(F.size(long) > 0, at(cut["k"], F.array_join(F.slice(cut["w"], F.lit(1), F.greatest(F.lit(2), F.floor(F.size(cut["w"]) * 0.6).cast("int"))), " "))),
        "under_decomposition": F.when(m >= 3, F.slice(p, 1, 1)),
    }
    made = F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(k).alias("kind"), v.alias("parts"))) for k, v in kinds.items()]))
    return j.withColumn("_c", F.explode(made)).select(item, "_c.kind", "_c.parts")
