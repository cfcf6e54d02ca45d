"""Nominating, ranking and budgeting pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.sources.scratch import materialize, small

# The names that evidence is stored under, from the strongest on.
PRECEDENCE = (
    "shared_learning_components",
    "hierarchy_context",
    "lc_text_token_overlap",
    "lc_tag_token_overlap",
    "sfi_text_token_overlap",
    "sfi_text_trigram_overlap",
    "source_code_prefix",
    "local_rank_proximity",
    "source_page_proximity",
)


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds, or null."""
    out = F.lit(None).cast("string")
    for name, condition in reversed(rules):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return out


def may_build(first_rank: Column, second_rank: Column) -> Column:
    """Whether the source isn't later than the target; a missing rank is no evidence."""
    return F.coalesce(first_rank.isNotNull() & second_rank.isNotNull() & (first_rank <= second_rank), F.lit(False))


def admissible(pairs: DataFrame, policy: DataFrame) -> DataFrame:
    """Decisions open to each pair: pairs has type_a, type_b, rank_a, rank_b; policy has source, target, directed.

    A directed permission also needs a rank that isn't later; the two decisions that publish nothing are always open.
    """
    one_way = policy.where("directed")
    directed = pairs.join(small(one_way.select(F.col("source").alias("type_a"), F.col("target").alias("type_b"), F.lit(True).alias("_forth")).distinct()), ["type_a", "type_b"], "left")
    directed = directed.join(small(one_way.select(F.col("target").alias("type_a"), F.col("source").alias("type_b"), F.lit(True).alias("_back")).distinct()), ["type_a", "type_b"], "left")
    loose = policy.where("not directed")
    both = loose.select(F.col("source").alias("type_a"), F.col("target").alias("type_b")).union(loose.select(F.col("target").alias("type_a"), F.col("source").alias("type_b"))).distinct().withColumn("_relates", F.lit(True))
    joined = directed.join(small(both), ["type_a", "type_b"], "left")
    decisions = F.array_compact(
        F.array(
            F.when(F.col("_forth") & may_build(F.col("rank_a"), F.col("rank_b")), F.lit("builds_forward")),
            F.when(F.col("_back") & may_build(F.col("rank_b"), F.col("rank_a")), F.lit("builds_backward")),
            F.when(F.col("_relates"), F.lit("relates")),
            F.lit("none"),
            F.lit("unsure"),
        )
    )
    return joined.withColumn("decisions", decisions).drop("_forth", "_back", "_relates")


#: Items of a bucket that one task holds beside the other items of the bucket.
BLOCK = 1_024


def _all_pairs(items: DataFrame, item: str, keys: Column) -> DataFrame:
    """(item_a, item_b) of every pair that shares a bucket, made where its items meet; pairs are neither sorted nor gathered.

    A bucket's items are cut into blocks by hash; an item looks through each block of its buckets for the greater ones. A
    pair that shares several buckets is made in the smallest of them, by itself: rows carry all their buckets.
    """
    rows = items.select(F.col(item).alias("item"), F.explode(keys).alias("bucket")).where("item is not null and bucket is not null")
    own = rows.groupBy("item").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))
    each = own.select("item", "buckets", F.explode("buckets").alias("bucket"))
    blocks = each.groupBy("bucket").agg(F.count("*").alias("_n")).where("_n > 1").select("bucket", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_k"))
    placed = each.join(small(blocks), "bucket")
    kept = placed.select("bucket", F.pmod(F.xxhash64("item"), "_k").cast("int").alias("block"), F.col("item").alias("item_b"), F.col("buckets").alias("_b"))
    looked = placed.select("bucket", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("block"), F.col("item").alias("item_a"), F.col("buckets").alias("_a"))
    met = looked.join(kept.hint("shuffle_hash"), ["bucket", "block"]).where("item_a < item_b")
    return met.where(F.array_min(F.array_intersect("_a", "_b")) == F.col("bucket")).select("item_a", "item_b")


def bucket_pairs(items: DataFrame, item: str, buckets: dict[str, Column], *, most: int | None) -> DataFrame:
    """Pairs that share a bucket of any signal, at most ``most`` of each signal or all: item_a, item_b, signal.

    Within a bucket pairs are taken by rotation distance and then index; buckets take turns. A bucket of n items yields
    its pairs up to the budget only: distance d of item i pairs it with item i + d, for as many d as the budget needs.
    Without a budget there is no order to keep, and pairs are written as they are met.
    """
    out = None
    for signal, keys in buckets.items():
        if most is None:
            part = _all_pairs(items, item, keys)
        else:
            rows = items.select(F.col(item).alias("item"), F.explode(keys).alias("bucket")).distinct()
            w = Window.partitionBy("bucket")
            rows = rows.withColumn("i", F.row_number().over(w.orderBy("item")) - 1).withColumn("n", F.count("*").over(w)).where("n > 1")
            reach = F.least(F.floor(F.col("n") / 2), F.ceil(F.lit(most) / F.col("n")) + 1)
            turned = rows.withColumn("d", F.explode(F.sequence(F.lit(1).cast("long"), reach)))
            pair = turned.withColumn("j", (F.col("i") + F.col("d")) % F.col("n")).where((F.col("d") * 2 != F.col("n")) | (F.col("i") < F.col("j")))
            other = rows.select("bucket", F.col("i").alias("j"), F.col("item").alias("other"))
            pair = pair.join(other, ["bucket", "j"])
            pair = pair.withColumn("turn", F.row_number().over(w.orderBy("d", "i")))
            ordered = pair.select(F.least("item", "other").alias("item_a"), F.greatest("item", "other").alias("item_b"), "turn", "bucket").groupBy("item_a", "item_b").agg(F.min(F.struct("turn", "bucket")).alias("o"))
            part = ordered.orderBy("o", "item_a", "item_b").limit(most).select("item_a", "item_b")
        part = part.withColumn("signal", F.lit(signal))
        out = part if out is None else out.unionByName(part)
    return out


def indexed(items: DataFrame, item: str) -> DataFrame:
    """(item, i) of distinct items, numbered from 0 in their order: within ranges, after the sizes of the ranges before."""
    n = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(items.select(F.col(item).alias("item")).where("item is not null").distinct().repartitionByRange(n, "item").withColumn("_p", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_p").agg(F.count("*").alias("_n"))
    before = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_a"))
    return dealt.join(F.broadcast(before), "_p").select("item", (F.col("_a") + F.row_number().over(Window.partitionBy("_p").orderBy("item")) - 1).alias("i"))


def cyclic_pairs(items: DataFrame, item: str, most: int) -> DataFrame:
    """Balanced pairs by rotation distance: every item meets its neighbour, then the next but one, up to the limit.

    The pair of item i at distance d is the ((d - 1) n + i)-th, so those within the limit are known without an order.
    """
    placed = materialize(indexed(items, item), "indexed")
    n = placed.count()
    if n < 2:
        return placed.limit(0).select(F.col("item").alias("item_a"), F.col("item").alias("item_b"))
    reach = min(n // 2, -(-most // n))
    turned = placed.withColumn("d", F.explode(F.sequence(F.lit(1), F.lit(reach)))).where((F.col("d") - 1) * n + F.col("i") < most)
    pair = turned.withColumn("j", (F.col("i") + F.col("d")) % n).where((F.col("d") * 2 != n) | (F.col("i") < F.col("j")))
    other = placed.select(F.col("i").alias("j"), F.col("item").alias("other"))
    return pair.join(other, "j").select(F.least("item", "other").alias("item_a"), F.greatest("item", "other").alias("item_b"))


def candidate_bound(n: int, per_item: int, total: int) -> int:
    """Most candidates that both caps allow: total, all pairs, half of items times the cap."""
    return min(total, n * (n - 1) // 2, n * per_item // 2)


def rank_order(evidence: Column) -> list[Column]:
    """Sort keys: more signals first, then those with a stronger signal."""
    return [F.size(evidence).desc(), *[(~F.array_contains(evidence, e)).cast("int") for e in PRECEDENCE]]


def shortlist(pairs: DataFrame, order: list[Column], per_item: int, pair_id: str = "pair_id") -> DataFrame:
    """Pairs among the best few of either endpoint (item_a, item_b), each once."""
    ends = pairs.withColumn("_end", F.explode(F.array("item_a", "item_b")))
    kept = ends.withColumn("_k", F.row_number().over(Window.partitionBy("_end").orderBy(*order, pair_id))).where(F.col("_k") <= per_item)
    return kept.drop("_end", "_k").dropDuplicates([pair_id])


def within_budgets(pairs: DataFrame, scope: str, place: str, per_item: int, total: int) -> DataFrame:
    """Pairs in order of place, each taken while both endpoints are under their quota, up to a total for each scope.

    Every choice depends on all before it, so a scope is solved in one piece, from ids and places only; shortlists bound
    it to items times quota.
    """

    def run(pdf):
        used: dict = {}
        rows = []
        for k, (a, b) in enumerate(pdf.sort_values(place)[["item_a", "item_b"]].itertuples(index=False)):
            if len(rows) < total and used.get(a, 0) < per_item and used.get(b, 0) < per_item:
                used[a], used[b] = used.get(a, 0) + 1, used.get(b, 0) + 1
                rows.append(k)
        return pdf.sort_values(place).iloc[rows]

    return pairs.groupBy(scope).applyInPandas(run, pairs.schema)


def eligibility(items: DataFrame, relations: dict[str, list[tuple[str, Column]]]) -> DataFrame:
    """Whether each item takes part in each relation, and if not the first reason: the columns of items, relation, eligible,
    reason. Each relation has its ordered list of (reason, condition)."""
    each = F.array(*[F.struct(F.lit(r).alias("relation"), first_reason(rules).alias("reason")) for r, rules in relations.items()])
    return items.withColumn("_r", F.explode(each)).select(*items.columns, "_r.relation", F.col("_r.reason").isNull().alias("eligible"), "_r.reason")
