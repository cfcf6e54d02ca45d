"""The contract's queries: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import mixing
from weft.sources.scratch import new_path

#: The mixing query's parameters, which its SQL has too.
MIX = {"power": 0.7, "budget": 0.5, "rounds": 12, "seed": "mix"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weft.llm.token_output import token_output

    return token_output(table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache of its own, so that every distinct content is encoded in this run."""
    from weft.llm.token_counts import token_counts

    found = token_counts(table(spark, sf_dir, "documents"), new_path(spark, "token-counts"))
    return found.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def joined_spans(kinds: list[str], by_place: bool) -> Column:
    """kind:start:end of the spans in the columns named kinds, comma-joined; by start and then kind, or the reverse."""
    def labelled(k: int, kind: str) -> Column:
        def row(s: Column) -> Column:
            keys = (s["start"], F.lit(k)) if by_place else (F.lit(k), s["start"])
            return F.struct(keys[0].alias("a"), keys[1].alias("b"), F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("t"))

        return F.transform(kind, row)

    rows = [labelled(k, kind) for k, kind in enumerate(kinds)]
    return F.array_join(F.transform(F.array_sort(F.concat(*rows)), lambda s: s["t"]), ",")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty ledger of its own, so that every distinct content is scanned in this run."""
    from weft.llm.secrets import BASE, RULES, scan_secrets

    found = scan_secrets(table(spark, sf_dir, "documents"), new_path(spark, "secret-ledger"))
    base = [r[0] for r in BASE]
    found = found.withColumns({"spans": joined_spans([r[0] for r in RULES], by_place=True), "base": joined_spans(base, by_place=True)})
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats to a table of windows, reads it again and digests what it holds."""
    from weft.llm.chat_format import chat_windows, read_windows
    from weft.sources.scratch import materialize

    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    found = read_windows(materialize(chat_windows(turns), "chat-windows"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("losses", "")
    return found.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weft.llm.quality import classify

    found = classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", F.col("quality_score").alias("score"), "predicted")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weft.llm.pii import KINDS, detect_pii

    found = detect_pii(table(spark, sf_dir, "documents"))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: ~s["added"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: ~s["added"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weft.llm.knn import quantized, voronoi_topk

    rows = table(spark, sf_dir, "embeddings").select("vec_id", quantized(F.col("embedding")).alias("x"))
    return voronoi_topk(rows, F.col("vec_id") % 20 == 0, k=20)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weft.llm.decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weft.llm.jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from weft.llm.mixing import mix

    found = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), **MIX)
    return found.select("doc_id", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("tokens"), F.round("mix_probability", 6).alias("probability"), F.col("mix_selected").alias("selected"))


QUERIES = {"op1_token_output": op1_token_output, "op2_token_counts": op2_token_counts, "op3_chat_format": op3_chat_format, "op4_quality": op4_quality, "op5_personal_data": op5_personal_data, "op6_secret_scan": op6_secret_scan, "op7_exact_topk": op7_exact_topk, "op8_decontaminate": op8_decontaminate, "op9_jaccard_join": op9_jaccard_join, "op10_mixing": op10_mixing}
SQL: dict[str, str] = {
    "op10_mixing": mixing.sql(**MIX),
    "op7_exact_topk": """
with rows as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) x from embeddings
  where vec_id is not null and embedding is not null and list_count(embedding) = len(embedding) and list_bool_and(list_transform(embedding, lambda x: isfinite(x)))),
scored as (select q.vec_id query_id, d.vec_id, list_sum(list_transform(list_zip(q.x, d.x), lambda p: p[1] * p[2]))::bigint score
  from rows q join rows d on q.vec_id % 20 = 0 and d.vec_id <> q.vec_id),
ranked as (select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::integer as rank, vec_id, score from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20""",
}
