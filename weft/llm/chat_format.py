"""Operator 3: chat formatting in budgeted windows, in SQL functions only.

Prefix sums of turn tokens cut a conversation into strides of (budget - history - system tokens). The turns that lie
inside one stride form a window; a turn that crosses the end of its stride is a window of its own. So no window needs
the one before it, turns are never cut, and a window's targets exceed the stride only where one turn does. Each window
starts with the system turn, goes on with the nearest earlier turns of at most ``history`` tokens, and then has its
targets. The loss mask covers assistant texts of targets only: each once, as repeated ones are masked out.

Turns read ``<|im_start|>role\\ntext<|im_end|>\\n``. In texts, "<", any backslashes and "|" get one backslash more, so
neither mark can occur in them and taking one away restores them. Roles other than [A-Za-z0-9_]+ are written as "%" and
their URL encoding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.sources.scratch import materialize

START, END = "<|im_start|>", "<|im_end|>\n"
#: Characters of a text that decide where turns with one number and role are dealt.
DEALT_CHARS = 64
#: A turn's tokens without a column of counts: its runs of letters, digits or marks, and 4 for its frame.
PIECE = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def write_role(role: Column) -> Column:
    return F.when(role.rlike(r"\A[A-Za-z0-9_]+\z"), role).otherwise(F.concat(F.lit("%"), F.url_encode(role)))


def read_role(role: Column) -> Column:
    return F.when(role.startswith("%"), F.url_decode(F.substring(role, 2, 1 << 30))).otherwise(role)


def _prefix_sums(turns: DataFrame) -> DataFrame:
    """turns with no (from 1, in order of turn, role and text), before (tokens of earlier turns but the system turn), system
    (whether it is the system turn: the very first one, if its role says so) and system_tokens of the conversation.

    Turns are dealt by ranges of their order, so a long conversation fills as many tasks as its share of all rows, also
    where its turns have one number or none. Sums go over a range's turns first, then over the ranges of a conversation.
    """
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.repartitionByRange(n, "key", "turn", "role", F.substring("text", 1, DEALT_CHARS)).withColumn("part", F.spark_partition_id())
    t = materialize(dealt, "chat-turns")
    w = Window.partitionBy("key", "part").orderBy("turn", "role", "text")
    inner = F.coalesce(F.sum("cost").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    t = t.withColumns({"in_part": F.row_number().over(w), "inner": inner})
    first = F.max(F.when(F.col("in_part") == 1, F.struct("role", "cost", "tokens")))
    parts = t.groupBy("key", "part").agg(F.count("*").alias("n"), F.sum("cost").alias("s"), first.alias("first"))
    whole = Window.partitionBy("key").orderBy("part")
    earlier = whole.rowsBetween(Window.unboundedPreceding, -1)
    head = F.first("first").over(whole)
    led = head["role"] == "system"
    parts = parts.select(
        "key", "part", (F.row_number().over(whole) == 1).alias("leads"), led.alias("led"),
        F.when(led, head["cost"]).otherwise(0).alias("head_cost"), F.when(led, head["tokens"]).otherwise(0).alias("system_tokens"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("s_before"),
    )
    j = t.join(parts, ["key", "part"])
    system = F.col("leads") & F.col("led") & (F.col("in_part") == 1)
    before = F.when(system, 0).otherwise(F.col("s_before") + F.col("inner") - F.col("head_cost"))
    return j.select("key", "role", "text", "tokens", "cost", "system_tokens", system.alias("system"), (F.col("n_before") + F.col("in_part")).alias("no"), before.alias("before"))


def chat_windows(turns: DataFrame, *, budget: int = 1024, history: int = 256, tokens: str | None = None) -> DataFrame:
    """One row for each window: conv_id, window, text, segments, n_tokens.

    turns needs conv_id, turn, role and text; other columns aren't read, but for the column that ``tokens`` names,
    which replaces the estimate. Null texts and roles are empty, rows with null conv_id are one conversation, null turns
    come first, equal turns go by role and text, and repeated rows stay. window is the number (from 1) of its first turn that
    isn't repeated. segments has, in order, the place (no) of the turn in its conversation, whether it is repeated (history,
    and the system turn but in the conversation's first window), and start and end (code points) of the text that bears
    loss, or nulls. A conversation with a system turn only has that one window. A turn without tokens takes up one when
    windows are cut. Empty tables give none.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be smaller than the budget")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    known = F.col(tokens).cast("long") if tokens else F.regexp_count(text, F.lit(PIECE)).cast("long") + 4
    n = F.coalesce(known, F.lit(0))
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("null"))
    base = turns.select(key.alias("key"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), n.alias("tokens"), F.greatest(n, F.lit(1)).alias("cost"))
    t = _prefix_sums(base)
    head = F.concat(F.lit(START), write_role(F.col("role")), F.lit("\n"))
    row = F.struct("no", F.concat(head, escape(F.col("text")), F.lit(END)).alias("shown"), F.char_length(head).alias("lead"), F.char_length(escape(F.col("text"))).alias("body"), (F.col("role") == "assistant").alias("learnt"), "tokens")
    stride = F.greatest(F.lit(1), F.lit(budget - history) - F.col("system_tokens"))
    first = F.floor(F.col("before") / stride)
    last = F.floor((F.col("before") + F.col("cost") - 1) / stride)
    w = F.struct(first.alias("stride"), F.when(first == last, 0).otherwise(F.col("no")).alias("alone"))
    t = materialize(t.select("key", "no", "before", "cost", "system", row.alias("row"), w.alias("w")), "chat-rows")
    system = t.where("system").select("key", F.col("row").alias("system_row"))
    targets = t.where("not system")
    # The earlier turns that a window may repeat end at its start or before, and start at most `history` before it.
    starts = materialize(targets.groupBy("key", "w").agg(F.min("before").alias("at"), F.min("no").alias("no")), "chat-starts")
    step = max(history, 1)
    at = starts.withColumn("bucket", F.floor(F.col("at") / step))
    past = targets.select("key", "row", "no", "before", "cost").where(F.col("cost") <= history)
    past = past.withColumn("bucket", F.explode(F.sequence(F.floor((F.col("before") + F.col("cost")) / step), F.floor((F.col("before") + history) / step))))
    near = past.alias("p").join(at.alias("s"), ["key", "bucket"]).where((F.col("p.no") < F.col("s.no")) & (F.col("s.at") - F.col("p.before") <= history)).select("key", "w", F.col("p.row").alias("row"), F.lit(True).alias("repeated"))
    told = targets.select("key", "w", "row", F.lit(False).alias("repeated"))
    # The system turn isn't repeated where the first other turn stands.
    kept = starts.join(system, "key").select("key", "w", F.col("system_row").alias("row"), (F.col("no") > 2).alias("repeated"))
    alone = system.join(starts.select("key").distinct(), "key", "left_anti").select("key", F.struct(F.lit(0).cast("long").alias("stride"), F.lit(0).cast("long").alias("alone")).alias("w"), F.col("system_row").alias("row"), F.lit(False).alias("repeated"))
    rows = told.unionByName(near).unionByName(kept).unionByName(alone)
    parts = rows.groupBy("key", "w").agg(F.array_sort(F.collect_list(F.struct(F.col("row.no").alias("no"), "repeated", "row"))).alias("parts"))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<no:bigint,repeated:boolean,start:int,end:int>>").alias("out"))

    def place(acc: Column, p: Column) -> Column:
        a = acc["at"] + p["row"]["lead"]
        bears = ~p["repeated"] & p["row"]["learnt"]
        seg = F.struct(p["no"].alias("no"), p["repeated"].alias("repeated"), F.when(bears, a).alias("start"), F.when(bears, a + p["row"]["body"]).alias("end"))
        return F.struct((acc["at"] + F.char_length(p["row"]["shown"])).alias("at"), F.concat(acc["out"], F.array(seg)).alias("out"))

    fresh = F.filter("parts", lambda p: ~p["repeated"])
    return parts.select(
        F.when(F.col("key") != "null", F.substring("key", 2, 1 << 30)).cast(turns.schema["conv_id"].dataType).alias("conv_id"),
        F.array_min(F.transform(fresh, lambda p: p["no"])).alias("window"),
        F.array_join(F.transform("parts", lambda p: p["row"]["shown"]), "").alias("text"),
        F.aggregate("parts", nothing, place)["out"].alias("segments"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + p["row"]["tokens"]).alias("n_tokens"),
    )


def _parsed(windows: DataFrame) -> DataFrame:
    """windows with turns (no, repeated, role, text, loss: the cut-out part under the mask or null), parsed from the marks."""
    pieces = F.slice(F.split("text", r"<\|im_end\|>\n", -1), F.lit(1), F.size("segments"))

    def turn(piece: Column, seg: Column) -> Column:
        inner = F.substring(piece, len(START) + 1, 1 << 30)
        cut = F.instr(inner, "\n")
        text = F.when(cut > 0, inner.substr(cut + 1, F.lit(1 << 30))).otherwise(F.lit(""))
        loss = F.when(seg["start"].isNotNull(), unescape(F.col("text").substr(seg["start"] + 1, seg["end"] - seg["start"])))
        return F.struct(seg["no"].alias("no"), seg["repeated"].alias("repeated"), read_role(F.substring_index(inner, "\n", 1)).alias("role"), unescape(text).alias("text"), loss.alias("loss"))

    return windows.select("conv_id", "window", F.char_length("text").cast("long").alias("chars"), F.zip_with(pieces, "segments", turn).alias("turns"))


def read_turns(windows: DataFrame) -> DataFrame:
    """A row for each turn, parsed back from windows: conv_id, no, role, text, loss (the part under the mask, or null)."""
    rows = _parsed(windows).select("conv_id", F.explode(F.filter("turns", lambda t: ~t["repeated"])).alias("t"))
    return rows.select("conv_id", "t.no", "t.role", "t.text", "t.loss")


def read_windows(windows: DataFrame) -> DataFrame:
    """Turns and learnt texts parsed back from windows: conv_id, turns (no, role, text, as written), losses, formatted_chars.

    Roles and texts come from the windows' marks alone, and losses are the cut-out parts under the mask, both unescaped
    and in order. A conversation becomes one row, which holds 2 GB at most; read_turns() has no such bound.
    """
    own = F.filter("turns", lambda t: ~t["repeated"])
    got = _parsed(windows).select("conv_id", "window", "chars", F.transform(own, lambda t: F.struct(t["no"], t["role"], t["text"])).alias("turns"), F.transform(F.filter(own, lambda t: t["loss"].isNotNull()), lambda t: t["loss"]).alias("losses"))
    rows = got.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("window", "turns", "losses"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    return rows.select("conv_id", F.flatten(F.transform("w", lambda w: w["turns"])).alias("turns"), F.flatten(F.transform("w", lambda w: w["losses"])).alias("losses"), "formatted_chars")
