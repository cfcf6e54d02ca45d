"""Training-data operators on inputs that lie beyond what earlier versions looked at."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from weft.llm import decontaminate, mixing


def test_excerpts_that_begin_anywhere(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    items = [(i, prose(60)[:n].strip()) for i, n in enumerate([200, 210, 330, 140, 150, 390])]
    cuts = {0: (30, 170), 1: (31, 180), 2: (35, 215), 3: (0, 105), 4: (40, 125), 5: (170, 252)}
    docs = [(i, f"{prose(40)} {items[i][1][a:b]} {prose(40)}") for i, (a, b) in cuts.items()]
    docs += [(100 + i, f"{prose(40)} {t[20:75]} {prose(40)}") for i, t in items]
    docs += [(200, "well, Short  item! then"), (201, "shorts item then short items"), (202, prose(200))]
    bench = spark.createDataFrame([*items, (50, "short item.")], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.find_leaks(frame, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [*((i, i) for i in cuts), (200, 50)]
    text = dict(docs)
    for r in got:
        if r.item_id != 50:
            a, b = cuts[r.item_id]
            assert r.edits == 0 and items[r.item_id][1][a:b].strip() in text[r.doc_id][r.start - 8 : r.end + 8] and r.end - r.start <= b - a + 16
    assert text[200][[r for r in got if r.item_id == 50][0].start :].startswith("Short  item")
    assert decontaminate.without_leaks(frame, bench).count() == len(docs) - 7


def test_full_cells_pass_their_tokens_on(spark):
    """Rare values get all they have, the others the rest of the budget; reachable targets are met."""
    cells = [("a", "x", 9000), ("a", "y", 500), ("b", "x", 400), ("b", "y", 100)]
    docs = spark.createDataFrame([(k, "t", s, l, n) for k, (s, l, n) in enumerate(cells)], "doc_id long, text string, source string, lang string, n long")
    share = lambda **v: spark.createDataFrame(list(v.items()), "value string, share double")
    targets = {"source": share(a=0.9, b=0.1), "lang": share(x=0.85, y=0.15), "topic": share(brief=1.0)}
    got = mixing.mix(docs, tokens=F.col("n"), targets=targets, budget=0.45).withColumn("e", F.col("mix_probability") * F.col("n"))
    total = got.agg(F.sum("e")).first()[0]
    by = {r[0]: r[1] / total for d in ("source", "lang") for r in got.groupBy(d).agg(F.sum("e")).collect()}
    assert abs(total - 4500) < 1 and all(r.mix_probability <= 1 for r in got.collect())
    # b has 500 tokens for the 450 it is due; y has 600 for 675 and gets these, x the rest.
    assert abs(by["b"] - 0.1) < 1e-3 and abs(by["y"] - 600 / 4500) < 1e-3
