"""Operators on documents, evidence, duplicates and reports, against plain Python and by hand."""

from __future__ import annotations

import io
import itertools
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from weft.functions import codes, text
from weft.operators import assemble, carry, checks, dedup, graph, match, metrics, nested, pairs, resolve, sample
from weft.sources import files
from weft.streaming import state


def values(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_headings_with_other_items_between(spark):
    rows = [(1, k, h) for k, h in enumerate(["A", None, None, None, "B", "C", None, " ", None, "D"])] + [(2, 0, None)]
    got = assemble.neighbour_headings(spark.createDataFrame(rows, "page int, item int, h string"), "page", "item", F.col("h"))
    by = {(r.page, r.item): (r.headings_before, r.headings_after) for r in got.collect()}
    assert by[1, 3] == ("A", "B | C") and by[1, 8] == ("B | C", "D") and by[1, 0] == ("", "B | C") and by[1, 5] == ("A | B", "D") and by[2, 0] == ("", "")
    got = assemble.neighbour_headings(spark.createDataFrame(rows, "page int, item int, h string"), "page", "item", F.col("h"), most=3)
    assert {(r.page, r.item): r.headings_before for r in got.collect()}[1, 9] == "A | B | C"


def test_equal_rows_keep_paths_of_their_own(spark):
    rows = [(1, 1, "A"), (1, 1, "A"), (1, 2, " a "), (1, 3, None), (1, 4, "B"), (1, 5, "C"), (1, 6, "D"), (1, 7, "")]
    got = carry.heading_path(spark.createDataFrame(rows, "g int, i int, h string"), "h", ["g"], ["i"], most=3)
    assert values(got, "i", "path") == [(1, "A"), (1, "A"), (2, "A"), (3, "A"), (4, "A > B"), (5, "A > B > C"), (6, "B > C > D"), (7, "B > C > D")]


@pytest.mark.parametrize("text_value,y0,y1,noise", [("12", 10, 30, True), ("xii", 950, 990, True), ("Page 3 / 10", 10, 30, True), ("3", 500, 520, False), ("3", 50, 200, False), ("1.2-3 iv", 10, 30, False), ("3 of 10", 10, 30, False), ("A very long running header string", 10, 30, False), (" ", 10, 30, False), (None, 10, 30, False), ("7", 55, 70, True), ("7", 900, 945, True)])
def test_page_noise(spark, text_value, y0, y1, noise):
    assert one(spark, match.page_noise(F.lit(text_value).cast("string"), F.lit(float(y0)), F.lit(float(y1)), F.lit(1000.0))) is noise


def test_header_scores_count_characters(spark):
    score = lambda *c: one(spark, nested.header_score(F.array(*map(F.lit, c))))
    assert score("Topic", "Expected Standard") == pytest.approx(3.0) and score("1", "2") == pytest.approx(-0.5) and score("", " ") == 0.0
    assert score("Week 1", "") == pytest.approx(2 * 4 / 5 + 0.5 - 1.5 / 5)
    rows = spark.createDataFrame([(1, 0, ["Topic", "Expected Standard"]), (1, 1, ["1", "2"]), (2, 0, ["1", "2"]), (2, 1, ["3", "4"])], "t int, i int, cells array<string>")
    got = {r.t: (r.n_header, r.confidence) for r in nested.header_rows(rows, "t", "i", "cells").collect()}
    assert got[1][0] == 1 and got[1][1] > 0.65 and got[2] == (0, 0.0)


def test_overlapping_spans_are_an_error(spark):
    with pytest.raises(ValueError):
        nested.grid_of([[("a", 1, 1), ("b", 2, 1)], [("c", 1, 2)]])
    cells = spark.createDataFrame([(1, 0, 0, "a", 2, 1), (1, 0, 1, "b", 1, 2), (1, 1, 0, "c", 1, 1), (None, 0, 0, "n", 1, 1)], "t int, row int, cell int, text string, row_span int, col_span int")
    got = {(r.t, r.row, r.col): r.text for r in nested.expand_grid(cells, "t").collect()}
    assert got == {(1, 0, 0): "a", (1, 0, 1): "b", (1, 0, 2): "b", (1, 1, 0): "a", (1, 1, 1): "c", (None, 0, 0): "n"}


STITCH = [
    # base header, declared by the next slice, its flag, its rows, how many rows are dropped
    ([["A", "B"], ["x", "y"]], 0, None, [["a ", "b"], ["X", "y"], ["1", "2"]], 2),
    ([["A", "B"], ["x", "y"]], 0, False, [["A", "B"], ["x", "y"], ["1", "2"]], 0),
    ([["A", "B"], ["x", "y"]], 1, True, [["A", "B"], ["1", "2"]], 1),
    ([["A", "B"], ["x", "y"]], 1, None, [["A", "B"], ["1", "2"]], 1),
    ([["A", "B"], ["x", "y"]], 0, True, [["A", "B"], ["1", "2"]], 0),
    ([["A", "B"]], 1, True, [["Checkpoint", ""], ["1", "2"]], 0),
    ([["A", "B"]], 3, True, [["A", "B"], ["1", "2"]], 1),
]


@pytest.mark.parametrize("head,declared,flag,rows,dropped", STITCH)
def test_repeated_headers(spark, head, declared, flag, rows, dropped):
    slices = [("c", 1, [*head, ["0", "0"]], len(head), None, len(head)), ("c", 2, rows, None, flag, declared)]
    df = spark.createDataFrame(slices, "chain string, place int, rows array<array<string>>, header int, repeats boolean, declared int")
    got = nested.stitch_rows(df, "chain", "place", "rows", "header", "repeats", "declared")
    assert got.where("slice = 2").count() == len(rows) - dropped
    assert [r.row for r in got.orderBy("row").collect()] == list(range(len(head) + 1 + len(rows) - dropped))


def test_stitched_tables_and_blocks(spark):
    slices = [(1, 1, [["Topic", "Expected Standard"], ["1", "2"]], 0, None, None), (1, 2, [["topic", "expected standard"], ["3", "4"]], 0, None, "Tableau 4"), (1, 3, [["5", "6"]], 0, None, "Table 4"), (2, 1, [["1", "2"]], 0, None, "Tab. 1"), (2, 2, [["3", "4"]], 0, None, "Table 2")]
    rows, tables = nested.stitch_tables(spark.createDataFrame(slices, "c int, p int, rows array<array<string>>, header int, repeats boolean, code string"), "c", "p")
    assert values(tables, "c", "n_slices", "n_rows", "n_header", "code", "conflict") == [(1, 3, 4, 1, "Tableau 4", False), (2, 2, 2, 0, "Tab. 1", True)]
    assert rows.count() == 6
    blocks = [(1, 1, "exam-", "en", ["a"], None, None, "paragraph"), (1, 2, "ple one.", "en", None, "fig", " Fig. 2 ", "list"), (1, 3, "Deux", "fr", ["b", "c"], "other", "X", "list"), (2, 1, None, None, None, None, None, "figure")]
    got = nested.stitch_blocks(spark.createDataFrame(blocks, "c int, p int, text string, language string, items array<string>, figure string, code string, block_type string"), "c", "p")
    by = {r.c: r for r in got.collect()}
    assert (by[1].text, by[1].language, by[1]["items"], by[1].figure, by[1].code, by[1].block_type) == ("example one.\nDeux", "mul", ["a", "b", "c"], "fig", "Fig. 2", "paragraph")
    assert (by[2].text, by[2].language, by[2]["items"], by[2].figure) == (None, None, [], None)


def test_padding_by_header_and_by_blanks(spark):
    rows = [(1, 0, True, False, ["a", "b", "c"]), (1, 1, False, False, ["x"]), (2, 0, True, False, ["a"]), (2, 1, False, False, ["p", "q"]), (2, 2, False, False, ["p", "q", "r"])]
    rows += [(3, k, False, False, ["", "q", "r"]) for k in range(3)] + [(3, 3, False, False, ["z"])] + [(4, k, False, True, ["", "q", "r"]) for k in range(3)] + [(4, 3, False, False, ["z"])]
    df = spark.createDataFrame([(*r, 3) for r in rows], "t int, i int, head boolean, made boolean, cells array<string>, width int")
    got = {(r.t, r.i): r.cells for r in nested.pad_rows(df, "t", "cells", header="head", width="width", synthetic="made").collect()}
    assert got[1, 1] == ["", "", "x"] and got[2, 1] == ["p", "q", ""] and got[2, 0] == ["a", "", ""] and got[3, 3] == ["", "", "z"] and got[4, 3] == ["z", "", ""]


def test_caption_codes(spark):
    rows = [
        (1, 0, "caption", None, "Figure 2: A"), (1, 1, "other", None, None), (1, 2, "figure", None, None), (1, 3, "figure", None, None),
        (2, 0, "caption", None, "Table 1"), (2, 1, "other", None, None), (2, 2, "caption", None, "Tableau 2 - B"), (2, 3, "artifact", None, None), (2, 4, "table", None, None),
        (3, 0, "caption", "Table 3.2", "Tableau 99: x"), (3, 1, "table", "Table 7", None), (4, 0, "caption", None, "no label"), (4, 1, "table", None, None),
        (5, 0, "caption", None, "Tab. 4"), (5, 1, "table", "tableau 4", None),
    ]
    got = match.caption_codes(spark.createDataFrame(rows, "page int, item int, kind string, code string, text string"))
    by = {(r.page, r.item): (r.code, r.conflict) for r in got.collect()}
    assert by[1, 0] == ("Figure 2", False) and by[1, 2] == ("Figure 2", False) and by[1, 3] == (None, False)
    assert by[2, 0] == ("Table 1", False) and by[2, 4] == ("Tableau 2", False)
    assert by[3, 1] == ("Table 7", True) and by[4, 1] == (None, False) and by[5, 1] == ("tableau 4", False)


def brute_rules(a, b, units, stop, pack):
    words = lambda t: set(re.findall(r"\w+", t.lower()))

    def fold(t):
        for p in pack["prefixes"]:
            if t.startswith(p) and len(t) > len(p) + 1:
                t = t[len(p) :]
                break
        for s in pack["suffixes"]:
            if len(t) >= 5 and t.endswith(s):
                return t[: -len(s)]
        return t

    def token_rules(s, t, suffix):
        if not s or not t:
            return []
        n = len(s & t)
        return [f"token_identical{suffix}"] * (s == t) + [f"token_jaccard{suffix}"] * (n / len(s | t) >= 0.55) + [f"containment{suffix}"] * (n >= 2 and n / min(len(s), len(t)) >= 0.75)

    def grams(t):
        t = re.sub(r"[^a-z0-9]+", " ", t).strip()
        return {t} if len(t) <= 3 else {t[i : i + 3] for i in range(len(t) - 2)}

    share = lambda s, t: len(s & t) / len(s | t) if s and t else 0
    bag = lambda t: {fold(w) for tag in units[t]["tags"] for w in words(tag)}
    packed = lambda t: {fold(w) for w in words(t) - set(pack["stopwords"])}
    rules = token_rules(words(a) - stop, words(b) - stop, "") + token_rules(packed(a), packed(b), "_pack")
    rules += ["trigram_jaccard"] * (share(grams(a), grams(b)) >= 0.6) + ["tag_jaccard"] * (share(bag(a), bag(b)) >= 0.5)
    near = any(len([t for t in units if p in units[t]["parents"]]) <= 4 for p in units[a]["parents"] & units[b]["parents"])
    return ",".join(sorted(rules + ["neighborhood"] * near))


def test_blocked_pairs_by_all_rules(spark):
    rng = random.Random(9)
    vocabulary = "add adds adding number numbers count counted the of small smaller unsmall line lines two three".split()
    pack = {"stopwords": ["the", "of"], "prefixes": ["un"], "suffixes": ["ing", "ed", "er", "s"]}
    rows = [(f"s{rng.randrange(2)}", " ".join(rng.sample(vocabulary, rng.randint(1, 7))), rng.choice(["big tags", "tag one", "other", None]), rng.choice(["p1", "p2", "p3", "p4", "p5", "p6", None])) for _ in range(80)]
    df = spark.createDataFrame(rows, "scope string, text string, tag string, parent string")
    got = dedup.blocked_pairs(df, "scope", "text", tags="tag", parents="parent", neighbourhood=4, pack=pack, stop_share=0.4)
    want = []
    for scope in ("s0", "s1"):
        units = {}
        for s, t, g, p in rows:
            if s == scope:
                u = units.setdefault(t, {"tags": set(), "parents": set()})
                u["tags"] |= {g} - {None}
                u["parents"] |= {p} - {None}
        tokens = [set(t.split()) for t in units]
        stop = {w for w in vocabulary if sum(w in s for s in tokens) > 0.4 * len(tokens)}
        for a, b in itertools.combinations(sorted(units), 2):
            if rules := brute_rules(a, b, units, stop, pack):
                want.append((scope, a, b, rules))
    assert values(got, "scope", "text_a", "text_b", "rules") == sorted(want) and len(want) > 50


def test_similar_pairs(spark):
    rng = random.Random(4)
    sets = {k: sorted(set(rng.choices(range(30), k=rng.randint(1, 20)))) for k in range(60)}
    got = dedup.similar_pairs(spark.createDataFrame(list(sets.items()), "k int, s array<int>"), "k", "s", 0.4)
    want = [(a, b, len({*sets[a]} & {*sets[b]}), len({*sets[a]} | {*sets[b]})) for a, b in itertools.combinations(sets, 2)]
    assert values(got, "item_a", "item_b", "n_common", "n_total") == sorted(w for w in want if w[2] >= 0.4 * w[3])


def brute_clusters(texts, judged):
    """Clusters of sorted SAME links that never join a DISTINCT pair."""
    of = {t: {t} for t in texts}
    apart = {frozenset(p) for p, same in judged.items() if not same}
    for (a, b), same in sorted(judged.items()):
        if same and of[a] is not of[b] and not any(frozenset((x, y)) in apart for x in of[a] for y in of[b]):
            of[a] |= of[b]
            for x in of[b]:
                of[x] = of[a]
    return {frozenset(c) for c in of.values()}


def test_claims_end_to_end(spark):
    rng = random.Random(6)
    vocabulary = "add two numbers count small large".split()
    claims = [(f"s{rng.randrange(3)}", k, " ".join(rng.sample(vocabulary, rng.randint(2, 4))).capitalize() + rng.choice(["", ".", " ..", "  "])) for k in range(90)]
    key = lambda t: re.sub(r"\.+$", "", re.sub(r"\s+", " ", t.lower().strip())).strip()
    units = {}
    for s, k, t in claims:
        units.setdefault((s, key(t)), []).append(k)
    judged = {(s, a, b): rng.random() < 0.6 for s in ("s0", "s1", "s2") for a, b in itertools.combinations(sorted(t for x, t in units if x == s), 2) if rng.random() < 0.7}
    decisions = spark.createDataFrame([(s, *(rng.sample([a, b], 2)), same) for (s, a, b), same in judged.items()], "scope string, text_a string, text_b string, same boolean")
    groups, pending, _ = dedup.dedup_claims(spark.createDataFrame(claims, "scope string, seed long, text string"), decisions, stop_share=1.0)
    blocked = {(r.scope, r.text_a, r.text_b) for r in dedup.blocked_pairs(spark.createDataFrame([(s, t) for s, t in units], "scope string, text string"), "scope", "text", stop_share=1.0).collect()}
    assert {(r.scope, r.text_a, r.text_b) for r in pending.collect()} == blocked - set(judged)
    want = []
    for s in ("s0", "s1", "s2"):
        texts = [t for x, t in units if x == s]
        for c in brute_clusters(texts, {(a, b): v for (x, a, b), v in judged.items() if x == s and (x, a, b) in blocked}):
            n = sum(len(units[s, t]) for t in c)
            if len(c) > 1 or n > 1:
                want.append((s, min(c, key=lambda t: (-len(units[s, t]), len(t), t)), sorted(c), n, sorted(k for t in c for k in units[s, t])))
    assert values(groups, "scope", "canonical", "texts", "n_claims", "seeds") == sorted(want)


def test_scopes_of_claims(spark):
    path = F.array(F.struct(F.lit("t").alias("id"), F.array().cast("array<string>").alias("parents")), F.struct(F.lit("m").alias("id"), F.array(F.lit("t")).alias("parents")))
    key = lambda kind, ok=True: one(spark, dedup.dedup_scope(kind, F.lit(7), path, F.array(F.lit("q"), F.lit("p")), F.lit(ok)))
    assert [key(k) for k in ("framework", "none", "top_ancestor", "parent")] == ["framework", "7", "t", "p|q"]
    assert key("parent", False) == "7" and key("framework", False) == "framework"


def test_parent_order_and_overflow(spark):
    rows = [("c1", "a", ["identity_scope_complete_parent_match", "identity_scope_direct_parent_conflict"]), ("c1", "b", ["same_table_context"]), ("c1", "c", ["statement_type_compatible"]), ("c1", "d", ["same_source_segment", "active_outline_stack_parent"])]
    rows += [("c2", p, ["code_parent_hint"]) for p in "abc"]
    df = spark.createDataFrame(rows, "child string, parent string, reasons array<string>")
    children = spark.createDataFrame([("c1",), ("c2",), ("c3",)], "child string")
    got = resolve.bounded_parents(df, "child", "parent", most=4, must=resolve.DECISIVE, children=children)
    assert values(got.where("child <> 'c2'"), "child", "place", "parent", "tier", "weight") == [("c1", 1, "a", 0, 40), ("c1", 2, "b", 3, 85), ("c1", 3, "d", 4, 130), ("c1", 4, "root", 90, 0), ("c3", 1, "root", 90, 0)]
    with pytest.raises(Exception, match="must-keep"):
        resolve.bounded_parents(df, "child", "parent", most=3, must=resolve.DECISIVE).collect()
    loose = resolve.bounded_parents(df, "child", "parent", most=3, must=resolve.DECISIVE, strict=False)
    assert {r.child: r.overflow for r in loose.collect()} == {"c1": False, "c2": True}


def test_rotation_limits(spark):
    items = spark.range(11).withColumnRenamed("id", "x")
    order = []
    for d in range(1, 6):
        order += [tuple(sorted((i, (i + d) % 11))) for i in range(11)]
    for most in (1, 5, 11, 12, 30, 55, 99):
        assert values(pairs.cyclic_pairs(items, "x", most), "item_a", "item_b") == sorted(order[:most])
    assert pairs.cyclic_pairs(items.limit(1), "x", 5).count() == 0


def test_prefixes_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(state, "BLOCK", 4)
    rows = [("a", i) for i in range(11) if i != 9] + [("b", i) for i in (1, 2)] + [("c", i) for i in range(8)] + [("d", i) for i in (0, 1, 4, 5, 6, 7)] + [("a", 3)]
    got = values(state.contiguous_prefix(spark.createDataFrame(rows, "g string, i long"), ["g"], "i"), "g", "i")
    assert got == sorted([("a", i) for i in range(9)] + [("a", 3)] + [("c", i) for i in range(8)] + [("d", 0), ("d", 1)])
    assert values(state.contiguous_prefix(spark.createDataFrame([(i,) for i in (0, 1, 2, 3, 4, 6)], "i long"), [], "i"), "i") == [(i,) for i in range(5)]


def test_longest_depth(spark):
    e = spark.createDataFrame([(2, 1), (3, 2), (4, 3), (4, 1), (9, 1)], "child int, parent int")
    assert values(graph.longest_depth(e), "node", "depth") == [(2, 1), (3, 2), (4, 3), (9, 1)]
    with pytest.raises(RuntimeError):
        graph.longest_depth(spark.createDataFrame([(1, 2), (2, 1)], "child int, parent int"))


def test_siblings_without_pairs(spark):
    rng = random.Random(5)
    rows = [(f"c{k}", f"p{rng.randrange(6)}") for k in range(30)] + [(f"c{k}", f"p{rng.randrange(6)}") for k in range(5)]
    e = spark.createDataFrame(rows, "child string, parent string")
    found = {}
    for a, b in values(graph.siblings(e), "node", "sibling"):
        found.setdefault(a, set()).add(b)
    assert values(graph.sibling_counts(e), "node", "n", "first_sibling") == sorted((a, len(s), min(s)) for a, s in found.items())


def test_gates(spark):
    nodes = spark.createDataFrame([("root", "r"), ("a", "k"), ("b", "k")], "id string, kind string")
    edges = spark.createDataFrame([("a", "root"), ("b", "a")], "child string, parent string")
    sound = checks.graph_report(nodes, edges, root="root", expected={"nodes": 3, "edges": 2})
    assert sound.agg(F.sum("n")).first()[0] == 0 and checks.gate(sound) == []
    bad = checks.graph_report(nodes, edges.limit(1), root="root", expected={"nodes": 4, "edges": 1})
    assert {r.rule: r.examples for r in bad.where("n > 0").collect()} == {"unreachable": ["b"], "wrong_count": ["nodes 3"]}
    assert checks.gate(bad, ("unreachable", "wrong_count")) == ["unreachable", "wrong_count"]
    with pytest.raises(ValueError, match="unreachable"):
        checks.gate(bad, ("wrong_count",))


def test_anchors(spark):
    units = spark.createDataFrame([("u", 1, "one two one two"), ("v", 2, "three (x) four")], "unit string, order int, text string")
    rows = [(1, 0, "u", "one", 1), (1, 1, "u", "two one", 1), (1, 2, "v", "(x)", 1), (2, 0, "u", "two", 2), (2, 1, "u", "one", 1), (3, 0, "u", "one", 3), (3, 1, "w", "x", 1), (4, 0, "u", "one two", 1), (4, 1, "u", "two one", 1), (5, 0, "v", "three", 1), (5, 1, "v", "four", 1)]
    anchors = spark.createDataFrame(rows, "candidate int, place int, unit string, excerpt string, nth int")
    texts = spark.createDataFrame([(1, "one two one\n(x)"), (5, "three and four"), (4, None)], "candidate int, text string")
    got = sorted((r.candidate, -1 if r.place is None else r.place, r.fault) for r in assemble.anchor_faults(anchors, units, texts).collect())
    assert got == [(2, 1, "out_of_order"), (3, 0, "absent"), (3, 1, "unknown_unit"), (4, -1, "text_differs"), (4, 1, "overlap"), (5, -1, "text_differs")]


def test_negative_controls(spark):
    rows = [(k, [f"Part {j} of {k}, with some more words here." for j in range(k % 4)], "x" if k < 10 else "y", f"s{k % 3}") for k in range(14)] + [(20, None, "x", "s1"), (21, ["alone."], "z", "s0")]
    df = spark.createDataFrame(rows, "item int, parts array<string>, curriculum string, strand string")
    got = sample.corruptions(df, "item", "parts", curriculum="curriculum", strand="strand").collect()
    assert sorted(got) == sorted(sample.corruptions(df.repartition(5), "item", "parts", curriculum="curriculum", strand="strand").collect())
    by = {(r["item"], r.kind): r.parts for r in got}
    told = {k: (p or [], c, s) for k, p, c, s in rows}
    tail = "with some more words here"
    for k, (p, c, s) in told.items():
        n = len(p)
        assert ((k, "bundled_components") in by) == ((k, "collapsed_set") in by) == (n >= 2)
        assert ((k, "under_decomposition") in by) == (n >= 3) and ((k, "forced_redundancy") in by) == (n >= 1)
        if n >= 2:
            assert len(by[k, "bundled_components"]) == n - 1 and "; " in " ".join(by[k, "bundled_components"]) and by[k, "collapsed_set"] == ["; ".join(x.rstrip(".") for x in p)]
        if n:
            twice = by[k, "forced_redundancy"]
            assert twice[:n] == p and twice[n] in p
        others = [x for i, (q, d, z) in told.items() if d == c and z != s for x in q]
        assert ((k, "cross_strand_swap") in by) == bool(n and others)
        if (k, "cross_strand_swap") in by:
            new = [x for x in by[k, "cross_strand_swap"] if x not in p]
            assert len(new) == 1 and new[0] in others
        donors = [x for i, (q, d, _) in told.items() if d == c and i != k for x in q]
        if (k, "invented_specificity") in by:
            assert any(x.endswith(f"({tail})") for x in by[k, "invented_specificity"])
        else:
            assert not n or not donors or c == "z"
        if (k, "truncation") in by:
            assert sum(len(x.split()) == 5 for x in by[k, "truncation"]) == 1


def test_runs_and_reports(spark, tmp_path):
    for run, names in {"a/run1": ["x.json", "y.jsonl"], "b/run2": ["x.json"], "c": ["x.json", "y.jsonl"], "d": ["z.json"], "e": ["x.json", "y.jsonl", "z.json"]}.items():
        (tmp_path / "runs" / run).mkdir(parents=True)
        for n in names:
            (tmp_path / "runs" / run / n).write_text('{"n": "%s"}' % (n if run != "e" else "other"))
    got = files.discover_runs(spark, str(tmp_path / "runs"), ["x.json", "y.jsonl"])
    assert sorted((r.run, r.status, tuple(r.missing), r.alias_of) for r in got.collect()) == [("a/run1", "complete", (), None), ("b/run2", "partial", ("y.jsonl",), None), ("c", "complete", (), "a/run1"), ("d", "skipped", ("x.json", "y.jsonl"), None), ("e", "complete", (), None)]
    edges = spark.createDataFrame([("c2", 1), ("c1", 1), ("c1", 1), ("c3", 9)], "component string, item int")
    population = files.evaluation_population(spark.createDataFrame([(1, "r"), (2, "q")], "item int, text string"), edges)
    assert [(r["item"], r.text, r.components) for r in population.collect()] == [(1, "r", ["c1", "c2"])]
    tables = {"rates": spark.createDataFrame([("a<b", 1.5, None)], "name string, rate double, note string"), "none": spark.createDataFrame([], "x int")}
    page = files.html_report(tables, "R & D")
    assert "<h1>R &amp; D</h1>" in page and "<td>a&lt;b</td><td>1.5</td><td></td>" in page and "<th>x</th>" in page
    book = zipfile.ZipFile(io.BytesIO(files.workbook(tables)))
    sheet = book.read("xl/worksheets/sheet1.xml").decode()
    assert book.testzip() is None and "a&lt;b" in sheet and "<v>1.5</v>" in sheet and 'name="none"' in book.read("xl/workbook.xml").decode()
    import xml.dom.minidom

    for n in book.namelist():
        xml.dom.minidom.parseString(book.read(n))


def test_file_order(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"p{k}.jsonl").write_text("".join('{"a": %d}\n' % (10 * k + i) for i in range(3)) + ("{bad\n" if k == 1 else ""))
    assert [r.a for r in files.read_valid_prefix(spark, str(tmp_path), "a int").collect()] == [0, 1, 2, 10, 11, 12]


def test_folded_affixes(spark):
    pack = (["un", "re"], ["ing", "s"])
    fold = lambda t: one(spark, text.fold_affixes(F.lit(t), *pack))
    assert [fold(t) for t in ("unadding", "uns", "una", "cats", "adds", "lines", "reuns")] == ["add", "uns", "una", "cats", "adds", "line", "uns"]


def test_comparable_codes(spark):
    code = lambda c: one(spark, codes.comparable_code(F.lit(c).cast("string")))
    assert code("Tableau 4") == code("TAB. 4") == "table 4" and code(" Unit  7 ") == "unit 7" and code(" ") is None and code(None) is None


def test_spread_and_features(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "g string, v double")
    assert values(df.groupBy("g").agg(metrics.spread(F.col("v")).alias("s")), "g", "s") == [("a", 1.0), ("b", 0.0)]
    edges = spark.createDataFrame([("x", "p"), ("x", "q"), ("y", "x"), ("z", "p")], "child string, parent string")
    uses = spark.createDataFrame([(i, "c") for i in ("x", "y", "z")] + [("z", "d")], "item string, component string")
    got = {r.node: (r.parents, r.children, r.components, r.reused, r.below_many) for r in metrics.endpoint_features(edges, uses, least=3).collect()}
    assert got == {"x": (2, 1, 1, True, True), "y": (1, 0, 1, True, True), "z": (1, 0, 2, True, False), "p": (0, 2, 0, False, False), "q": (0, 1, 0, False, False)}
