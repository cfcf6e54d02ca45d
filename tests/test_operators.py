"""Operators on small made-up tables, against plain Python."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from weft.functions import codes, ids, text
from weft.operators import carry, components, graph, match, nested, pairs, sample
from weft.sources import files
from weft.streaming import state


def values(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_uuid5_is_the_standard_one(spark):
    for name in ("a", "part:é", ""):
        assert one(spark, ids.uuid5(F.lit(name))) == str(uuid.uuid5(uuid.NAMESPACE_URL, name))


def test_pair_id_ignores_order(spark):
    assert one(spark, ids.pair_id(F.lit("b"), F.lit("a"))) == one(spark, ids.pair_id(F.lit("a"), F.lit("b")))


def test_text_keys(spark):
    assert one(spark, text.document_key(F.lit("  Ａ\tb  "))) == "a b"
    assert one(spark, text.document_key(F.lit(None).cast("string"))) == ""
    assert one(spark, text.graph_key(F.lit("Straße"))) == "strasse"
    assert one(spark, text.code_key(F.lit(" (A 1.2) "))) == "a1.2"
    assert one(spark, text.controlled_key(F.lit("Grade--7_b!"))) == "grade 7 b"
    assert one(spark, text.skill_key(F.lit(" Add  two numbers.. "))) == "add two numbers"


def test_grams(spark):
    assert one(spark, text.grams(F.lit("ab"))) == ["ab"]
    assert one(spark, text.grams(F.lit(""))) == []
    assert one(spark, text.grams(F.lit("abab"))) == ["aba", "bab"]
    assert one(spark, text.inner_grams(F.lit("a b c"))) == ["a b", "b c"]


def test_join_units(spark):
    u = F.array(F.lit("exam-"), F.lit("ple one."), F.lit(" "), F.lit("Two"), F.lit("three"))
    assert one(spark, text.join_units(u)) == "example one.\nTwo three"


def test_canonical_json(spark):
    got = spark.createDataFrame([('{"b": 1, "a": [1.5, null]}',), ("NaN",), ("{",), (None,)], "j string").select(ids.canonical_json(F.col("j")).alias("x"))
    assert [r.x for r in got.collect()] == ['{"a":[1.5,null],"b":1}', None, None, None]


def test_occurrence_span(spark):
    span = one(spark, ids.occurrence_span(F.lit("a.b a.b axb"), F.lit("a.b"), F.lit(2)))
    assert (span.start, span.end) == (4, 7)
    assert one(spark, ids.occurrence_span(F.lit("ab"), F.lit("a"), F.lit(2))) is None


def test_captions(spark):
    rows = {
        "Table 2.1: Sums": ("table", "2.1", "Sums"),
        "Fig. IV - x": ("figure", "iv", "x"),
        "Figure 5 - Title": ("figure", "5", "Title"),
        "Table III title": ("table", "iii", " title"),
        "Tableau no 3": ("table", "3", ""),
        "TABLEAU No. 12/b : x": ("table", "12/b", "x"),
        "jedwali 4": ("table", "4", ""),
        "Tbl. 7-a": ("table", "7-a", ""),
        "Kielelezo 2.": ("figure", "2", ""),
        "Mchoro A": ("figure", "a", ""),
        "Schéma 1": ("figure", "1", ""),
        "diagramme n° 3": ("figure", "n", "° 3"),
        "Summary of results": None,
        "Abbildung 3": None,
        "Table": ("table", "l", "e"),
        "Ta": None,
        "": None,
        None: None,
    }
    for label, want in rows.items():
        got = one(spark, codes.parse_caption(F.lit(label).cast("string")))
        assert (got and (got.kind, got.identifier, got.rest)) == want, label


def test_code_offsets(spark):
    df = spark.createDataFrame([(1, "éA1 b22 A1")], "id int, t string")
    got = values(codes.code_matches(df, "t", {"n": "[0-9]+", "a": "A[0-9]"}), "family", "code", "start", "end")
    assert got == [("a", "A1", 1, 3), ("a", "A1", 8, 10), ("n", "1", 2, 3), ("n", "1", 9, 10), ("n", "22", 5, 7)]


@pytest.mark.parametrize("seed", range(4))
def test_components_against_union_find(spark, seed, monkeypatch):
    if seed % 2:
        monkeypatch.setattr(components, "LOCAL_EDGES", -1)
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(None, 3), (7, 7)]
    parent = {x: x for x in range(60)}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    nodes = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    got = values(components.connected_components(spark.createDataFrame(edges, "a int, b int")), "node", "component")
    assert got == sorted((x, root(x)) for x in nodes)


def test_components_of_nothing(spark):
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("most", [-1, 500])
def test_long_path(spark, monkeypatch, most):
    monkeypatch.setattr(components, "LOCAL_EDGES", most)
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components.connected_components(edges).select("component").distinct().collect()[0][0] == 0


def test_strong_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (6, 1), (7, 8)], "a int, b int")
    assert values(graph.strong_components(e), "node", "component") == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)]
    assert graph.strong_components(spark.createDataFrame([(1, 2)], "a int, b int")).count() == 0


def test_strong_components_in_rounds(spark, monkeypatch):
    from weft.operators import assemble

    rng = random.Random(2)
    rows = sorted({(rng.randrange(14), rng.randrange(14)) for _ in range(22)})
    e = spark.createDataFrame(rows, "a int, b int")
    local = values(graph.strong_components(e), "node", "component")
    cycles = values(assemble.shortest_cycle(e.where("a <> b"), graph.strong_components(e)), "component", "cycle", "length")
    monkeypatch.setattr(graph, "LOCAL_EDGES", -1)
    members = spark.createDataFrame(local, "node int, component int")
    assert values(graph.strong_components(e), "node", "component") == local
    assert values(assemble.shortest_cycle(e.where("a <> b"), members), "component", "cycle", "length") == cycles


def test_truncated_paths(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "d")], "child string, parent string")
    got = values(graph.ancestor_paths(e, depth=2, paths=5), "node", "path", "truncated")
    assert ("a", "a>d", False) in got and ("a", "a>b>c", True) in got and ("b", "b>c>d", False) in got


def test_cycle_in_longest_path_is_an_error(spark):
    with pytest.raises(RuntimeError):
        graph.ancestor_distances(spark.createDataFrame([(1, 2), (2, 1)], "child int, parent int"), longest=True, most=6)


@pytest.mark.parametrize("size,overlap", [(4, 1), (3, 0), (5, 2)])
def test_chunks_cover_every_row(spark, size, overlap):
    for n in (1, 3, 4, 5, 9, 12):
        df = spark.range(n).select(F.lit(1).alias("g"), "id")
        got = {}
        for c, i in values(carry.chunks(df, ["g"], ["id"], size, overlap), "chunk", "id"):
            got.setdefault(c, []).append(i)
        step, want, a = size - overlap, {}, 0
        while True:
            want[len(want)] = list(range(a, min(n, a + size)))
            if a + size >= n:
                break
            a += step
        assert got == want


def test_greedy_match(spark):
    rows = [(1, 1, 1, 5.0), (1, 1, 2, 4.0), (1, 2, 1, 6.0), (1, 2, 2, 6.0), (1, 3, 3, 1.0)]
    df = spark.createDataFrame(rows, "g int, l int, r int, s double")
    assert values(match.greedy_match(df, "g", "l", "r", "s", 2.0), "l", "r") == [(1, 2), (2, 1)]


def test_scores(spark):
    t, f = F.lit(True), F.lit(False)
    assert one(spark, match.block_score(F.lit("paragraph"), F.lit("list"), t, t, f)) == 4.0
    assert one(spark, match.block_score(F.lit("caption"), F.lit("caption"), t, f, t)) == 6.0
    assert one(spark, match.table_score(F.lit(1), f, t, t, t, t, f, F.lit(0.95))) == 5.5
    assert one(spark, match.table_score(F.lit(2), t, t, t, t, t, t, F.lit(0.95))) == 8.5


def test_budgets(spark):
    rows = [("s", 1, "a", "b"), ("s", 2, "a", "c"), ("s", 3, "c", "d"), ("s", 4, "e", "f")]
    df = spark.createDataFrame(rows, "scope string, place int, item_a string, item_b string")
    assert values(pairs.within_budgets(df, "scope", "place", 1, 2), "place") == [(1,), (3,)]


def test_rotation_pairs(spark):
    for n in range(2, 9):
        items = spark.range(n).withColumnRenamed("id", "x")
        got = values(pairs.cyclic_pairs(items, "x", 1000), "item_a", "item_b")
        assert got == [(a, b) for a in range(n) for b in range(a + 1, n)]
        few = pairs.cyclic_pairs(items, "x", n)
        assert few.count() == min(n, n * (n - 1) // 2)


def test_grid():
    rows = [[("a", 2, 1), ("b", 1, 2)], [("c", 1, 1)]]
    assert nested.grid_of(rows) == [(0, 0, "a", 0, 0), (0, 1, "b", 0, 1), (0, 2, "b", 0, 1), (1, 0, "a", 0, 0), (1, 1, "c", 1, 0)]


def test_html_cells(spark):
    html = "<table><tr><th colspan=2>A<b>x</b></th></tr><tr><td rowspan='3'>1</td><td>2</table><p>no</p>"
    got = values(nested.html_cells(spark.createDataFrame([(1, html), (2, None)], "p long, h string"), "p", "h"), "row", "cell", "text", "row_span", "col_span")
    assert got == [(0, 0, "Ax", 1, 2), (1, 0, "1", 3, 1), (1, 1, "2", 1, 1)]


def test_padding_and_flags(spark):
    rows = spark.createDataFrame([(1, ["", "a", "b"]), (1, ["", "c", "d"]), (1, ["", "e", "f"]), (1, ["g", "h"]), (2, ["a"]), (2, ["b", "c"])], "t int, cells array<string>")
    got = {tuple(r.cells) for r in nested.pad_rows(rows, "t", "cells").collect()}
    assert ("", "g", "h") in got and ("a", "") in got
    items = spark.createDataFrame([(1, "complete"), (2, "both"), (3, "resumed")], "id int, boundary string")
    edges = spark.createDataFrame([(1, 2, True, 0.9), (2, 3, False, 0.9), (1, 3, True, 0.1)], "prev_id int, next_id int, continues boolean, confidence double")
    assert values(nested.fold_flags(items, edges, 0.5), "id", "boundary") == [(1, "truncated"), (2, "resumed"), (3, "complete")]


def test_samples_ignore_order(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 3)
    a = values(sample.stratified(df, ["g"], "id", F.lit(7), "s"), "id")
    assert a == values(sample.stratified(df.repartition(7).orderBy(F.desc("id")), ["g"], "id", F.lit(7), "s"), "id") and len(a) == 21


def test_prefixes_and_ledgers(spark, tmp_path):
    done = spark.createDataFrame([("a", 0), ("a", 1), ("a", 3), ("b", 1)], "g string, i long")
    assert values(state.contiguous_prefix(done, ["g"], "i"), "g", "i") == [("a", 0), ("a", 1)]
    logs = [spark.createDataFrame([(k,) for k in x], "i long") for x in ((0, 1, 2, 4), (0, 1, 2, 3), (0, 1))]
    assert values(state.trusted_prefix(logs, "i"), "i") == [(0,), (1,)]
    assert state.trusted_prefix(logs, "i", lambda df: df.where("i = 1")).count() == 0
    path = f"file://{tmp_path}/log"
    for _ in range(2):
        state.append_once(done, path, ["g", "i"])
    assert spark.read.parquet(path).count() == 4
    events = spark.createDataFrame([("l", 1, "x"), ("l", 2, "y")], "g string, n int, p string")
    chained = state.chain_hashes(events, ["g"], ["n"], "p", "seed").join(events, ["g", "n"]).withColumnRenamed("hash", "kept")
    assert state.broken_chain(chained, ["g"], ["n"], "p", "kept", "seed").count() == 0
    assert values(state.broken_chain(chained.withColumn("p", F.when(F.col("n") == 1, "z").otherwise(F.col("p"))), ["g"], ["n"], "p", "kept", "seed"), "n") == [(1,), (2,)]


def test_stream_is_replayed_once(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"file://{tmp_path}/out"
    spark.range(10).write.parquet(source)
    stream = spark.readStream.schema("id long").parquet(source)
    for k in range(2):
        q = state.stream_into(stream, out, f"{tmp_path}/check{k}", ["id"])
        q.awaitTermination()
    assert spark.read.parquet(out).count() == 10


def test_json_sources(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"a": 1}\n{"a": 2}\n{"a": \n{"a": 4}\n')
    assert values(files.read_valid_prefix(spark, str(p), "a int"), "a") == [(1,), (2,)]
    q = tmp_path / "b.jsonl"
    q.write_text('{"a": 1, "a": 2}\n')
    with pytest.raises(Exception, match="repeated key"):
        files.read_strict(spark, str(q), "a int").collect()
    with pytest.raises(ValueError):
        files.read_json(spark, "x.csv")
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    manifest = files.freeze(rows, str(tmp_path / "f"), "k")
    assert files.altered(spark, str(tmp_path / "f"), manifest, "k").count() == 0
    assert files.page_range(5, None, None) == (1, 5)
    with pytest.raises(ValueError):
        files.page_range(5, 2, 9)


def test_text_gate(spark):
    assert one(spark, files.text_gate(F.lit("short"))) == "short"
    assert one(spark, files.text_gate(F.lit("a" * 50 + "�" * 5))) == "replaced"
    assert one(spark, files.text_gate(F.lit("a plain page of text, long enough"))) is None
