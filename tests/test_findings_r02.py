"""Inputs on which queries and operators differed from their SQL in round 2."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from weft.llm import jaccard_join
from weft.operators import dedup, pairs, resolve
from weft.plans import assembly

ITEM = (
    "doc string, id string, type string, grouping boolean, order int, code string, text string, value string, scope map<string,string>, local_values map<string,array<string>>, section_labels array<string>,"
    "context_keys array<string>, segments array<string>, windows array<string>, window_indexes array<int>, table_keys array<string>,"
    "headers array<struct<segment:string,window:string,index:int>>, rows array<struct<segment:string,window:string,index:int>>, recoded boolean"
)


def evidence(spark, parent: dict, child: dict) -> list[str]:
    """Reasons for one parent p of one child c that have nothing but what is given."""
    names = [f.strip().split(" ")[0] for f in ITEM.split(", ") for f in f.split(",") if " " in f.strip()]
    row = lambda id, type, grouping, order, given: tuple({"doc": "d", "id": id, "type": type, "grouping": grouping, "order": order, **given}.get(n) for n in names)
    items = spark.createDataFrame([row("p", "Nation", True, 900, parent), row("c", "Supplier", False, 0, child)], ITEM)
    got = resolve.parent_evidence(items, spark.createDataFrame([("Supplier", "Nation")], "child_type string, parent_type string")).collect()
    return [(r.child, r.parent, ",".join(r.reasons)) for r in got]


def test_scope_counts_without_local_values(spark):
    """a null map of values beside the item took the scope's keys away too, so the pair never met."""
    assert evidence(spark, {"value": "peru"}, {"scope": {"Nation": "peru"}}) == [("c", "p", "identity_scope_complete_parent_match")]
    assert evidence(spark, {"value": "peru"}, {"local_values": {"Nation": ["peru", None], "Region": None}}) == [("c", "p", "source_local_controlled_parent_scope")]


def test_table_headers_alone_are_evidence(spark):
    """no key brought a cited header and the rows under it together."""
    heads = [("c", "p", "source_scope_grouping,source_visible_direct_parent")]
    assert evidence(spark, {"headers": [("g", None, 4)]}, {"rows": [("g", None, 6)]}) == heads
    assert evidence(spark, {"headers": [("g", "w", None)]}, {"rows": [("g", "w", 60)]}) == heads
    assert evidence(spark, {"headers": [("g", "w", 4)]}, {"rows": [("g", "v", 7), ("g", "v", 3), ("h", "w", 4)]}) == []


def test_missing_elements_keep_other_keys(spark):
    """A null element among window indexes emptied the whole list of a parent's neighbours."""
    assert evidence(spark, {"window_indexes": [None, 5]}, {"window_indexes": [7, None]}) == [("c", "p", "nearby_source_context_key")]


def test_parts_too_large_to_review_choose_nothing(spark):
    """a decision on a part over the bound chose the group's code and type, though the part has no decision."""
    candidates = spark.createDataFrame([(k, "c" if k == 1 else "e", "t" if k == 1 else "u", 0) for k in (1, 2, 3)], "id long, code string, type string, half int")
    signals = spark.createDataFrame([("x", k) for k in (1, 2, 3)], "edge string, id long")

    def group(most: int, part: str):
        decided = spark.createDataFrame([(part, k, "merge", 1, 1, 1) for k in (1, 2, 3)], "part string, id long, decision string, decision_group int, code_from long, type_from long")
        return [tuple(r) for r in dedup.resolve_candidates(candidates, signals, decided, most=most, split=["half"])[1].collect()]

    assert group(2, "1/0") == [("review:1/0", "needs_review", 3, None, "unresolved", None, "unresolved")]
    assert group(3, "1") == [("decided:1:1", "merged", 3, "c", "selected", "t", "selected")]


def test_all_pairs_of_buckets_are_not_gathered(spark, monkeypatch):
    """every pair went through a window and an aggregation, so a bucket's square had to fit."""
    monkeypatch.setattr(pairs, "BLOCK", 3)
    rng = random.Random(5)
    keys = {i: [rng.choice([*range(6), None]) for _ in range(rng.randint(0, 3))] for i in range(40)}
    items = spark.createDataFrame([*keys.items(), (None, [1])], "id long, keys array<int>")
    got = pairs.bucket_pairs(items, "id", {"k": F.col("keys")}, most=None)
    want = sorted((a, b, "k") for a in keys for b in keys if a < b and {*keys[a]} & {*keys[b]} - {None})
    assert sorted(tuple(r) for r in got.collect()) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan.split("Join")[0]


def test_similar_pairs_of_many_blocks(spark, monkeypatch):
    """pairs with a low share in common are counted in cells of blocks; no pair carries two whole sets through a shuffle."""
    for name, value in (("BLOCK_ELEMENTS", 60), ("BLOCK_SETS", 20), ("COUNTS", 16)):
        monkeypatch.setattr(dedup, name, value)
    rng = random.Random(9)
    big = [2**63 - 1, -(2**63), 0, -1]
    sets = {i: rng.sample([*range(30), *big], rng.randint(0, 12)) for i in range(60)}
    want = sorted((a, b, len({*sets[a]} & {*sets[b]}), len({*sets[a]} | {*sets[b]})) for a in sets for b in sets if a < b and {*sets[a]} & {*sets[b]} and 10 * len({*sets[a]} & {*sets[b]}) >= 3 * len({*sets[a]} | {*sets[b]}))
    numbers = dedup.similar_pairs(spark.createDataFrame([*sets.items(), (99, None), (None, [1])], "item long, e array<long>"), "item", "e", 0.3)
    assert sorted(tuple(r) for r in numbers.collect()) == want
    texts = dedup.similar_pairs(spark.createDataFrame([(f"{i:02}", [f"x{v}" for v in s]) for i, s in sets.items()], "item string, e array<string>"), "item", "e", 0.3)
    assert sorted((int(r.item_a), int(r.item_b), r.n_common, r.n_total) for r in texts.collect()) == want
    assert "Join" not in numbers._jdf.queryExecution().optimizedPlan().toString()


def test_count_tables_grow_with_texts(monkeypatch):
    """2^20 counters tell no rare tokens from frequent ones in large inputs, so sets met in ever longer lists."""
    assert [jaccard_join.bucket_count(n) for n in (0, 50_000_000, 864_000_000, 10_000_000_000)] == [1 << 20, 1 << 20, 1 << 24, 1 << 24]
    counts = np.array([0, 1, 127, 128, 200, 10_000, 65_535, 4_000_000_000])
    assert (np.diff(jaccard_join.loads(counts).astype(int)) > 0).all() and jaccard_join.loads(counts)[2] == 127
    monkeypatch.setattr(jaccard_join, "COUNTED", 2)
    texts = ["a b c", "a b c d", "a b c", None, "a b c"]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(5), pa.int64()), "h": pa.array(range(5), pa.int64()), "text": pa.array(texts)})
    out = [b for b in jaccard_join._count_tables(iter([batch]), 3, 2, 1 << 20)]
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["n"] for r in rows if r["chunk"] is None] == [1, 2, 1, 0, 1] and sum(r["chunk"] is not None for r in rows) > 4
    sums = {}
    for r in rows:
        if r["chunk"] is not None:
            sums[r["chunk"]] = sums.get(r["chunk"], 0) + np.frombuffer(zlib.decompress(r["data"]), np.uint16).astype(int)
    assert sorted(int(x) for v in sums.values() for x in v[v > 0]) == [1, 1, 4, 4]


def test_lists_of_twenty_are_pairs():
    """twenty sets with one prefix token in common were one cluster, whatever else they had."""
    n = 20
    found = [r for b in jaccard_join._edges(np.zeros(n, np.int64), np.arange(n), np.full(n, 100), 90) for r in b.to_pylist()]
    assert len(found) == n * (n - 1) // 2 and not any(r["big"] for r in found)


def test_equal_spans_come_in_order_of_events(spark, tmp_path):
    """which of a user's equal spans stood first, and so wasn't listed, hung on how the rows lay in the file."""
    rng = random.Random(3)
    rows = [(1, 7), (45_001, 7), (90_001, 7), *((i + 45_000 * c, rng.choice([1, 2, None])) for i in range(300) for c in range(rng.randint(1, 3)))]
    spans = sorted(((i * 37 % 5000, i * 37 % 5000 + i % 90, i, u) for i, u in set(rows)), key=lambda r: r[:3])
    ahead, want = {}, []
    for s, t, i, u in spans:
        if s < ahead.get(u, s):
            want.append(i)
        ahead[u] = t
    assert {45_001, 90_001} <= set(want)
    for name, order in (("up", 1), ("down", -1)):
        (tmp_path / name).mkdir()
        ids, users = zip(*sorted(set(rows), key=lambda r: order * r[0]), strict=True)
        pq.write_table(pa.table({"event_id": pa.array(ids, pa.int64()), "user_id": pa.array(users, pa.int64())}), tmp_path / name / "events.parquet")
        assert sorted(r.event_id for r in assembly.overlapping_spans(spark, str(tmp_path / name)).collect()) == sorted(want)
