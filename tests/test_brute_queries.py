"""Queries without SQL against plain Python, on the smallest tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tests.test_curation import brute_clusters
from weft.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    def read(name, columns="*"):
        return duckdb.sql(f"select {columns} from '{SF}/{name}.parquet'").fetchall()

    return read


def got(spark, name, *columns):
    df = catalog.QUERIES[name](spark, SF)
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=str)


def folded(units):
    out = ""
    for u in (x.strip(" ") for x in units):
        if not u:
            continue
        if not out:
            out = u
        elif re.search(r"[^\W\d_]-\Z", out) and u[0].islower():
            out = out[:-1] + u
        else:
            out += ("\n" if out[-1] in ".!?:" else " ") + u
    return out


def md5(t):
    return hashlib.md5(t.encode()).hexdigest()


def test_join_text_fold(spark, rows):
    talk = defaultdict(list)
    for c, _, t in sorted(rows("conversations", "conv_id, turn, coalesce(text, '')")):
        talk[c].append(t)
    want = [(c, len(folded(t)), md5(folded(t))) for c, t in talk.items()]
    assert got(spark, "join_text_fold", "conv_id", "n_chars", "text_md5") == sorted(want, key=str)


def test_stitched_blocks(spark, rows):
    talk = defaultdict(list)
    for c, n, r, t in sorted(rows("conversations", "conv_id, turn, role, text"), key=lambda x: x[:2]):
        talk[c].append((n, r, t if n % 3 < 2 else None))
    want = []
    for c, turns in talk.items():
        told = [(r, t) for _, r, t in turns if t is not None]
        languages = {"fr" if r == "user" else "en" for r, _ in told}
        code = next((f"C{n}" for n, *_ in turns if n > 0), None)
        want.append((c, md5(folded([t for _, t in told])), "mul" if len(languages) > 1 else next(iter(languages), None), ",".join(r for _, r, _ in turns), "figure" if any(n == 2 for n, *_ in turns) else None, code, turns[0][1], len(turns)))
    assert got(spark, "stitched_blocks") == sorted(want, key=str)


def test_span_grid(spark, rows):
    orders = defaultdict(dict)
    for o, n, q in rows("lineitem", "l_orderkey, l_linenumber, l_quantity"):
        orders[o][n] = max(q, orders[o].get(n, 0))
    want = []
    for o, lines in orders.items():
        taken, cells = {}, [q for _, q in sorted(lines.items())]
        height = (len(cells) + 1) // 2
        for k, q in enumerate(cells):
            r, c = k // 2, 0
            while (r, c) in taken:
                c += 1
            down, across = (int(q % 2) + 1, 1) if k % 2 == 0 else (1, int(q % 3) + 1)
            for y in range(r, min(height, r + down)):
                for x in range(c, c + across):
                    assert (y, x) not in taken
                    taken[y, x] = k
        want.append((o, len(taken), max(x for _, x in taken), len(set(taken.values()))))
    assert got(spark, "span_grid", "l_orderkey", "n", "width", "cells") == sorted(want, key=str)


def test_greedy_page_match(spark, rows):
    talk = defaultdict(dict)
    for c, n, t in rows("conversations", "conv_id, turn, coalesce(text, '')"):
        talk[c][n] = set(re.findall(r"\w+", t.lower()))
    want = []
    for c in talk:
        used = set()
        for left in sorted(talk[c], reverse=True):
            fit = [(-len(talk[c][left] & w), right) for right, w in talk.get(c + 1, {}).items() if right not in used and len(talk[c][left] & w) >= 3]
            if fit:
                score, right = min(fit)
                used.add(right)
                want.append((c, left, right, float(-score)))
    assert got(spark, "greedy_page_match", "pair", "left", "right", "score") == sorted(want, key=str) and want


def test_pair_budget_greedy(spark, rows):
    groups = defaultdict(list)
    for k, t, z, b, n in sorted(rows("part", "p_partkey, p_type, p_size, p_brand, p_name")):
        groups[b, n].append((k, t, z))
    pairs = []
    for (b, _), parts in groups.items():
        for i, (k, t, z) in enumerate(parts):
            for k2, t2, z2 in parts[i + 1 : i + 4]:
                e = (t == t2, abs(z - z2) <= 1, k % 10 == k2 % 10)
                pairs.append(((-sum(e), *[not x for x in e], f"{k}:{k2}"), b, k, k2))
    best = defaultdict(list)
    for p in sorted(pairs):
        for end in p[2:]:
            best[end].append(p)
    short = {p for ps in best.values() for p in ps[:2]}
    want = []
    for brand in {p[1] for p in short}:
        used, n = Counter(), 0
        for p in sorted(x for x in short if x[1] == brand):
            if n < 40 and not used[p[2]] and not used[p[3]]:
                used[p[2]], used[p[3]], n = 1, 1, n + 1
                want.append((brand, p[2], p[3]))
    assert got(spark, "pair_budget_greedy", "brand", "item_a", "item_b") == sorted(want, key=str) and want


def test_dup_clusters_constrained(spark, rows):
    df = catalog.QUERIES["dup_clusters_constrained"](spark, SF).collect()
    by_type = defaultdict(dict)
    for r in df:
        by_type[r.p_type].setdefault(r.cluster, set()).add(r.text)
    names = defaultdict(set)
    for t, n in rows("part", "p_type, p_name"):
        names[t].add(n)
    for t, clusters in by_type.items():
        texts = set().union(*clusters.values())
        assert all(c == min(m) for c, m in clusters.items()) and texts <= names[t]
        assert all(len({x.split()[-1] for x in m}) == 1 for m in clusters.values())


def test_clusters_by_hand(spark):
    from weft.operators import dedup

    judged = {("a", "b"): True, ("b", "c"): True, ("a", "c"): False, ("c", "d"): True, ("e", "f"): False}
    links = spark.createDataFrame([("s", *p, v) for p, v in judged.items()], "scope string, text_a string, text_b string, same boolean")
    found = defaultdict(set)
    for r in dedup.constrained_clusters(links, "scope").collect():
        found[r.cluster].add(r.text)
        assert r.dropped == 1
    assert {frozenset(v) for v in found.values()} == brute_clusters("abcdef", judged)


def test_bootstrap(spark, rows):
    labels = dict(rows("labels", "doc_id, quality"))
    n = defaultdict(list)
    for d, lang in rows("documents", "doc_id, lang"):
        if d in labels:
            n[lang].append(labels[d] == 1)
    for r in catalog.QUERIES["bootstrap_ci"](spark, SF).collect():
        hits = n[r.lang]
        rate = sum(hits) / len(hits)
        draws = np.sort(np.random.default_rng([7, zlib.crc32(repr((r.lang,)).encode())]).binomial(len(hits), rate, 2000) / len(hits))
        assert (r.n, r.rate, r.low, r.high) == (len(hits), round(rate, 4), round(draws[50], 4), round(draws[1950], 4))
        near = 3 * (rate * (1 - rate) / len(hits)) ** 0.5
        assert rate - near - 0.1 <= r.low <= rate <= r.high <= rate + near + 0.1


def test_cycle_examples(spark, rows):
    of = dict(rows("orders", "o_orderkey, o_custkey"))
    nexts = defaultdict(set)
    for o, c in of.items():
        if o + 1 in of and of[o + 1] != c:
            nexts[c].add(of[o + 1])

    def reach(a):
        seen, front = set(), {a}
        while front:
            front = {b for x in front for b in nexts[x]} - seen
            seen |= front
        return seen

    reached = {a: reach(a) for a in list(nexts)}
    want = []
    for a in reached:
        own = {b for b in reached[a] if a in reached.get(b, ())}
        if a in own and a == min(own):
            length, front, seen = 1, nexts[a] & own, set()
            while a not in front:
                seen |= front
                front, length = {b for x in front for b in nexts[x] & own} - seen, length + 1
            want.append((a, length))
    assert got(spark, "cycle_examples", "component", "length") == sorted(want, key=str)


def test_anchor_faults(spark, rows):
    turns = {(c, n): t for c, n, t in rows("conversations", "conv_id, turn, coalesce(text, '')")}
    want = []
    for c in {k[0] for k in turns}:
        before = None
        for n in sorted(t for x, t in turns if x == c):
            for k in (0, 1):
                text, start = turns[c, n], n * 3 % 5 + 1
                excerpt = text[start + 4 * k :][:8]
                at, here, why = -1, None, None
                if n == 3:
                    why = "unknown_unit"
                elif not excerpt or (n == 2 and k == 1):
                    why = "absent"
                else:
                    at = text.find(excerpt)
                    here = (n, at, at + len(excerpt))
                    if before and before[0] == n and here < before:
                        why = "out_of_order"
                    elif before and before[0] == n and at < before[2]:
                        why = "overlap"
                if why:
                    want.append((c, n * 2 + k, why))
                before = here
    assert got(spark, "anchor_faults", "candidate", "place", "fault") == sorted(want, key=str)


def test_skill_groups_and_reviews(spark, rows):
    """Groups are made of names that verdicts join or that several parts have; reviews are what no verdict decides."""
    reviews = catalog.QUERIES["skill_reviews"](spark, SF).collect()
    for r in reviews:
        assert zlib.crc32((r.scope + r.text_a + r.text_b).encode()) % 5 == 4 or not r.scope.startswith("Brand"), r
    parts = rows("part", "p_partkey, p_name, p_brand")
    for r in catalog.QUERIES["skill_groups"](spark, SF).collect():
        texts = r.texts.split("|")
        own = [k for k, n, b in parts if n in texts and (b if k % 29 else str(k)) == r.scope]
        assert r.canonical in texts and r.n_claims == len(own) == r.n_seeds and (len(texts) > 1 or r.n_claims > 1)
