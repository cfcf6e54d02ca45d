"""Each operator against a brute-force version, with nulls, empty and long texts, ties, repeats, empty tables and extra columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import both, connect
from weft.llm import chat_format, decontaminate, gbt, jaccard_join, knn, mixing, pii, quality, secrets, token_counts, token_output, tokens
from weft.sources.scratch import new_path

SF = "/root/testdata/sf0.001"
BPE = "byte_bpe_50k.json"
DOCS = "doc_id long, text string, digest string, mix_tokens string, quality_score string, key string, h string, digit long"
ODD = [
    (5, "two words", *[None] * 6),
    (1, None, *["x"] * 5, 1),
    (2, "", *[None] * 6),
    (3, "a  b\n \n c <|endoftext|> it's  ", *["y"] * 5, 2),
    (3, "same id, other text", *[None] * 6),
    (4, "two words", *[None] * 6),
    (4, "two words", *[None] * 6),
    (None, "no id", *[None] * 6),
    (9, "very long word " * 30_000 + "x" * 50_000, *[None] * 6),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def library(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.tokenizer_path(BPE))
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chunks_give_the_library_s_ids():
    rng = random.Random(1)
    texts = ["".join(rng.choice(" \n\t ab'.,s1²é　!<|é\x1c") for _ in range(rng.randint(0, 14))) for _ in range(20_000)]
    texts += ["word. Next\nLine é É!!", "<|endoftext|>", "日本語 ok"]
    want = library(texts)
    for ids in (True, False):
        e = tokens.ChunkEncoder(BPE, ids)
        got = e.encode(texts)
        assert got == [np.array(w, "<u4").tobytes() if ids else len(w) for w in want]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_get_whole_texts(name):
    e = tokens.ChunkEncoder(name, False)
    assert e.unsafe is None and e.encode(["", "Two words", "é"])[1] >= 2


def test_token_files(spark, odd, none):
    folder = new_path(spark, "t")
    got = sorted(token_output.token_output(odd, folder=folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 3, 4, 4, 5, 9]
    start, by_id = 0, defaultdict(list)
    for (d, t, *_), ids in zip(ODD, library([r[1] for r in ODD]), strict=True):
        by_id[d].append([*ids, 0])
    for r in got:
        ids = next(x for x in by_id[r.doc_id] if zlib.crc32(np.array(x, "<u4").tobytes()) == r.ids_crc32)
        assert (r.start, r.n_tokens) == (start, len(ids))
        file = token_output.open_token_file(folder, r.path)
        if len(ids) < 1000:
            assert file.document(r.place).tolist() == ids
        else:
            assert [file.token(int(file.starts[r.place]) + k) for k in (0, 777, len(ids) - 1)] == [ids[0], ids[777], ids[-1]]
        file.source.close()
        start += len(ids)
    assert token_output.token_output(none).count() == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
def test_codes_of_any_size(n):
    import io

    ids = np.random.default_rng(n).integers(0, [200, 70_000, 2**32][n % 3], n, dtype=np.uint64).astype(np.uint32)
    file = token_output.DacFile(io.BytesIO(token_output.pack([7], np.array([0, n]), ids)))
    assert file.tokens().tolist() == ids.tolist()
    assert [file.token(i) for i in range(n)] == ids.tolist()
    with pytest.raises(IndexError):
        file.token(n)


def test_count_cache(spark, odd, none):
    cache = new_path(spark, "c")
    want = sorted(((d is None, d or 0, len((t or "").encode()), len(i), len(i) > 1024) for (d, t, *_), i in zip(ODD, library([r[1] for r in ODD]), strict=True)))
    for _ in range(2):
        got = token_counts.token_counts(odd, cache).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
        stored = spark.read.parquet(cache)
        assert stored.count() == stored.select("digest").distinct().count() == len({r[1] or "" for r in ODD})
    more = odd.limit(0).select("doc_id", "text").union(spark.createDataFrame([(1, "new"), (2, "two words")], "doc_id long, text string"))
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(more, cache).collect()} == {1: 1, 2: 2}
    assert spark.read.parquet(cache).count() == stored.count() + 1
    assert token_counts.token_counts(none, new_path(spark, "c")).count() == 0


CHATS = [
    (1, 0, "system", "Be kind. <|im_end|> <\\|x"),
    *[(1, k, "user" if k % 2 else "assistant", f"turn {k} " + "w " * (k * 7 % 90)) for k in range(1, 40)],
    (2, 0, "user", None),
    (2, 1, "assistant", ""),
    (3, 0, "system", "alone"),
    (4, 5, "assistant", "same"),
    (4, 5, "assistant", "same"),
    (4, 5, "user", "same"),
    (5, 0, "ro le\n<|", "<\\\\|im_start|>\n\n<|im_end|>\n"),
    (5, None, None, "no turn"),
    (None, 1, "assistant", "nobody"),
    (6, 0, "user", "hi"),
    (6, 1, "assistant", "long " * 3000),
    (6, 2, "assistant", "end"),
]


@pytest.mark.parametrize("budget,history", [(64, 16), (1024, 256), (8, 0)])
def test_chat_windows(spark, budget, history):
    turns = spark.createDataFrame([(*c, "x") for c in CHATS], "conv_id long, turn long, role string, text string, window string").repartition(4)
    windows = chat_format.chat_windows(turns, budget=budget, history=history).collect()
    talk = defaultdict(list)
    for c, n, r, t in CHATS:
        talk[c].append((-1 if n is None else n, r or "", t or ""))
    got = {r.conv_id: r for r in chat_format.read_windows(spark.createDataFrame(windows, chat_format.chat_windows(turns).schema)).collect()}
    assert set(got) == set(talk)
    for c, rows in talk.items():
        rows.sort()
        assert [(t.role, t.text) for t in got[c].turns] == [(r, t) for _, r, t in rows], c
        assert got[c].losses == [t for _, r, t in rows if r == "assistant"], c
    for w in windows:
        fresh = [s for s in w.segments if not s.repeated and not (s.no == 1 and w.text.startswith("<|im_start|>system\n"))]
        assert w.n_tokens <= budget or len(fresh) <= 1
        assert w.window == min(s.no for s in w.segments if not s.repeated)
        assert w.text.count("<|im_start|>") == w.text.count("<|im_end|>\n") == len(w.segments)
        if w.conv_id == 1:
            assert w.segments[0].no == 1 and w.text.startswith("<|im_start|>system\nBe kind.")
        assert [s.no for s in w.segments] == sorted(s.no for s in w.segments)


def test_chat_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.read_windows(chat_format.chat_windows(empty)).count() == 0


def test_trees_learn_an_exclusive_or():
    x = np.random.default_rng(0).random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gbt.fit(x[:1500], y[:1500])
    assert ((model.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    one = model.raw(x[:1])[0] - model.base
    walked = 0.0
    for t in range(len(model.leaf)):
        i = 0
        while i < model.cut.shape[1]:
            i = 2 * i + 1 + int(x[0, model.feature[t, i]] > model.cut[t, i])
        walked += model.leaf[t, i - model.cut.shape[1]]
    assert abs(one - walked) < 1e-9
    assert gbt.fit(x[:5], np.ones(5)).probability(x[:2]).tolist() == pytest.approx([6 / 7] * 2)


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.classify(docs.select("doc_id", "text"), labels).join(labels, "doc_id").where("held_out").collect()
    assert all(quality.crc_mod(r.doc_id) == 0 for r in got) and len(got) > 40
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.95


def test_quality_edges(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, None), (None, 1), (77, 1), (5, 7)], "doc_id long, quality int")
    got = quality.classify(odd, labels)
    assert got.count() == len(ODD) and {c for c in odd.columns} <= set(got.columns)
    assert all(0 <= r.quality_score <= 1 for r in got.collect())
    assert quality.classify(none, labels).count() == 0
    assert quality.classify(odd, labels.limit(0)).select("quality_score").distinct().count() == 1


def brute_pii(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    digits = lambda s: re.sub("[^0-9]", "", s)
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]


@pytest.mark.parametrize("letters", ["@a.b-%+ ", "0123.0 -+()", "@a.1-+ ()2"])
def test_pii_base_spans(letters):
    rng = random.Random(letters)
    for _ in range(20_000):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 24)))
        assert pii.base_spans(t) == brute_pii(t), t


def test_pii_operator(spark, odd, none):
    t = "é bob [at] mail [dot] org call 212-555-0198, a@b.co 4111 1111 1111 1111 order 2024-01-15 10.0.0.1"
    docs = spark.createDataFrame([(1, t, "x")], "doc_id long, text string, spans string")
    r = pii.detect_pii(docs, redacted=True).first()
    assert [(s.kind, s.start, s.end) for s in r.spans if not s.added] == brute_pii(t)
    assert ("phone", "212-555-0198") in {(s.kind, t[s.start : s.end]) for s in r.spans if s.added}
    assert "a@b.co" not in r.redacted and "2024-01-15" in r.redacted
    assert pii.detect_pii(odd).count() == len(ODD) and pii.detect_pii(none).count() == 0
    assert pii.detect_pii(odd).where("size(spans) > 0").count() == 0


def brute_secrets(t):
    a = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [("assign", m.start(), m.end()) for m in a.finditer(t) if len(m[2]) >= 12]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    return out + [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]


def test_secrets(spark, odd, none):
    rng = random.Random(4)
    words = ["password", "SECRET", "token", "api_key", "=", ":", " ", '"', "abcdef012345", "AKIA", "AKIAABCDEFGHIJ0123", "é", "𝒳", "short", "0123456789abcdef", "\n", "passwd"]
    texts = ["".join(rng.choice(words) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    texts += ["password=secret:abcdefghijklmnopq", "token=token=abcdefghijkl", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ledger = new_path(spark, "l")
    for _ in range(2):
        for r in secrets.scan_secrets(docs, ledger).collect():
            got = sorted((k, s.start, s.end) for k in ("assign", "access", "hex") for s in r[k])
            assert got == sorted(brute_secrets(texts[r.doc_id] or "")), texts[r.doc_id]
        n = len(secrets.RULES) * len({t or "" for t in texts})
        assert spark.read.parquet(ledger).count() == n
    more = docs.where("doc_id < 2").union(spark.createDataFrame([(9000, "fresh")], "doc_id long, text string"))
    assert secrets.scan_secrets(more, ledger).count() == 3
    assert spark.read.parquet(ledger).count() == n + len(secrets.RULES)
    secrets.scan_secrets(more, ledger, version=77)
    assert spark.read.parquet(ledger).where("version = 77").count() == 3 * len(secrets.RULES)
    assert secrets.scan_secrets(odd, new_path(spark, "l")).count() == len(ODD)
    assert secrets.scan_secrets(none, new_path(spark, "l")).count() == 0


def brute_topk(rows, k, query):
    rows = {i: x for i, x in rows if i is not None and x is not None and len(x)}
    out = []
    for q, x in rows.items():
        if query(q):
            best = sorted((-sum(int(a) * int(b) for a, b in zip(x, y, strict=True)), i) for i, y in rows.items() if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_topk(spark, spread):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8)) * 40
    rows = [(i, [int(v) for v in centres[i % 6] + rng.normal(size=8) * 40 * spread]) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)] + [(None, rows[1][1]), (2000, None), (2001, [])]
    df = spark.createDataFrame(rows, "vec_id long, x array<bigint>").withColumn("score", F.lit("x")).repartition(5)
    got = knn.voronoi_topk(df, F.col("vec_id") % 20 == 0, k=7)
    assert sorted(tuple(r) for r in got.collect()) == brute_topk(rows, 7, lambda i: i % 20 == 0)


def test_topk_edges(spark):
    df = spark.createDataFrame([(0, [1, 2]), (0, [1, 2]), (1, [3, -4]), (2, [10**9, 1])], "vec_id long, x array<bigint>")
    got = sorted(tuple(r) for r in knn.voronoi_topk(df, F.col("vec_id") == 0, k=5).collect())
    assert got == [(0, 1, 2, 10**9 + 2), (0, 2, 1, -5)]
    assert knn.voronoi_topk(df.limit(0), F.lit(True)).count() == 0
    vectors = spark.createDataFrame([(1, [0.5, float("nan")]), (2, [0.51, -0.01]), (3, None), (4, [None, 1.0])], "vec_id long, e array<float>")
    assert {r.vec_id: r.x for r in vectors.select("vec_id", knn.quantized(F.col("e")).alias("x")).collect()} == {1: None, 2: [32, -1], 3: None, 4: None}


def edit(text, rng, n):
    for _ in range(n):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1 :], text[:i] + rng.choice("abcdef") + text[i:], text[:i] + "z" + text[i + 1 :]])
    return text


def test_leaks_with_edits(spark, odd, none):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    items = [(i, prose(rng.randint(16, 60))) for i in range(20)]
    docs, want = [], set()
    for d in range(200):
        text = prose(80)
        if d % 4 == 0:
            i, t = rng.choice(items)
            text += " " + edit(t, rng, int(len(t) * 0.08) - 4 if d % 8 else 0).upper().replace(" ", ",\n") + " " + prose(50)
            want.add((d, i))
        docs.append((d, text, "x"))
    docs += [(None, items[0][1], "x"), (900, items[3][1][: len(items[3][1]) // 4], "x")]
    bench = spark.createDataFrame([*items, (50, None), (51, ""), (52, "too short"), (3, items[3][1])], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    got = decontaminate.find_leaks(frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.doc_id is not None} >= want
    assert {r.doc_id for r in got} == {d for d, _ in want} | {None}
    assert decontaminate.without_leaks(frame, bench).count() == len(docs) - len({r.doc_id for r in got})
    assert decontaminate.find_leaks(odd, bench).count() == 0 and decontaminate.find_leaks(none, bench).count() == 0
    assert decontaminate.find_leaks(frame, bench.limit(0)).count() == 0 and decontaminate.without_leaks(frame, bench.limit(0)).count() == len(docs)


def test_banded_alignment_is_the_edit_distance():
    rng = random.Random(6)
    for _ in range(300):
        w = "".join(rng.choice("abc") for _ in range(30))
        region = "".join(rng.choice("abc") for _ in range(12)) + edit(w, rng, rng.randint(0, 4)) + "".join(rng.choice("abc") for _ in range(12))
        row = [0] * (len(region) + 1)
        for c in w:
            new = [row[0] + 1]
            for j, y in enumerate(region):
                new.append(min(row[j] + (c != y), row[j + 1] + 1, new[j] + 1))
            row = new
        got = decontaminate.align(w.encode(), region.encode(), -len(w), len(region), 4)
        assert (got[2] if got else 5) == min(min(row), 5)


def brute_components(rows, n, percent):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(table))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i), d)) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_jaccard_components(spark, n, percent):
    rng = random.Random(percent)
    word = lambda: rng.choice("alpha beta gamma delta eta theta iota kappa".split()) + str(rng.randrange(9))
    shared = [word() for _ in range(70)]
    rows = []
    for d in range(260):
        base = [word() for _ in range(rng.randint(0, 120))]
        rows.append((d, " ".join(base + (shared if d % 3 == 0 else []))))
    for k in range(90):
        w = shared * 3
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = word()
        rows.append((1000 + k, " ".join(w)))
    for k in range(60):
        w = rows[rng.randrange(260)][1].split() or ["x"]
        for _ in range(rng.randint(0, 2)):
            w.insert(rng.randrange(len(w) + 1), word())
        rows.append((2000 + k, "\t".join(w).upper()))
    rows += [(3000, None), (3001, ""), (3002, " \n "), (3003, "One"), (3004, "one "), (None, "one"), (None, None), (7, rows[7][1]), (7, "other text of this id")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, key string").repartition(5)
    got = jaccard_join.jaccard_components(docs, n=n, percent=percent)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows, n, percent)


def test_jaccard_cells_of_any_size(spark, monkeypatch):
    """Clusters cut into blocks give the same links."""
    monkeypatch.setattr(jaccard_join, "CELL_SETS", 7)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for d in range(70):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(60)] = f"v{rng.randrange(40)}"
        rows.append((d, " ".join(w)))
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows, 3, 90)


@pytest.mark.parametrize("near", [True, False])
def test_memory_of_a_full_cell(near):
    """Two full blocks are compared in under 150 MB, whether all their sets are near copies or none."""
    import tracemalloc

    rng = np.random.default_rng(1)
    draw = lambda k: rng.integers(0, 2**64, k, dtype=np.uint64)
    counts, base, cell = np.zeros((2, jaccard_join.BUCKETS), np.uint32), draw(220), []
    for k in range(2 * jaccard_join.CELL_SETS):
        s = base.copy()
        m = 3 if near else 60
        s[rng.integers(0, 220, m)] = draw(m)
        s = np.unique(s)
        p = [jaccard_join.prefix(s, counts[o], o, 80) for o in range(2)]
        cell.append({"key": k, "n": len(s), "p": p, "r": [jaccard_join.rank_keys(x, counts[o], o) for o, x in enumerate(p)], "tokens": s})
    tracemalloc.start()
    assert len(jaccard_join._verified(cell, None, 2, 80)) == (len(cell) - 1 if near else 0)
    assert tracemalloc.get_traced_memory()[1] < 150e6
    tracemalloc.stop()


def test_one_of_each(spark, none):
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, "e f g h"), (3, "e f g h"), (None, "a b c d"), (4, None), (5, "")]
    got = jaccard_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, "a b c d"), (3, "e f g h"), (None, "a b c d"), (4, None), (5, "")], key=str)
    assert got.columns == ["doc_id", "text", "key"]
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "an unrelated text here"), (3, "one more text here"), (3, "one more  text here"), (3, "quite another text")]
    got = jaccard_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = sorted((r.doc_id, " ".join(r.text.split())) for r in got.collect())
    assert kept == [(1, "a b c d"), (2, "an unrelated text here"), (3, "one more text here"), (3, "quite another text")]
    assert jaccard_join.one_of_each(none).count() == 0


def test_raked_totals(spark):
    cells = spark.createDataFrame([(s, l, t, 1 + (i * 7 + j * 3 + k) % 11) for i, s in enumerate("ab") for j, l in enumerate("xyz") for k, t in enumerate("pq")], "source string, lang string, topic string, tokens long")
    share = lambda **v: spark.createDataFrame(list(v.items()), "value string, share double")
    got = mixing.rake(cells, {"source": share(a=0.3, b=0.7), "lang": share(x=0.2, y=0.5, z=0.3), "topic": share(p=0.6, q=0.4)}, rounds=40, tolerance=1e-10)
    for d, want in (("source", {"a": 0.3, "b": 0.7}), ("lang", {"x": 0.2, "y": 0.5, "z": 0.3}), ("topic", {"p": 0.6, "q": 0.4})):
        assert {r[0]: pytest.approx(r[1], abs=1e-6) for r in got.groupBy(d).agg(F.sum("raked")).collect()} == want


def test_mixing_edges(spark, odd, none):
    docs = odd.withColumn("source", F.when(F.col("doc_id") > 3, "s")).withColumn("lang", F.lit(None).cast("string"))
    got = mixing.mix(docs, budget=1.0)
    assert got.count() == len(ODD) and got.columns[:-4] == [c for c in docs.columns if c != "mix_tokens"]
    assert all(0 <= r.mix_probability <= 1 for r in got.collect())
    again = mixing.mix(docs.repartition(2).orderBy("text"), budget=1.0)
    assert sorted(got.select("doc_id", "mix_selected").collect(), key=str) == sorted(again.select("doc_id", "mix_selected").collect(), key=str)
    assert mixing.mix(none.withColumn("source", F.lit("s")).withColumn("lang", F.lit("l"))).count() == 0


@pytest.mark.parametrize("name", ["op7_exact_topk", "op10_mixing"])
def test_queries_with_sql(spark, name):
    from weft.llm import queries

    got, want = both(queries.QUERIES[name](spark, SF), connect(SF), queries.SQL[name])
    assert got == want


def test_contract_columns(spark):
    from weft.llm import queries

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op6_secret_scan(spark, SF).collect():
        spans = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(brute_secrets(docs[r.doc_id]), key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0]))))
        assert r.base_sha256 == sha(spans)
        assert ",".join(s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")) == spans
    for r in queries.op5_personal_data(spark, SF).collect():
        assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in brute_pii(docs[r.doc_id])))
    chats = {r.conv_id: r for r in queries.op3_chat_format(spark, SF).collect()}
    said = "<|im_end|><|im_start|>assistant ok"
    assert chats[-1].turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\n") and chats[-1].loss_sha256 == sha(said)


def test_pipeline_stages(spark):
    """Each stage on what its predecessor kept, against plain versions."""
    import corpus_pipeline as p
    from weft.sources.scratch import materialize

    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bench = [decontaminate.normal(r.text)[0].tobytes().strip() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in p.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        docs = materialize(stage(spark, docs, SF), name)
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= set(before)
        if name != "tokens":
            assert docs.columns == columns
        if name == "quality":
            fit_ids = {r.doc_id: r.quality for r in labels.collect()}
            right = [(d in after) == bool(q) for d, q in fit_ids.items() if d in before]
            assert sum(right) / len(right) > 0.95
        elif name == "near_duplicates":
            rows = sorted(before.items())
            assert after == {d for d, _, c in brute_components(rows, 5, 80) if d == c}
        elif name == "decontaminate":
            clean = {d for d, t in before.items() if not any(b in decontaminate.normal(t or "")[0].tobytes() for b in bench)}
            assert after == clean
        elif name == "mixture":
            assert 0.5 < len(after) / len(before) <= 1
        else:
            assert after == set(before)
        seen.append(name)
    assert seen == ["quality", "near_duplicates", "decontaminate", "mixture", "tokens"]
