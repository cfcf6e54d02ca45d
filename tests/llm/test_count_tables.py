"""op9's tables of counts as tasks hand them on."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from weft.llm import jaccard_join


def test_squeezed_counts_are_the_counts():
    """op9: a chunk of counts is packed without loss, sparse ones in 60 % of the plain bytes or less."""
    rng = np.random.default_rng(5)
    sparse = np.where(rng.random(jaccard_join.CHUNK) < 0.18, rng.geometric(0.85, jaccard_join.CHUNK), 0).astype(np.uint16)
    odd = np.zeros(jaccard_join.CHUNK, np.uint16)
    odd[[0, 7, 8, 9, 16_383]] = [1, 255, 256, 257, 65_535]
    for c in (sparse, odd, np.full(jaccard_join.CHUNK, 65_535, np.uint16), np.zeros(jaccard_join.CHUNK, np.uint16), np.arange(jaccard_join.CHUNK, dtype=np.uint16)):
        assert (jaccard_join.unsqueezed(jaccard_join.squeezed(c)) == c).all()
    assert len(jaccard_join.squeezed(sparse)) < 0.6 * len(jaccard_join.plain(sparse))


def test_squeezed_tables_have_the_counts_of_plain_ones(monkeypatch):
    """op9: the same rows of documents, and the same sums for each chunk, however many rows are packed at once."""
    monkeypatch.setattr(jaccard_join, "PACKED", 3)
    monkeypatch.setattr(jaccard_join, "COUNTED", 4)
    texts = ["a b c", "a b c d", None, "", "x y", *(f"w{i} w{i + 1} w{i % 3} a b c" for i in range(40))]
    n = len(texts)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(n), pa.int64()), "h": pa.array(range(n), pa.int64()), "text": pa.array(texts)})
    found = []
    for pack, back in ((jaccard_join.plain, lambda d: np.frombuffer(jaccard_join.zlib.decompress(d), np.uint16)), (jaccard_join.squeezed, jaccard_join.unsqueezed)):
        rows = [r for b in jaccard_join._count_tables(iter([batch]), 3, 2, 1 << 20, pack) for r in b.to_pylist()]
        sums = {}
        for r in rows:
            if r["chunk"] is not None:
                sums[r["chunk"]] = sums.get(r["chunk"], 0) + back(r["data"]).astype(int)
        found.append(([(r["doc_id"], r["key"], r["n"]) for r in rows if r["chunk"] is None], {k: v.tolist() for k, v in sums.items()}))
    assert found[0] == found[1]
