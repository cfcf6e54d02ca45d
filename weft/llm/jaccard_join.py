"""Operator 9: n-gram Jaccard join filtered by prefixes under several token orders.

A document's set holds 64-bit hashes of its word n-grams. Sets of Jaccard similarity t or more share a token within
their first n - ceil(t n) + 1 tokens, whatever order all tokens are put in. Each order puts rare tokens first: by the
load of the token's bucket in a count table that all documents fill (2^20 to 2^24 counters by the size of the texts, so
that rare tokens are told from frequent ones in large inputs too), ties by another hash. The
orders differ in their bucket and tie hashes. Documents that are connected through shared prefix tokens of the first
order, and within that through those of the second, and so on, form a cluster; links lie within clusters. Clusters
are solved each by itself: candidate pairs share a prefix token in every order, and are verified on whole sets.

Equal sets are one class from the start. Memory is bounded by the size of a cell: a cluster with more tokens than fit
is cut into blocks, and each pair of blocks is a cell. Every pair that passes the filters is verified; none is capped.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.memory import small_batches, trimmed
from weft.operators.components import connected_components
from weft.sources.scratch import materialize

#: Counters of an order's count table, as powers of 2, and bytes of text that one of them is for: 1 to 16 MB as sent to executors.
BUCKET_BITS = (20, 24)
BUCKETS = 1 << BUCKET_BITS[0]
BUCKET_TEXT = 64
CHUNK = 1 << 14
#: Chunks of counters that are packed at once.
PACKED = 256
#: Documents that a task counts before its counters, of 16 bits, are handed on.
COUNTED = 65_535
#: Tokens and sets of a block; a cell holds two blocks at most. Each token takes some 60 bytes while elements are matched.
CELL_TOKENS = 400_000
CELL_SETS = 1_024
#: Rows of a cell that are compared with all others at once, and columns of a 0/1 matrix.
STRIPE = 128
COLUMNS = 1_024
#: Rows of (key, cluster), ids or hashes that are broadcast, under 50 bytes each; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Lists of one prefix token up to this length give all their pairs; the sets of longer ones are solved as one cluster.
LIST = 24
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS = [np.ones(1, np.uint64)]


def mixed(x: np.ndarray, k: int) -> np.ndarray:
    """One of several 64-bit mixes of hashes."""
    x = x * _MIX[k] + _MIX[(k + 1) % 5]
    x = (x ^ (x >> np.uint64(31))) * _MIX[(k + 2) % 5]
    return x ^ (x >> np.uint64(29))


def powers(n: int) -> np.ndarray:
    """_MIX[0] to the powers 0 .. n - 1, modulo 2^64."""
    if len(_POWERS[0]) < n:
        _POWERS[0] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(2 * n, _MIX[0]), dtype=np.uint64)])
    return _POWERS[0][:n]


def shingles(text: bytes, n: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of UTF-8 text; with fewer words, of the whole sequence; none without words.

    Words are runs of anything but space and the characters 9 to 13, with A-Z lower-cased. A word's hash is a polynomial
    of its bytes, all words at once: a segmented sum over powers that start anew at each word.
    """
    raw = _LOWER[np.frombuffer(text, np.uint8)]
    gap = _SPACE[raw]
    word = np.flatnonzero(~gap)
    if not len(word):
        return np.zeros(0, np.uint64)
    first = np.empty(len(word), bool)
    first[0] = True
    np.not_equal(word[1:], word[:-1] + 1, out=first[1:])
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, len(word)))
    place = np.arange(len(word)) - np.repeat(starts, sizes)
    values = (raw[word].astype(np.uint64) + np.uint64(1)) * powers(int(sizes.max()))[place]
    words = mixed(np.add.reduceat(values, starts) + sizes.astype(np.uint64) * _MIX[4], 0)
    k = min(n, len(words))
    grams = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        grams = mixed(grams ^ words[j : len(words) - k + 1 + j], 1 + j % 2)
    return np.unique(grams ^ np.uint64(k))


def set_key(s: np.ndarray) -> bytes:
    """16 bytes that name a set; equal for equal sets only, but for collisions of 128 bits."""
    return b"".join(int(np.bitwise_xor.reduce(mixed(s, k)) ^ mixed(s, k + 1).sum(dtype=np.uint64)).to_bytes(8, "little") for k in (2, 3)) if len(s) else b""


def key_node(key: bytes) -> int:
    """The first half of a key as a number."""
    return int.from_bytes(key[:8], "little", signed=True)


def bucket(s: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Places of tokens in a count table of so many counters, a power of 2."""
    return (mixed(s, 2 + order) >> np.uint64(65 - buckets.bit_length())).astype(np.int64)


def bucket_count(n_bytes: int) -> int:
    """Counters of each order's table for texts of so many bytes."""
    return 1 << min(max((n_bytes // BUCKET_TEXT).bit_length(), BUCKET_BITS[0]), BUCKET_BITS[1])


def loads(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes in the same order: exact up to 127, then by steps of an eighth of a power of 2."""
    c = np.maximum(counts, 1).astype(np.float64)
    return np.where(counts < 128, counts, np.minimum(128 + 8 * np.log2(c / 128), 255)).astype(np.uint8)


def rank_keys(s: np.ndarray, counts: np.ndarray, order: int) -> np.ndarray:
    """Places of tokens in one order as integers: load of the bucket, then a hash; the token itself settles ties."""
    load = np.minimum(counts[bucket(s, order, len(counts))].astype(np.uint64), np.uint64((1 << 24) - 1))
    return (load << np.uint64(40)) | (mixed(s, 3 - order) >> np.uint64(24))


def prefix(s: np.ndarray, counts: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The set's first tokens under one order: as many as a partner must share one of."""
    n = len(s)
    keep = n - (percent * n + 99) // 100 + 1
    return s[np.lexsort((s, rank_keys(s, counts, order)))[:keep]]


def plain(c: np.ndarray) -> bytes:
    """A chunk of 16-bit counts as they are, compressed."""
    return zlib.compress(c.tobytes(), 1)


def squeezed(c: np.ndarray) -> bytes:
    """As plain(), in about half the bytes where few counters are used: which ones are, and their counts less one, low bytes first."""
    some = c > 0
    v = c[some] - np.uint16(1)
    bits = zlib.compressobj(1, strategy=zlib.Z_HUFFMAN_ONLY)
    return bits.compress(np.packbits(some).tobytes()) + bits.flush() + zlib.compress((v & 255).astype(np.uint8).tobytes() + (v >> 8).astype(np.uint8).tobytes(), 1)


def unsqueezed(data: bytes) -> np.ndarray:
    """The counts that squeezed() packed."""
    first = zlib.decompressobj()
    some = np.unpackbits(np.frombuffer(first.decompress(data), np.uint8)).astype(bool)
    low, high = np.frombuffer(zlib.decompress(first.unused_data), np.uint8).reshape(2, -1).astype(np.uint16)
    c = np.zeros(len(some), np.uint16)
    c[some] = low + (high << 8) + np.uint16(1)
    return c


def _count_tables(batches, n: int, orders: int, buckets: int, pack=plain):
    """Bucket counts of a task's texts, a row for each chunk, and one row for each document. A counter grows by one at most for a
    document and order if only different buckets are counted; what is lost of tokens that share one is noise of the order."""
    import pyarrow as pa

    counts, counted = np.zeros((orders, buckets), np.uint16), 0

    def packed():
        parts = counts.reshape(-1, CHUNK)
        some = np.flatnonzero(parts.any(1))
        for a in range(0, len(some), PACKED):
            yield rows(some[a : a + PACKED], [pack(parts[i]) for i in some[a : a + PACKED]])

    def rows(some, data):
        m = len(data)
        return pa.RecordBatch.from_pydict({"doc_id": pa.nulls(m, pa.int64()), "h": pa.nulls(m, pa.int64()), "key": pa.nulls(m, pa.binary()), "node": pa.nulls(m, pa.int64()), "n": pa.nulls(m, pa.int64()), "chunk": pa.array(some, pa.int32()), "data": pa.array(data, pa.binary())})

    for batch in batches:
        keys, sizes = [], []
        for t in batch.column("text").to_pylist():
            s = shingles((t or "").encode("utf-8", "surrogatepass"), n)
            keys.append(set_key(s))
            sizes.append(len(s))
            if counted == COUNTED:
                yield from packed()
                counts[:], counted = 0, 0
            counted += 1
            for o in range(orders):
                counts[o][bucket(s, o, buckets)] += np.uint16(1)
        m = len(keys)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "h": batch.column("h"), "key": pa.array(keys, pa.binary()), "node": pa.array(map(key_node, keys), pa.int64()), "n": pa.array(sizes, pa.int64()), "chunk": pa.nulls(m, pa.int32()), "data": pa.nulls(m, pa.binary())})
    yield from packed()


def _sum_chunks(batches):
    """Loads by the sums of the bucket counts of each chunk, within a task that gets whole chunks."""
    import pyarrow as pa

    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            got = unsqueezed(data)
            sums[chunk] = sums[chunk] + got if chunk in sums else got.astype(np.uint64)
    packed = [zlib.compress(loads(v).tobytes(), 1) for v in sums.values()]
    yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(sums), pa.int32()), "data": pa.array(packed, pa.binary())})


class _Forest:
    """Union-find over places; pairs that join two trees are kept."""

    def __init__(self, n: int):
        self.parent, self.pairs = list(range(n)), []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[b] = a
            self.pairs.append((i, j))


class _Overlaps:
    """Numbers of common elements between some rows and all, by products of 0/1 matrices over the repeated elements."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        sizes = np.array([len(r) for r in rows])
        owner = np.repeat(np.arange(self.n, dtype=np.int32), sizes)
        _, place, times = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
        column, repeated = (np.cumsum(times > 1) - 1).astype(np.int32), times[place] > 1
        owner, column = owner[repeated], column[place[repeated]]
        self.ends = np.searchsorted(owner, np.arange(self.n + 1))
        self.column = column
        order = np.argsort(column, kind="stable")
        self.by_column, self.owner = column[order], owner[order]
        self.columns = int((times > 1).sum())

    def with_all(self, rows: np.ndarray) -> np.ndarray:
        """(rows x all) counts."""
        total = np.zeros((len(rows), self.n), np.float32)
        own = [self.column[self.ends[i] : self.ends[i + 1]] for i in rows]
        wanted = np.unique(np.concatenate(own)) if own else np.zeros(0, np.int32)
        at = np.full(self.columns, -1, np.int32)
        at[wanted] = np.arange(len(wanted), dtype=np.int32)
        for a in range(0, len(wanted), COLUMNS):
            lo, hi = np.searchsorted(self.by_column, [wanted[a], wanted[min(a + COLUMNS, len(wanted)) - 1] + 1])
            place = at[self.by_column[lo:hi]]
            fine = place >= 0
            x = np.zeros((self.n, min(COLUMNS, len(wanted) - a)), np.float32)
            x[self.owner[lo:hi][fine], place[fine] - a] = 1
            total += x[rows] @ x.T
        return total


class _Filters:
    """Which pairs no order's prefixes rule out.

    Two prefixes must share a token. And a token of one that comes before the other's last isn't in the other set unless
    it is in its prefix; what is missing for certain must leave enough to overlap.
    """

    def __init__(self, cell: list[dict], orders: int, percent: int):
        self.size, self.percent = np.array([c["n"] for c in cell], np.int64), percent
        self.ranks = [[c["r"][o] for c in cell] for o in range(orders)]
        self.last = [np.array([x[-1] for x in r], np.uint64) for r in self.ranks]
        self.common = [_Overlaps([c["p"][o] for c in cell]) for o in range(orders)]

    def with_all(self, rows: np.ndarray) -> np.ndarray:
        """(rows x all) whether a pair passes."""
        size, own = self.size, self.size[rows][:, None]
        need = -(-self.percent * (own + size[None]) // (100 + self.percent))
        fine = np.minimum(own, size[None]) >= need
        for r, last, overlaps in zip(self.ranks, self.last, self.common, strict=True):
            common = overlaps.with_all(rows).astype(np.int64)
            fine &= common > 0
            fine &= own - np.stack([np.searchsorted(r[i], last) for i in rows]) + common >= need
            ends = last[rows]
            fine &= size[None] - np.stack([np.searchsorted(x, ends) for x in r], 1) + common >= need
        return fine


def _forest(n: int, blocks, fine, linked=None) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that pass fine(rows) and, if given, linked(rows, passing), a stripe of rows at a time.

    Once a stripe has joined most rows, only those outside the largest tree are compared with all others: of two rows in
    different trees one at least is outside, so no link is missed.
    """
    forest, done = _Forest(n), np.zeros(n, bool)
    while True:
        root = np.array([forest.root(i) for i in range(n)])
        largest = np.bincount(root, minlength=n).argmax()
        rows = np.flatnonzero(~done & ((root != largest) | (not done.any())))[:STRIPE]
        if not len(rows):
            return forest.pairs
        done[rows] = True
        passing = fine(rows) & (root[rows][:, None] != root[None])
        if blocks is not None:
            passing &= blocks[rows][:, None] != blocks[None]
        if linked is not None and passing.any():
            passing = linked(rows, passing)
        for i, j in zip(*np.nonzero(passing), strict=True):
            forest.join(int(rows[i]), int(j))


def _candidates(cell: list[dict], blocks, orders: int, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that pass the prefix filters of all orders."""
    return _forest(len(cell), blocks, _Filters(cell, orders, percent).with_all)


def _verified(cell: list[dict], blocks, orders: int, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that link; those that pass the filters are verified on whole sets."""
    filters, whole = _Filters(cell, orders, percent), []

    def linked(rows: np.ndarray, passing: np.ndarray) -> np.ndarray:
        i, j = np.nonzero(passing)
        if len(i) > 4 * len(rows):
            if not whole:
                whole.append(_Overlaps([c["tokens"] for c in cell]))
            common = whole[0].with_all(rows)[i, j].astype(np.int64)
        else:
            common = np.array([len(np.intersect1d(cell[rows[a]]["tokens"], cell[b]["tokens"], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
        out = np.zeros_like(passing)
        out[i, j] = 100 * common >= percent * (filters.size[rows[i]] + filters.size[j] - common)
        return out

    return _forest(len(cell), blocks, filters.with_all, linked)


def _solve(batches, work, counts: np.ndarray, orders: int, percent: int):
    """work() for each cell: pairs of keys. A task gets whole cells, sorted by cell and key, and holds one at a time."""
    import pyarrow as pa

    here, cell, blocks = None, [], []

    def solved():
        own = np.array(blocks)
        found = work(cell, own if len(set(blocks)) > 1 else None, orders, percent) if len(cell) > 1 else []
        return pa.RecordBatch.from_pydict({"a": pa.array([cell[i]["key"] for i, _ in found], pa.binary()), "b": pa.array([cell[j]["key"] for _, j in found], pa.binary())})

    for batch in batches:
        for row in batch.to_pylist():
            now = (row["cluster"], row["i"], row["j"])
            if now != here:
                if len(cell) > 1:
                    yield solved()
                here, cell, blocks = now, [], []
            if cell and cell[-1]["key"] == row["key"]:
                continue
            p = [np.frombuffer(row[f"p{o}"], np.uint64) for o in range(orders)]
            cell.append({"key": row["key"], "n": row["n"], "p": p, "r": [rank_keys(x, counts[o], o) for o, x in enumerate(p)], "tokens": np.frombuffer(row["tokens"], np.uint64) if "tokens" in row else None})
            blocks.append(row["block"])
    if len(cell) > 1:
        yield solved()


def _batch(a=(), b=(), na=(), nb=(), big=()):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "na": pa.array(na, pa.int64()), "nb": pa.array(nb, pa.int64()), "big": pa.array(big, pa.bool_())})


EDGES = "a long, b long, na long, nb long, big boolean"


def _edges(token: np.ndarray, node: np.ndarray, size: np.ndarray, percent: int, long: bool = False):
    """Edges of whole tokens, sorted: all pairs of fitting sizes of a short list; of a long one, each node with the smallest."""
    first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    length = np.diff(np.append(first, len(token)))
    out = []
    if not long:
        for d in range(2, LIST + 1):
            runs = first[length == d]
            if len(runs):
                i, j = np.triu_indices(d, 1)
                out.append((np.add.outer(runs, i).ravel(), np.add.outer(runs, j).ravel(), False))
    inside = np.repeat(length > (1 if long else LIST), length)
    if inside.any():
        far = np.flatnonzero(inside)
        out.append((np.repeat(first, length)[far], far, True))
    for x, y, whole in out:
        keep = node[x] != node[y]
        if not whole:
            keep &= 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
        x, y = x[keep], y[keep]
        if len(x):
            yield _batch(node[x], node[y], size[x], size[y], np.full(len(x), whole))


def _sorted_unique(token, node, size):
    order = np.lexsort((node, token))
    token, node, size = token[order], node[order], size[order]
    once = np.ones(len(token), bool)
    once[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
    return token[once], node[once], size[once]


def _listed(token: np.ndarray, node: np.ndarray, size: np.ndarray, salt: int):
    """Rows (token, node, n) of one part of a task. A token with a long list here keeps LIST + 1 of its rows, enough to be long
    wherever it is gathered; the others go, with its first row, to lists of made-up tokens of the same length, so that no
    task gets them all."""
    token, node, size = _sorted_unique(token, node, size)
    first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    length = np.diff(np.append(first, len(token)))
    start = np.repeat(first, length)
    place = np.arange(len(token)) - start
    over = place > LIST
    if over.any():
        token = token.copy()
        group = (place[over] - 1) // LIST
        made = mixed(token[over].view(np.uint64) ^ mixed(group.astype(np.uint64) + np.uint64(salt), 2), 3).view(np.int64)
        heads = np.flatnonzero(over)[(place[over] - 1) % LIST == 0]
        names = made[(place[over] - 1) % LIST == 0]
        token[over] = made
        # Every made-up list has the token's first row, and is filled up from its short lists' rows to stay long.
        extra = [(np.full(LIST + 1, t), node[a : a + LIST + 1], size[a : a + LIST + 1]) for t, a in zip(names, start[heads], strict=True)]
        token, node, size = (np.concatenate([x, *[e[k] for e in extra]]) for k, x in enumerate((token, node, size)))
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"token": pa.array(token, pa.int64()), "node": pa.array(node, pa.int64()), "n": pa.array(size, pa.int32())})


def _dealt_edges(batches, percent: int):
    """Edges of tokens that a task gets whole, sorted. A list that goes on in the next batch is carried there; of a long one
    its first row only."""
    carried, long = None, False
    for batch in batches:
        now = [np.asarray(batch.column(k)) for k in range(3)]
        if not len(now[0]):
            continue
        if carried is not None:
            if long and now[0][0] != carried[0][0]:
                carried, long = None, False
            else:
                now = [np.concatenate(x) for x in zip(carried, now, strict=True)]
        token, node, size = _sorted_unique(*now)
        cut = int(np.searchsorted(token, token[-1]))
        if cut:
            head = int(np.searchsorted(token, token[0], side="right")) if long else 0
            if head:
                yield from _edges(token[:head], node[:head], size[:head], percent, True)
            yield from _edges(token[head:cut], node[head:cut], size[head:cut], percent)
            long = False
        carried = [x[cut:] for x in (token, node, size)]
        if long or len(carried[0]) > LIST:
            yield from _edges(*carried, percent, True)
            carried, long = [x[:1].copy() for x in carried], True
    if carried is not None and not long:
        yield from _edges(*carried, percent)
    yield _batch()


def _enough(percent: int, na, nb, shared):
    """Whether a pair shares so many tokens of one order's prefixes as similar sets must.

    Of a prefix of p tokens at most n - overlap are missing in the partner, and the common tokens that both prefixes have are
    the first ones of all.
    """
    overlap = F.ceil(F.lit(percent) * (na + nb) / (100 + percent))
    kept = lambda n: n - F.ceil(F.lit(percent) * n / 100) + 1 - (n - overlap)
    return shared >= F.least(kept(na), kept(nb))


def _in_cells(members: DataFrame, columns: list[str], weight, parts: int) -> DataFrame:
    """Rows of clusters dealt to cells of bounded size: a cluster that fits is one; else each pair of its blocks is one."""
    sizes = members.groupBy("cluster").agg(F.sum(weight).alias("w"), F.count("*").alias("c"))
    cells = sizes.where("c > 1").select("cluster", F.greatest(F.ceil(F.col("w") / CELL_TOKENS), F.ceil(F.col("c") / CELL_SETS)).cast("int").alias("blocks"))
    placed = members.join(_small(cells), "cluster").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    pairs = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.flatten(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.when(k == F.col("block"), _own(F.col("block"), F.col("blocks"))).otherwise(F.array(F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j"))))))
    )
    dealt = placed.withColumn("cell", F.explode(pairs)).select("cluster", "cell.i", "cell.j", "block", "key", *columns)
    return dealt.repartition(parts, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "key")


def _small(df: DataFrame) -> DataFrame:
    """df, to be broadcast if its rows, counted here, are few; each has a key and a number."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _own(block, blocks):
    """The cell of a block's own pairs."""
    return F.array(F.struct(block.alias("i"), block.alias("j")))


def jaccard_components(docs: DataFrame, *, n: int = 3, percent: int = 90, orders: int = 2) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id (the smallest doc_id that links lead to, itself included).

    Documents link when 100 * intersection >= percent * union of their sets. Null and empty texts have no shingles and
    are linked with nothing; a null doc_id keeps a row, its component being the smallest id it is linked with, or null.
    Repeated ids keep a row each. Other columns aren't read; empty tables give no rows. orders is 1 or 2.
    """
    return _components(docs, n, percent, orders).select("doc_id", "n_shingles", "component_id")


def _components(docs: DataFrame, n: int, percent: int, orders: int) -> DataFrame:
    """As jaccard_components(), with the text's hash h and component, a name of the component that no other one has (null:
    a document with no other one and no copies, or without shingles)."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    buckets = bucket_count(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    first = materialize(rows.mapInArrow(lambda b: trimmed(_count_tables(b, n, orders, buckets, squeezed)), "doc_id long, h long, key binary, node long, n long, chunk int, data binary"), "shingle-counts")
    chunks = first.where("chunk is not null").select("chunk", "data")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = np.zeros((orders * buckets // CHUNK, CHUNK), np.uint8)
    for r in chunks.repartition(parts, "chunk").mapInArrow(_sum_chunks, "chunk int, data binary").toLocalIterator():
        table[r.chunk] = np.frombuffer(zlib.decompress(r.data), np.uint8)
    sent = spark.sparkContext.broadcast(table.reshape(orders, buckets))
    del table

    def sets_of(batches, parts_of: tuple[str, ...]):
        """Each task's distinct sets: key, size, prefixes or all tokens."""
        import pyarrow as pa

        counts, seen = sent.value, set()
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in ("key", "node", "n", *parts_of)}
            for t in batch.column("text").to_pylist():
                s = shingles((t or "").encode("utf-8", "surrogatepass"), n)
                key = set_key(s)
                if not len(s) or key in seen:
                    continue
                seen.add(key)
                rows["key"].append(key)
                rows["node"].append(key_node(key))
                rows["n"].append(len(s))
                for c in parts_of:
                    rows[c].append(s.tobytes() if c == "tokens" else prefix(s, counts[int(c[1:])], int(c[1:]), percent).tobytes())
            yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64() if c in ("node", "n") else pa.binary()) for c, v in rows.items()})

    def lists_of(batches, column: str):
        """Prefix tokens of one order with their sets' nodes and sizes, in parts of bounded size."""
        from pyspark import TaskContext

        parts, held, salt = [], 0, TaskContext.get().partitionId() * 1_000_003
        for batch in batches:
            pre = batch.column(column).to_pylist()
            token = np.frombuffer(b"".join(pre), np.uint64)
            sizes = [len(p) // 8 for p in pre]
            if "cluster" in batch.schema.names:
                token = mixed(token ^ np.repeat(np.asarray(batch.column("cluster")).view(np.uint64), sizes), 1)
            parts.append((token.view(np.int64), np.repeat(np.asarray(batch.column("node")), sizes), np.repeat(np.asarray(batch.column("n")), sizes)))
            held += len(token)
            if held > 1_000_000:
                yield _listed(*(np.concatenate(x) for x in zip(*parts, strict=True)), salt)
                parts, held, salt = [], 0, salt + 100_003
        if held:
            yield _listed(*(np.concatenate(x) for x in zip(*parts, strict=True)), salt)

    def clusters_of(listed: DataFrame) -> DataFrame:
        """(node, cluster): what pairs with enough common prefix tokens connect, and what shares a token of a long list. Nodes are
        halves of keys; that two keys have one merely puts them into one cluster."""
        dealt = listed.repartition(parts, "token").sortWithinPartitions("token", "node").mapInArrow(lambda b: trimmed(_dealt_edges(b, percent)), EDGES)
        counted = dealt.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("shared"), F.max("big").alias("big"))
        edges = counted.where(F.col("big") | _enough(percent, F.col("na"), F.col("nb"), F.col("shared"))).select("a", "b")
        found = connected_components(edges, name="clusters")
        return materialize(found.select("node", F.col("component").alias("cluster")), "cluster")

    def texts_of(members: DataFrame, by: str) -> DataFrame:
        """One text for each set whose node or key (by) is among the members, which have it once; picked by its hash. A set that
        many documents have is one row of each task before it is dealt."""
        wanted = own.where("n_shingles > 0").join(_small(members.select(by)), by, "left_semi").groupBy("key").agg(F.min("h").alias("h")).select("h").distinct()
        return rows.select("text", "h").join(_small(wanted), "h", "left_semi").select("text")

    pre = [f"p{o}" for o in range(orders)]
    fields = ", ".join(f"{c} binary" for c in pre)
    own = first.where("chunk is null").select("doc_id", "h", "key", "node", F.col("n").alias("n_shingles"))
    lists = "token long, node long, n int"

    # Clusters by the first order over all sets, then by each further one within those of the one before.
    cluster = clusters_of(rows.select("text").mapInArrow(lambda b: trimmed(lists_of(sets_of(b, ("p0",)), "p0")), lists))
    sets = materialize(texts_of(cluster, "node").mapInArrow(lambda b: trimmed(sets_of(b, tuple(pre))), f"key binary, node long, n long, {fields}"), "prefixes")
    for c in pre[1:]:
        cluster = clusters_of(sets.select("node", "n", c).join(_small(cluster), "node").mapInArrow(lambda b, c=c: trimmed(lists_of(b, c)), lists))

    # Pairs that no order's prefixes rule out connect to smaller clusters, whose whole sets are read from texts again.
    counts = lambda: sent.value
    near = _in_cells(sets.join(_small(cluster), "node"), ["n", *pre], F.col("n") * orders * (100 - percent) / 100 + 1, parts)
    passed = near.mapInArrow(lambda b: trimmed(_solve(b, _candidates, counts(), orders, percent)), "a binary, b binary")
    close = materialize(connected_components(passed, name="near").select(F.col("node").alias("key"), F.col("component").alias("cluster")), "near-cluster")
    members = materialize(texts_of(close, "key").mapInArrow(lambda b: trimmed(sets_of(b, ("tokens", *pre))), f"key binary, node long, n long, tokens binary, {fields}").drop("node").join(_small(close), "key"), "cluster-sets")
    dealt = _in_cells(members, ["n", "tokens", *pre], F.col("n"), parts)
    links = dealt.mapInArrow(lambda b: trimmed(_solve(b, _verified, counts(), orders, percent)), "a binary, b binary")
    linked = connected_components(links, name="links")

    # Back to documents: classes of equal sets first, then the classes that links connect. What has neither a copy nor a link
    # is its own component, so only the others are joined back.
    classes = own.where("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    joined = classes.join(_small(materialize(linked.withColumnRenamed("node", "key"), "links")), "key", "left").where("copies > 1 or component is not null")
    joined = materialize(joined.select("key", F.coalesce("component", "key").alias("component"), "least"), "linked-classes")
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.select("key", "component").join(_small(least), "component")
    found = own.join(_small(materialize(named, "named")), "key", "left")
    return found.select("doc_id", "h", "n_shingles", "component", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, *, n: int = 3, percent: int = 90, orders: int = 2) -> DataFrame:
    """docs with one document of each component, that of the smallest doc_id; every column stays.

    Rows are told apart by id and text: of rows with equal id and text one stays, and of different texts of one id each
    is judged by its own links. Rows without an id can't be named by a component and all stay.
    """
    found = materialize(_components(docs, n, percent, orders), "components").where("doc_id is not null")
    # Rows of one component and id differ in their texts' hashes only.
    least = found.where("component is not null and doc_id = component_id").groupBy("doc_id", "component").agg(F.min("h").alias("least"), F.max("h").alias("most")).where("least <> most")
    later = found.join(_small(least), ["doc_id", "component"]).where("h <> least")
    gone = found.where("component_id < doc_id").select("doc_id", "h").unionByName(later.select("doc_id", "h")).distinct()
    name = max([*docs.columns, "h"], key=len) + "_"
    left = docs.withColumn(name, F.xxhash64("text")).join(_small(gone.select("doc_id", F.col("h").alias(name))), ["doc_id", name], "left_anti")
    repeated = materialize(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if not repeated.isEmpty():
        once = left.join(_small(repeated), "doc_id", "left_semi").dropDuplicates(["doc_id", name])
        left = left.join(_small(repeated), "doc_id", "left_anti").unionByName(once)
    return left.select(*docs.columns)
