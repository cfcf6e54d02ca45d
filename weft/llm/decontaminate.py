"""Operator 8: benchmark passages in documents, by shared character q-grams in diagonal bands.

Texts are lower-cased and what isn't a letter or digit becomes single spaces. A benchmark text is cut into overlapping
windows (a short one is one window), so part of a long item is found too. A window of m bytes that occurs with at most
k edits shares at least m - q + 1 - k q of its q-grams with its place in the document, and these lie on k + 1 adjacent
diagonals. So hits are counted in bands of 2 (k + 1) diagonals that overlap by half: a band with fewer hits holds no
occurrence, and the others are verified by banded alignment. Every document is scanned whole, each by itself.

Excerpts begin anywhere, so stretches of 80 bytes at every place of an item are looked for too, from the same hits: the
lemma holds for hits of one band that lie within a stretch. Items under 40 bytes are found as whole words without edits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.memory import small_batches, trimmed

Q = 10
#: Window length and step in bytes of the normal form.
WINDOW, STEP = 160, 80
#: Bytes of the shortest excerpt that counts as a leak, at any place of an item.
PASSAGE = 80
#: Benchmark texts with fewer bytes than this are only found without edits, between spaces.
LEAST = 40
#: Edits allowed for each byte of a window.
EDITS = 0.08
#: Bytes of benchmark text sent to executors at once; more are searched for in several passes.
BENCHMARK_BYTES = 4_000_000
#: Of a stretch: edits, hits at least, and half a band's diagonals.
PASSAGE_EDITS = int(PASSAGE * EDITS)
PASSAGE_HITS = PASSAGE - Q + 1 - PASSAGE_EDITS * Q
PASSAGE_HALF = PASSAGE_EDITS + 1
_SLOTS = 22
_C = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 32


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the normal form and the place of each in the lower-cased text's UTF-8."""
    raw = _PLAIN[np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)]
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != 32) | (raw[:-1] != 32)
    at = np.flatnonzero(keep)
    return raw[at], at


def grams(raw: np.ndarray) -> np.ndarray:
    """A hash of the Q bytes from each place."""
    n = len(raw) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = np.ndarray((len(raw) - 7,), np.uint64, np.ascontiguousarray(raw), 0, (1,))
    return (eight[:n] * _C[0]) ^ (eight[Q - 8 : Q - 8 + n] * _C[1])


class Windows:
    """Windows of benchmark texts with an index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item, self.text, self.offset, self.row = [], [], [], []
        # Whole items of LEAST bytes or more, with a gap after each that no stretch spans; short ones by their first word.
        self.whole, self.base, self.short = [], [], {}
        base = 0
        for item, text in items:
            raw = normal(text or "")[0].tobytes().strip()
            if len(raw) < LEAST:
                if raw:
                    self.short.setdefault(raw.split(b" ", 1)[0], []).append((item, raw))
                continue
            self.whole.append((item, raw))
            self.base.append(base)
            base += len(raw) + PASSAGE
            for a in range(0, max(1, len(raw) - WINDOW + STEP), STEP) if len(raw) > WINDOW else [0]:
                a = min(a, max(0, len(raw) - WINDOW))
                self.item.append(item)
                self.text.append(raw[a : a + WINDOW])
                self.offset.append(a)
                self.row.append(len(self.whole) - 1)
        m = np.array([len(t) for t in self.text], np.int64)
        self.edits = (m * EDITS).astype(np.int64)
        self.least = m - Q + 1 - self.edits * Q
        found = [(grams(np.frombuffer(t, np.uint8)), w) for w, t in enumerate(self.text)]
        hashes = np.concatenate([g for g, _ in found]) if found else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.window = np.concatenate([np.full(len(g), w, np.int64) for g, w in found])[order] if found else np.zeros(0, np.int64)
        self.place = np.concatenate([np.arange(len(g)) for g, _ in found])[order] if found else np.zeros(0, np.int64)
        # Each gram's place among all items; windows overlap, so only the first entry of a place counts for stretches.
        start = np.array([self.base[r] + a for r, a in zip(self.row, self.offset, strict=True)], np.int64)
        self.at = start[self.window] + self.place
        self.fresh = np.zeros(len(self.at), bool)
        self.fresh[np.unique(self.at, return_index=True)[1]] = True
        self.base, self.row = np.array(self.base, np.int64), np.array(self.row, np.int64)
        self.gram, self.first, self.times = np.unique(hashes[order], return_index=True, return_counts=True)
        self.slot = np.zeros(1 << _SLOTS, bool)
        self.slot[self.gram >> np.uint64(64 - _SLOTS)] = True

    def hits(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the text and index entries of the grams that both have."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.gram):
            return none
        g = grams(raw)
        at = np.flatnonzero(self.slot[g >> np.uint64(64 - _SLOTS)])
        if not len(at):
            return none
        k = np.minimum(np.searchsorted(self.gram, g[at]), len(self.gram) - 1)
        true = self.gram[k] == g[at]
        at, k = at[true], k[true]
        if len(at) < min(self.least.min(), PASSAGE_HITS):
            return none
        # Each hit with all windows that have its gram.
        n = self.times[k]
        hit = np.repeat(at, n)
        entry = np.repeat(self.first[k], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return hit, entry

    def bands(self, raw: np.ndarray, hit: np.ndarray, entry: np.ndarray) -> list[tuple[int, int, int]]:
        """(window, lowest diagonal, highest) of the bands with enough hits."""
        window = self.window[entry]
        enough = np.bincount(window, minlength=len(self.least))[window] >= self.least[window]
        window = window[enough]
        diagonal = hit[enough] - self.place[entry[enough]]
        half = self.edits[window] + 1
        band = (diagonal + WINDOW) // half
        span = len(raw) + 2 * WINDOW + 2
        keys = np.concatenate([window * span + band, window * span + band - 1])
        key, times = np.unique(keys, return_counts=True)
        fine = times >= self.least[key // span]
        return [(int(w), int(b * (self.edits[w] + 1) - WINDOW), int((b + 2) * (self.edits[w] + 1) - WINDOW - 1)) for w, b in zip(key[fine] // span, key[fine] % span, strict=True)]

    def stretches(self, hit: np.ndarray, entry: np.ndarray, done: set[int]) -> dict[tuple[int, int], set[int]]:
        """Places of an item from which PASSAGE bytes have enough hits in a band, by (item's row, lowest diagonal)."""
        fresh = self.fresh[entry]
        hit, at = hit[fresh], self.at[entry[fresh]]
        n = PASSAGE_HITS - 1
        if len(at) <= n:
            return {}
        band = (hit - at) // PASSAGE_HALF
        keys, at = np.concatenate([band, band - 1]), np.concatenate([at, at])
        order = np.lexsort((at, keys))
        keys, at = keys[order], at[order]
        out: dict[tuple[int, int], set[int]] = {}
        for i in np.flatnonzero((keys[n:] == keys[:-n]) & (at[n:] - at[:-n] <= PASSAGE - Q)):
            row = int(np.searchsorted(self.base, at[i], "right")) - 1
            base, size = int(self.base[row]), len(self.whole[row][1])
            if row not in done and size >= PASSAGE:
                places = range(max(0, int(at[i + n]) - base - (PASSAGE - Q)), min(int(at[i]) - base, size - PASSAGE) + 1)
                out.setdefault((row, int(keys[i]) * PASSAGE_HALF + base), set()).update(places)
        return out

    def likely(self, raw: np.ndarray, found: dict[tuple[int, int], set[int]]) -> dict[tuple[int, int], list[int]]:
        """Of the places from which a stretch has enough hits, in order, those of which the stretch is within its edits of what
        lies in its band; many are held against the text at once."""
        keys = [(key, p) for key, places in found.items() for p in sorted(places)]
        out: dict[tuple[int, int], list[int]] = {}
        width = PASSAGE + 2 * PASSAGE_HALF + 2 * PASSAGE_EDITS
        padded = np.concatenate([np.zeros(width, np.uint8), raw, np.zeros(width, np.uint8)])
        for a in range(0, len(keys), 1024):
            part = keys[a : a + 1024]
            patterns = np.stack([np.frombuffer(self.whole[row][1], np.uint8, PASSAGE, p) for (row, _), p in part])
            starts = np.array([low + p - PASSAGE_EDITS for (_, low), p in part]).clip(-width, len(raw)) + width
            regions = padded[starts[:, None] + np.arange(width)]
            for k in np.flatnonzero(_within(patterns, regions, PASSAGE_EDITS)):
                out.setdefault(part[k][0], []).append(part[k][1])
        return out

    def find(self, raw: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, start, end, edits) of verified occurrences: the best of each window, where an item has none the first and
        last stretch of each band and one without edits or in the middle, and the first place of each short item."""
        best: dict[int, tuple[int, int, int]] = {}
        hit, entry = self.hits(raw)
        for w, low, high in self.bands(raw, hit, entry) if len(hit) else []:
            if w in best and best[w][2] == 0:
                continue
            got = occurrence(self.text[w], raw, low, high, int(self.edits[w]))
            if got and (w not in best or got[2] < best[w][2]):
                best[w] = got
        out = [(self.item[w], *x) for w, x in best.items()]
        found = self.stretches(hit, entry, {int(self.row[w]) for w in best}) if len(hit) else {}
        whole = raw.tobytes()
        for (row, low), places in self.likely(raw, found).items():
            item, text = self.whole[row]
            best_first = [p for p in places if text[p : p + PASSAGE] in whole][:1] or places[len(places) // 2 :]
            for way in (places, places[::-1], best_first):
                tried = (occurrence(text[p : p + PASSAGE], raw, low + p, low + p + 2 * PASSAGE_HALF - 1, PASSAGE_EDITS) for p in way)
                if not (got := next(filter(None, tried), None)):
                    break
                if (item, *got) not in out:
                    out.append((item, *got))
        if self.short:
            text = b" " + raw.tobytes().strip() + b" "
            lead = len(raw) - len(raw.tobytes().lstrip())
            for word in self.short.keys() & set(text.split()):
                for item, short in self.short[word]:
                    if (a := text.find(b" " + short + b" ")) >= 0:
                        out.append((item, a + lead, a + lead + len(short), 0))
        return out


def _within(patterns: np.ndarray, regions: np.ndarray, edits: int) -> np.ndarray:
    """Whether each pattern is within so many edits of any part of its region, by whole tables of all pairs at once; pairs that
    have more than that many on the way leave."""
    fine, left = np.zeros(len(patterns), bool), np.arange(len(patterns))
    step = np.arange(regions.shape[1] + 1, dtype=np.int16)
    row = np.zeros((len(patterns), len(step)), np.int16)
    for i in range(patterns.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        np.minimum(row[:, :-1] + (regions != patterns[:, i : i + 1]), row[:, 1:] + 1, out=new[:, 1:])
        new -= step
        np.minimum.accumulate(new, 1, out=new)
        row = new + step
        if i % 8 == 7:
            alive = row.min(1) <= edits
            if not alive.all():
                patterns, regions, row, left = patterns[alive], regions[alive], row[alive], left[alive]
                if not len(left):
                    return fine
    fine[left[row.min(1) <= edits]] = True
    return fine


def occurrence(text: bytes, raw: np.ndarray, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the text's best place in raw on diagonals low .. high, if within the edits."""
    a, b = max(0, low - edits), min(len(raw), high + len(text) + edits)
    region = raw[a:b].tobytes()
    exact = region.find(text)
    got = (exact, exact + len(text), 0) if exact >= 0 else align(text, region, low - a - edits, high - a + edits, edits)
    return (a + got[0], a + got[1], got[2]) if got else None


def align(window: bytes, region: bytes, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    """(start, end, distance) of the window's best place in the region on diagonals low .. high, if within the edits.

    Row i of the table has the distances of the first i window bytes to region bytes that end on each diagonal; the
    start may lie on any. Insertions along a row are a running minimum.
    """
    y = np.frombuffer(region, np.uint8)
    width = high - low + 1
    step = np.arange(width)
    big = 1 << 20
    row = np.where((low + step >= 0) & (low + step <= len(y)), 0, big)
    start = low + step
    for i, c in enumerate(window, 1):
        end = low + step + i
        inside = (end >= 1) & (end <= len(y))
        same = np.zeros(width, bool)
        same[inside] = y[end[inside] - 1] == c
        cost = np.where(inside, row + ~same, big)
        up = np.append(row[1:] + 1, big)
        take = up < cost
        cost, begun = np.where(take, up, cost), np.where(take, np.append(start[1:], 0), start)
        cost = np.where((end >= 0) & (end <= len(y)), cost, big)
        slid = np.minimum.accumulate(cost - step)
        source = np.maximum.accumulate(np.where(cost - step == slid, step, 0))
        row, start = slid + step, begun[source]
        if row.min() > edits:
            return None
    j = int(row.argmin())
    return (max(0, int(start[j])), low + j + len(window), int(row[j])) if row[j] <= edits else None


def place_in(text: str, at: np.ndarray, start: int, end: int) -> tuple[int, int]:
    """Code points of the original text for bytes start .. end of its normal form."""
    lower = text.lower()
    raw = lower.encode("utf-8", "replace")
    a, b = int(at[start]), int(at[end - 1]) + 1
    a, b = len(raw[:a].decode("utf-8", "ignore")), len(raw[:b].decode("utf-8", "ignore"))
    return (a, b) if len(lower) == len(text) else (min(a, len(text)), min(b, len(text)))


def _groups(benchmark: DataFrame) -> list[Windows]:
    """The benchmark's windows in parts of bounded size; one pass over the documents for each."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BENCHMARK_BYTES)
    parts = []
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
        parts.append(Windows(sorted(((r.item_id, r.text) for r in part.collect()), key=lambda x: (x[0] is None, x))))
    return [p for p in parts if p.item or p.short]


LEAKS = "doc_id long, item_id long, start long, end long, edits long, windows long"


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and benchmark item of which a window or a stretch occurs: doc_id, item_id, start, end, edits, windows.

    start and end are code points from the first to the last found window, edits the fewest of any, windows how many
    were found; where there is no window, the stretches looked at stand for them. docs needs doc_id and text, benchmark item_id and text; null and empty texts match nothing, null and
    repeated ids keep their rows, and other columns aren't read. Without benchmark texts there are no rows.
    """
    out = None
    for windows in _groups(benchmark):
        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_leaks(docs, windows), LEAKS)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], LEAKS) if out is None else out


def _leaks(docs: DataFrame, windows: Windows):
    sent = docs.sparkSession.sparkContext.broadcast(windows)

    def run(batches):
        import pyarrow as pa

        w = sent.value
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                if not (text := text.as_py()):
                    continue
                raw, at = normal(text)
                items: dict = {}
                for item, a, b, edits in w.find(raw):
                    items.setdefault(item, []).append((a, b, edits))
                for item, got in items.items():
                    a, b = place_in(text, at, min(x[0] for x in got), max(x[1] for x in got))
                    out.append({"doc_id": doc.as_py(), "item_id": item, "start": a, "end": b, "edits": min(x[2] for x in got), "windows": len(got)})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([(n, pa.int64()) for n in ("doc_id", "item_id", "start", "end", "edits", "windows")]))

    return run


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents in which a benchmark passage occurs; every column stays, and nothing is shuffled."""
    spark = docs.sparkSession
    small_batches(spark)
    for windows in _groups(benchmark):
        sent = spark.sparkContext.broadcast(windows)

        def run(batches, sent=sent):
            import pyarrow as pa

            w = sent.value
            for batch in batches:
                clean = [not (t := x.as_py()) or not w.find(normal(t)[0]) for x in batch.column("text")]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(lambda b, run=run: trimmed(run(b)), docs.schema)
    return docs
