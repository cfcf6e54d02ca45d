"""Exact token ids and counts from the public tokenizers' own libraries, with repeated pieces remembered.

A byte-level BPE splits a text into pieces before it merges bytes, and no piece crosses the place before a space
that stands alone. So the ids of a text are the ids of its space-separated chunks, one after another, and those of a
chunk of letters and trailing marks are the ids of these parts. A slice of texts is cut up in Arrow, its distinct pieces
are given to the library's model where a bounded cache doesn't have them, and the texts' ids are gathered in numpy.
Texts with longer runs of white space, control characters or added tokens, and tokenizers of any other kind, go to the
library whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np

#: Characters the splitting pattern and Python may class differently, and spaces inside or at the end of longer runs.
UNSAFE = r"\s \s|\s \Z|[\x1c-\x1f\x85]"
#: Without this, in RE2, UNSAFE can't match: doubled spaces, ones after a line end, and rarer white space.
ODD = r"  |\n |[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: A Latin word with trailing marks, perhaps one line end and one more such word: their pieces never join.
_WORD, _MARKS = "[A-Za-zÀ-ÖØ-öø-ÿ]+", "[.,!?$%&*#|;:]*"
PARTS = rf"\A(?P<a>{_WORD})(?P<rest>{_MARKS}(?:\n{_WORD}{_MARKS})?)\z"
REST = rf"\A(?P<b>{_MARKS})(?:(?P<c>\n)(?P<d>{_WORD})(?P<e>{_MARKS}))?\z"
#: Pieces remembered by each worker and their characters; the cache starts anew beyond either. About 150 bytes each.
CACHE_ENTRIES = 300_000
CACHE_CHARS = 12_000_000
#: Bytes of texts that are cut up at once; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20

_made: dict = {}


def tokenizer_path(name: str) -> str:
    """Where this machine keeps a public vocabulary file; absolute paths stay as they are."""
    if name.startswith("/"):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_digest(name: str) -> str:
    """The tokenizer's version: SHA-256 of its file."""
    with open(tokenizer_path(name), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte: itself, or the next free one from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of stretches from each start, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def slices(texts, most: int = SLICE_BYTES) -> Iterator:
    """Parts of a text array of about so many bytes."""
    import pyarrow.compute as pc

    ends = np.cumsum(np.asarray(pc.binary_length(texts).fill_null(0), np.int64) + 8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield texts.slice(a, b - a)
        a = b


class ChunkEncoder:
    """Ids or numbers of ids of texts for one vocabulary."""

    def __init__(self, name: str, ids: bool):
        self.ids = ids
        self.unsafe, self.added = None, []
        path = tokenizer_path(name)
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.raw = lambda texts: model.encode(texts, num_threads=1)
        else:
            import os

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.raw = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
            spec = json.loads(model.to_str())
            pre = spec.get("pre_tokenizer") or {}
            if spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
                self.added = [t["content"] for t in spec.get("added_tokens", [])]
                self.unsafe = re.compile("|".join([UNSAFE, *map(re.escape, self.added)]))
                self.odd = "|".join([ODD, *(re.sub(r"([^\w\s])", r"\\\1", t) for t in self.added if t)])
                self.merge = model.model.tokenize
                self.bytes = {b: c for b, c in zip(range(256), byte_letters(), strict=True)}
                self.forget()

    def forget(self) -> None:
        """Empty the cache but for the empty piece."""
        self.place: dict[str, int] = {"": 0}
        self.flat, self.starts, self.chars = np.zeros(0, np.uint32), np.zeros(2, np.int64), 0

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has), by the library."""
        found = self.raw(texts)
        sizes = np.array([len(x) for x in found], np.int64)
        return np.concatenate([np.array(x, np.uint32) for x in found]) if found else np.zeros(0, np.uint32), sizes

    def merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As whole(), for what the pattern leaves as one piece each: the library's model merges its bytes."""
        ids, sizes = [], []
        for k in range(0, len(pieces), 1000):
            letters = [p.replace(" ", "Ġ") if p.isascii() and p != "\n" else p.encode().decode("latin-1").translate(self.bytes) for p in pieces[k : k + 1000]]
            found = [self.merge(x) for x in letters]
            sizes += map(len, found)
            ids += [t.id for f in found for t in f]
        return np.array(ids, np.uint32), np.array(sizes, np.int64)

    def codes(self, pieces: list[str], way) -> np.ndarray:
        """Places of distinct pieces in the cache; new ones are learnt by way()."""
        if len(self.place) + len(pieces) > CACHE_ENTRIES or self.chars > CACHE_CHARS:
            self.forget()
        new = [p for p in pieces if p not in self.place]
        if new:
            ids, sizes = way(new)
            self.place.update(zip(new, range(len(self.starts) - 1, len(self.starts) - 1 + len(new)), strict=True))
            self.chars += sum(map(len, new))
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
            self.flat = np.concatenate([self.flat, ids])
        return np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))

    def taken(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of cached pieces; without ids where only numbers are wanted."""
        sizes = self.starts[codes + 1] - self.starts[codes]
        return self.flat[gathered(self.starts[codes], sizes)] if self.ids else np.zeros(0, np.uint32), sizes

    def pieces(self, columns: list) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of rows that are made of one piece from each column."""
        import pyarrow as pa

        all_of = pa.concat_arrays(columns).dictionary_encode()
        code = self.codes(all_of.dictionary.to_numpy(zero_copy_only=False).tolist(), self.merged)[np.asarray(all_of.indices)]
        ids, sizes = self.taken(code.reshape(len(columns), -1).T.ravel())
        return ids, sizes.reshape(-1, len(columns)).sum(1)

    def chunks(self, unique) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of distinct chunks, each with its leading space."""
        import pyarrow as pa
        import pyarrow.compute as pc

        parts = pc.extract_regex(unique, PARTS)
        fine = np.asarray(parts.is_valid())
        sizes = np.zeros((len(unique), 2), np.int64)
        found = []
        if fine.any():
            word, rest = parts.filter(pa.array(fine)).flatten()
            ids, sizes[fine, 0] = self.pieces([pc.binary_join_element_wise(" ", word, "")])
            found.append((ids, fine, 0))
            rest = rest.dictionary_encode()
            ids, size = self.pieces(pc.extract_regex(rest.dictionary, REST).flatten())
            code = np.asarray(rest.indices)
            sizes[fine, 1] = size[code]
            if self.ids:
                found.append((ids[gathered((np.cumsum(size) - size)[code], size[code])], fine, 1))
        if not fine.all():
            plain = [" " + c for c in unique.filter(pa.array(~fine)).to_pylist()]
            ids, sizes[~fine, 0] = self.taken(self.codes(plain, self.whole))
            found.append((ids, ~fine, 0))
        return self.placed(found, sizes), sizes.sum(1)

    def placed(self, found: list, sizes: np.ndarray) -> np.ndarray:
        """Ids of parts of rows, (ids, which rows, which part), in the rows' order."""
        if not self.ids:
            return np.zeros(0, np.uint32)
        flat, starts = np.zeros(int(sizes.sum()), np.uint32), (np.cumsum(sizes) - sizes.ravel()).reshape(sizes.shape)
        for ids, rows, part in found:
            flat[gathered(starts[rows, part], sizes[rows, part])] = ids
        return flat

    def split(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of texts whose chunks have ids of their own."""
        import pyarrow as pa
        import pyarrow.compute as pc

        lists = pc.split_pattern(texts, " ")
        flat, heads = lists.flatten(), np.asarray(lists.offsets)[:-1] - lists.offsets[0].as_py()
        first = np.zeros(len(flat), bool)
        first[heads] = True
        rest = flat.filter(pa.array(~first)).dictionary_encode()
        rest_ids, rest_sizes = self.chunks(rest.dictionary)
        head_ids, head_sizes = self.whole(flat.filter(pa.array(first)).to_pylist())
        code = np.empty(len(flat), np.int64)
        code[~first] = np.asarray(rest.indices)
        code[heads] = len(rest_sizes) + np.arange(len(heads))
        size = np.concatenate([rest_sizes, head_sizes])
        each = size[code]
        totals = np.add.reduceat(each, heads)
        if not self.ids:
            return np.zeros(0, np.uint32), totals
        start = np.cumsum(size) - size
        return np.concatenate([rest_ids, head_ids])[gathered(start[code], each)], totals

    def arrays(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has) of an Arrow array without nulls; no ids where only numbers are wanted."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.unsafe is None:
            return self.whole(texts.to_pylist())
        alone = np.asarray(pc.match_substring_regex(texts, self.odd))
        odd = np.flatnonzero(alone)
        if len(odd):
            alone = alone.copy()
            alone[odd] = [bool(self.unsafe.search(t)) for t in texts.take(pa.array(odd)).to_pylist()]
        if not alone.any():
            return self.split(texts)
        sizes, found = np.zeros((len(texts), 1), np.int64), []
        for which, way in ((alone, lambda t: self.whole(t.to_pylist())), (~alone, self.split)):
            if which.any():
                ids, sizes[which, 0] = way(texts.filter(pa.array(which)))
                found.append((ids, which, 0))
        return self.placed(found, sizes), sizes[:, 0]

    def encode(self, texts: list[str]) -> list:
        """One value for each text, as the library gives it for the whole text: ids as little-endian unsigned 32-bit
        integers, or their number."""
        import pyarrow as pa

        out = []
        for part in slices(pa.array(texts, pa.string())):
            ids, sizes = self.arrays(part)
            out += [x.astype("<u4").tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])] if self.ids else sizes.tolist()
        return out


def encoder(name: str, ids: bool) -> ChunkEncoder:
    """This worker's encoder; reused workers keep it between tasks."""
    if (name, ids) not in _made:
        _made[name, ids] = ChunkEncoder(name, ids)
    return _made[name, ids]
