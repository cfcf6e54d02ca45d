"""Operator 1: token ids as directly addressable codes.

Each id is split into 8-bit chunks, lowest first. Level k holds the k-th chunks of all ids that have one, a bitmap
says which of them go on in level k + 1, and a rank directory counts the set bits before each block of 512, so the
place of an id's next chunk is one addition away. Any token of a file is read with a few small reads; no block is
decoded. The files are raw bytes in the shared folder, listed by a manifest table that Spark commits.

Layout (little-endian): magic ``WDAC0001``; uint64 number of tokens, documents and levels; int64 document ids; one
byte for each document (1: its id is null); uint64 start of each document and the end of the last; then for each
level uint64 n, n chunk bytes, ceil(n / 8) bitmap bytes, uint64 ranks of ceil(n / 512) blocks.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.memory import small_batches, trimmed
from weft.llm.tokens import encoder, slices
from weft.sources.scratch import materialize, new_path

MAGIC = b"WDAC0001"
BLOCK = 512
#: A file ends with the document that brings it to so many tokens.
FILE_TOKENS = 4_000_000
MANIFEST = "part int, file int, n_docs long, n_tokens long, path string"


def levels_of(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(chunk bytes, whether the id goes on) for each level."""
    found, rest = [], ids.astype(np.uint32)
    while len(rest):
        more = rest >> 8
        on = more > 0
        found.append(((rest & 255).astype(np.uint8), on))
        rest = more[on]
    return found


def pack(doc_ids: list[int | None], starts: np.ndarray, ids: np.ndarray) -> bytes:
    """One file's bytes; starts has one entry more than doc_ids."""
    found = levels_of(ids)
    out = [MAGIC, struct.pack("<QQQ", len(ids), len(doc_ids), len(found))]
    out += [np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is None for d in doc_ids), starts.astype("<u8").tobytes()]
    for chunk, on in found:
        counts = np.add.reduceat(on, np.arange(0, len(on), BLOCK), dtype=np.uint64)
        ranks = np.cumsum(counts) - counts
        out += [struct.pack("<Q", len(chunk)), chunk.tobytes(), np.packbits(on, bitorder="little").tobytes(), ranks.astype("<u8").tobytes()]
    return b"".join(out)


class DacFile:
    """A file of codes, read through anything with seek() and read()."""

    def __init__(self, source):
        self.source = source
        if self._read(0, 8) != MAGIC:
            raise ValueError("not a token file")
        self.n_tokens, self.n_docs, n_levels = struct.unpack("<QQQ", self._read(8, 24))
        at = 32
        self.doc_ids = np.frombuffer(self._read(at, 8 * self.n_docs), "<i8")
        self.null = np.frombuffer(self._read(at + 8 * self.n_docs, self.n_docs), np.uint8)
        at += 9 * self.n_docs
        self.starts = np.frombuffer(self._read(at, 8 * (self.n_docs + 1)), "<u8").astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack("<Q", self._read(at, 8))
            chunks, bits = at + 8, at + 8 + n
            ranks = bits + (n + 7) // 8
            self.levels.append((n, chunks, bits, ranks))
            at = ranks + 8 * -(-n // BLOCK)

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def token(self, i: int) -> int:
        """The id at place i, by rank in each level's bitmap."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, shift = 0, 0
        for _, chunks, bits, ranks in self.levels:
            value |= self._read(chunks + i, 1)[0] << shift
            block = i // BLOCK
            row = int.from_bytes(self._read(bits + block * BLOCK // 8, i // 8 - block * BLOCK // 8 + 1), "little")
            if not row >> (i - block * BLOCK) & 1:
                return value
            below = row & ((1 << (i - block * BLOCK)) - 1)
            i = struct.unpack("<Q", self._read(ranks + 8 * block, 8))[0] + below.bit_count()
            shift += 8
        raise ValueError("a level is missing")

    def tokens(self) -> np.ndarray:
        """All ids."""
        value = None
        for n, chunks, bits, _ in reversed(self.levels):
            own = np.frombuffer(self._read(chunks, n), np.uint8).astype(np.uint32)
            if value is not None:
                on = np.unpackbits(np.frombuffer(self._read(bits, (n + 7) // 8), np.uint8), count=n, bitorder="little").astype(bool)
                own[on] |= value << np.uint32(8)
            value = own
        return value if value is not None else np.zeros(0, np.uint32)

    def document(self, k: int) -> np.ndarray:
        """The ids of the file's k-th document, token by token."""
        return np.array([self.token(i) for i in range(self.starts[k], self.starts[k + 1])], np.uint32)


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_tokens(docs: DataFrame, folder: str, *, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encode every whole text, append end_id to each document, and write the ids in ascending doc_id order.

    docs needs doc_id and text; other columns are not read. Null texts count as empty, null ids come first, and
    documents with one id stand in the order of their text's hash and length. The rows are dealt by ranges of (doc_id,
    hash), so that one repeated id doesn't fill a task. Returns the manifest (part, file, n_docs, n_tokens, path) in whose
    (part, file) order the files follow one another. A task that runs again writes files under other names, and the
    manifest lists those of the attempt that was committed. Empty tables give an empty manifest.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", F.length("text"))

    def encode(batches):
        import pyarrow as pa

        store, at = _store(folder)
        store.create_dir(at, recursive=True)
        part_no, tag, code, k, held = TaskContext.get().partitionId(), uuid.uuid4().hex[:12], encoder(tokenizer, True), 0, []

        def flush(done):
            """One file of (ids of documents, sizes, token ids) parts."""
            nonlocal k
            doc_ids = [d for part in done for d in part[0].to_pylist()]
            sizes, ids = (np.concatenate([part[j] for part in done]) for j in (1, 2))
            body = pack(doc_ids, np.concatenate([[0], np.cumsum(sizes)]), ids)
            name = f"part-{part_no:06d}-{k:05d}-{tag}.dac"
            with store.open_output_stream(f"{at}/{name}.writing") as f:
                f.write(body)
            store.move(f"{at}/{name}.writing", f"{at}/{name}")
            row = {"part": part_no, "file": k, "n_docs": len(doc_ids), "n_tokens": len(ids), "path": name}
            k += 1
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int32()), ("file", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("path", pa.string())]))

        for batch in batches:
            place = 0
            for texts in slices(batch.column(1)):
                ids, sizes = code.arrays(texts)
                docs, place = batch.column(0).slice(place, len(texts)), place + len(texts)
                ids, sizes = np.insert(ids, np.cumsum(sizes), end_id), sizes + 1
                while len(sizes):
                    total = np.cumsum(sizes)
                    n = int(np.searchsorted(total, file_tokens - sum(len(part[2]) for part in held))) + 1
                    m = int(total[min(n, len(sizes)) - 1])
                    held.append((docs[:n], sizes[:n], ids[:m]))
                    full = n <= len(sizes)
                    docs, sizes, ids = docs[n:], sizes[n:], ids[m:]
                    if full:
                        yield flush(held)
                        held = []
        if held:
            yield flush(held)

    return materialize(ordered.select("doc_id", "text").mapInArrow(lambda b: trimmed(encode(b)), MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Read the files back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and path and place.

    The running sum goes over the manifest's rows, one for each file.
    """
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).select("path", "base")
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def decode(batches):
        import pyarrow as pa

        store, at = _store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{at}/{row['path']}") as f:
                    file = DacFile(f)
                    ids = file.tokens().astype("<u4")
                cut = file.starts
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([None if z else int(d) for d, z in zip(file.doc_ids, file.null, strict=True)], pa.int64()),
                        "start": pa.array(cut[:-1] + row["base"], pa.int64()),
                        "n_tokens": pa.array(np.diff(cut), pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.int64()),
                        "path": pa.array([row["path"]] * file.n_docs, pa.string()),
                        "place": pa.array(range(file.n_docs), pa.int64()),
                    }
                )

    return files.repartition(n).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long, path string, place long")


def open_token_file(folder: str, name: str) -> DacFile:
    """A file for random access; the caller closes ``.source``."""
    store, at = _store(folder)
    return DacFile(store.open_input_file(os.path.join(at, name)))


def token_output(docs: DataFrame, *, folder: str | None = None, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0) -> DataFrame:
    """Write all documents and return what the files hold; see write_tokens and read_tokens."""
    folder = folder or new_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer=tokenizer, end_id=end_id), folder)
