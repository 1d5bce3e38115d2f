"""Token files: concatenated ids with Elias-Fano coded document boundaries.

Documents are range-partitioned and sorted by identifier, so the files, in
order, hold all ids in ascending identifier order.  Each task encodes its
documents and writes files of this format (all integers little-endian):

    header   magic "EFIDS1\\0\\0", id width in bytes (u8), low-bit width l (u8), 6 zero bytes,
             documents n (u64), ids u (u64), bytes of the low, high and select parts (3 x u64)
    low      n+1 boundaries, l low bits each, packed
    high     unary coded upper parts: bit (boundary >> l) + i is set for boundary i
    select   position of every SAMPLE-th set bit of ``high`` (u64), the select structure
    keys     n identifiers (i64)
    ids      u ids of the given width

Boundaries take 2 + log2(u / n) bits each instead of 64.  ``Boundaries.select(i)``
answers "where does document i start" from one sample and one popcount scan.

Defined results
    null text           no ids but the end id
    null identifier     sorted first, kept as null
    repeated rows       each is a document of its own; rows of one identifier are ordered by a hash of the text
    empty table         no file, an empty result
    extra columns       ignored
    very long texts     encoded whole; a file is closed at the first document past ``file_ids`` ids
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import publish, reading_tasks, store, written
from eventide.llm.tokens import encoder
from eventide.session import shared_path

MAGIC = b"EFIDS1\0\0"
HEADER = "<8sBB6xQQQQQ"
#: One select sample per so many boundaries.
SAMPLE = 64
#: Ids per file: a task closes a file once it holds so many (about 32 MB).
FILE_IDS = 16_000_000
#: Most ids that one task reads back (but for a last file's).
READ_IDS = 64_000_000
NULL_KEY = -(2**63)

MANIFEST = "path string, part int, seq int, n_docs long, n_ids long"


class Boundaries:
    """Elias-Fano code of a non-decreasing integer sequence."""

    def __init__(self, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.low_bits, self.low, self.high, self.samples = low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> Boundaries:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        l = max(0, (top // max(n, 1)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(l, dtype=np.uint64)) & np.uint64(1) if l else np.zeros((n, 0))
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(l)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(l, low, np.packbits(high, bitorder="little"), ones[::SAMPLE].astype("<u8"))

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        for b in range(self.low_bits):
            at = i * self.low_bits + b
            out |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64) << b
        return out

    def select(self, i: int) -> int:
        """Value i: from its sample on, count set bits up to the i-th."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        word = int(self.high[byte]) >> (at & 7) << (at & 7)
        while (ones := word.bit_count()) <= left:
            left, byte = left - ones, byte + 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        bit = byte * 8 + (word & -word).bit_length() - 1
        return ((bit - i) << self.low_bits) | int(self._low(np.array([i]))[0])

    def all(self) -> np.ndarray:
        """Every value at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        i = np.arange(len(ones))
        return ((ones - i) << self.low_bits) | self._low(i)


def pack_file(keys: list[int | None], docs: list[bytes], width: int) -> bytes:
    """The file's bytes for documents given as packed ids."""
    ends = np.cumsum([0, *(len(d) // width for d in docs)])
    ef = Boundaries.build(ends)
    parts = [ef.low.tobytes(), ef.high.tobytes(), ef.samples.tobytes()]
    head = struct.pack(HEADER, MAGIC, width, ef.low_bits, len(docs), int(ends[-1]), *map(len, parts))
    named = np.array([NULL_KEY if k is None else k for k in keys], "<i8").tobytes()
    return b"".join([head, *parts, named, *docs])


class TokenFile:
    """Random access to a token file by range reads."""

    def __init__(self, path: str):
        files, at = store(path)
        self.f = files.open_input_file(at)
        magic, self.width, l, self.n, self.u, *sizes = struct.unpack(HEADER, self.f.read_at(struct.calcsize(HEADER), 0))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        offs = np.cumsum([struct.calcsize(HEADER), *sizes])
        low, high, samples = (self.f.read_at(s, int(o)) for s, o in zip(sizes, offs))
        self.boundaries = Boundaries(l, np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8),
                                     np.frombuffer(samples, "<u8"))
        self.keys_at = int(offs[-1])
        self.ids_at = self.keys_at + 8 * self.n

    def keys(self) -> list[int | None]:
        return [None if k == NULL_KEY else k
                for k in np.frombuffer(self.f.read_at(8 * self.n, self.keys_at), "<i8").tolist()]

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids [first, last) of the concatenated array."""
        data = self.f.read_at((last - first) * self.width, self.ids_at + first * self.width)
        return np.frombuffer(data, f"<u{self.width}")

    def document(self, i: int) -> np.ndarray:
        return self.ids(self.boundaries.select(i), self.boundaries.select(i + 1))

    def close(self) -> None:
        self.f.close()


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int, folder: str, id_col: str = "doc_id",
                      text_col: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Write all documents as token files; return the manifest, a written table
    (path, base, n_docs, n_ids) with ``base`` the ids of all files before."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # The range's sample goes to the driver: it holds two numbers a row, no text.
    rows = rows.withColumn("h", F.xxhash64("text"))
    parts = rows.repartitionByRange(F.col("id").asc_nulls_first(), "h")
    ordered = parts.sortWithinPartitions(F.col("id").asc_nulls_first(), "h").drop("h")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark import TaskContext

        enc, part = encoder(vocabulary), TaskContext.get().partitionId()
        width, seq = enc.dtype.itemsize, 0
        keys: list = []
        packed: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            # Every attempt writes under a name of its own; only the attempt that
            # succeeds gets its names into the manifest.
            path = f"{folder}/part-{part:06d}-{seq:04d}-{uuid.uuid4().hex[:8]}.ids"
            publish(path, pack_file(keys, packed, width))
            return pa.RecordBatch.from_pydict({
                "path": [path], "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "n_docs": [len(keys)], "n_ids": [held]})

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                for key, ids in zip(piece["id"].to_pylist(), enc.encode(piece["text"].to_pylist(), end_id)):
                    keys.append(key)
                    packed.append(ids)
                    held += len(ids) // width
                    if held >= file_ids:
                        yield close()
                        keys, packed, held, seq = [], [], 0, seq + 1
        if keys:
            yield close()

    manifest = written(ordered.mapInArrow(write, MANIFEST), "token-manifest")
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.select("path", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("base"),
                           "n_docs", "n_ids")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Every document read back: id, start, n_tokens, ids (packed as in the file), width."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist()):
                f = TokenFile(path)
                keys, at = f.keys(), f.boundaries.all()
                for lo in range(0, f.n, 256):
                    hi = min(lo + 256, f.n)
                    first = int(at[lo])
                    ids = f.ids(first, int(at[hi]))
                    yield pa.RecordBatch.from_pydict({
                        "id": pa.array(keys[lo:hi], pa.int64()),
                        "start": pa.array(base + at[lo:hi], pa.int64()),
                        "n_tokens": pa.array(np.diff(at[lo:hi + 1]), pa.int64()),
                        "ids": pa.array([ids[a - first:b - first].tobytes() for a, b in zip(at[lo:hi], at[lo + 1:hi + 1])],
                                        pa.binary()),
                        "width": pa.array([f.width] * (hi - lo), pa.int32())})
                f.close()

    size = manifest.agg(F.count(F.lit(1)).alias("files"), F.sum("n_ids").alias("ids")).first()
    tasks = reading_tasks(manifest.sparkSession, size["ids"] or 0, READ_IDS)
    spread = manifest.repartition(max(1, min(size["files"], tasks)))  # rows in turn, one per file
    return spread.mapInArrow(read, "id long, start long, n_tokens long, ids binary, width int")


def lookup(spark: SparkSession, manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """Documents by position (``file`` path, ``doc`` index in it), by select and range read."""
    del spark
    asked = wanted.join(manifest.select(F.col("path").alias("file"), "base"), "file")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                f = TokenFile(r["file"])
                out.append(f.document(r["doc"]).tolist())
                f.close()
            yield pa.RecordBatch.from_pydict({"file": batch["file"], "doc": batch["doc"],
                                              "ids": pa.array(out, pa.list_(pa.int64()))})

    return asked.mapInArrow(read, "file string, doc int, ids array<long>")


def token_digests(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Write token files for ``docs``, read them back, and give each document's digest."""
    manifest = write_token_files(docs, vocabulary, end_id, shared_path(docs.sparkSession, "token-files"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = [zlib.crc32(np.frombuffer(ids, f"<u{w}").astype("<u4").tobytes())
                   for ids, w in zip(batch["ids"].to_pylist(), batch["width"].to_pylist())]
            yield pa.RecordBatch.from_pydict({"doc_id": batch["id"], "start": batch["start"],
                                              "n_tokens": batch["n_tokens"],
                                              "ids_crc32": pa.array(crc, pa.int64())})

    return read_token_files(manifest).mapInArrow(
        digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
