"""Packing documents into fixed-length sequences: shortest-pack-first over the length histogram.

1. Every document is encoded once; its ids, cut at the capacity, are pieces.
   They go to a written table with the piece's rank among the pieces of equal
   length of its part of the table.
2. The histogram of piece lengths (at most ``capacity`` bars, whatever the
   corpus) is planned on the driver: lengths go longest first, each into the
   open packing pattern that is shortest, if it fits, else into a new one.  A
   pattern is a list of rank ranges with one count, so a step moves as many
   documents as the counts allow and its cost does not depend on them.
3. Patterns that stay open are closed by cutting: some packs' pieces fill up
   the others; what is left at the end is one short pack, which
   is laid out as sequences of power-of-two lengths (those need no padding).
4. Documents join their patterns by (length, rank): a part's rank offsets are
   summed per length, then each piece finds its places by binary search in the
   plan.  A length that a third of all rows share is only a long rank range.

Defined results
    null text           no ids but the end id
    null identifier     kept; such rows are packed like others
    repeated rows       each is a document of its own
    ties                equal lengths are ranked by part and position in the written table
    empty table         an empty result
    extra columns       ignored
    very long texts     encoded whole, cut into pieces of the capacity
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import written
from eventide.llm.tokens import encoder

CAPACITY = 4_096
_TOKENS = ("id long, start long, length int, doc_tokens long, part int, local long, width int, ids binary")
_PACKED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "offset long, ids binary, width int")


@dataclass(frozen=True)
class Lot:
    """Slice [cut, cut + size) of the pieces of one length, from rank ``first`` on."""

    length: int
    first: int
    cut: int
    size: int


@dataclass(frozen=True)
class Pattern:
    """``count`` packs filled alike: pack i holds rank first + i of every lot."""

    count: int
    fill: int
    lots: tuple[Lot, ...]

    def split(self, count: int) -> tuple[Pattern, Pattern]:
        rest = tuple(replace(x, first=x.first + count) for x in self.lots)
        return replace(self, count=count), Pattern(self.count - count, self.fill, rest)

    def add(self, lot: Lot) -> Pattern:
        return Pattern(self.count, self.fill + lot.size, (*self.lots, lot))


class _Open:
    """Open patterns, the shortest on top."""

    def __init__(self):
        self.heap: list = []
        self.made = 0

    def push(self, p: Pattern) -> None:
        if p.count:
            self.made += 1
            heapq.heappush(self.heap, (p.fill, self.made, p))

    def pop(self) -> Pattern:
        return heapq.heappop(self.heap)[2]


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> tuple[list[Pattern], list[Pattern]]:
    """(full patterns, open patterns) of the pieces counted in ``histogram``."""
    full: list[Pattern] = []
    open_ = _Open()
    for length in sorted(histogram, reverse=True):
        first, left = 0, histogram[length]
        while left:
            if open_.heap and open_.heap[0][0] + length <= capacity:
                shortest = open_.pop()
                take, rest = shortest.split(min(left, shortest.count))
                open_.push(rest)
            else:
                take = Pattern(left, 0, ())
            packed = take.add(Lot(length, first, 0, length))
            first, left = first + take.count, left - take.count
            full.append(packed) if packed.fill == capacity else open_.push(packed)
    return full, [entry[2] for entry in open_.heap]


def close_by_cutting(open_: list[Pattern], capacity: int) -> tuple[list[Pattern], list[Pattern]]:
    """Fill open patterns with cut pieces of some of their packs, until one pack at most stays open.

    The pattern with the most packs gives as many of them as the others' gaps
    need; wide patterns and wide lots are matched first, which keeps ranges long.
    """
    full: list[Pattern] = []
    todo = list(open_)
    while sum(p.count for p in todo) > 1:
        todo.sort(key=lambda p: p.count)
        giver = todo.pop()
        gap = sum((capacity - p.fill) * p.count for p in todo)
        enough = -(-gap // giver.fill)
        if giver.count > enough:  # the rest of its packs take, too
            enough = max(1, -(-(gap + giver.count * (capacity - giver.fill)) // capacity))
            giver, rest = giver.split(min(giver.count - (not todo), enough))  # someone must take
            todo += [rest] if rest.count else []
        takers = [(-p.count, i, p) for i, p in enumerate(todo)]
        loose = [(-giver.count, -x.size, i, x) for i, x in enumerate(giver.lots)]
        heapq.heapify(takers)
        heapq.heapify(loose)
        tick = len(takers) + len(loose)
        while loose and takers:
            count, _, _, lot = heapq.heappop(loose)
            taker = heapq.heappop(takers)[2]
            size = min(lot.size, capacity - taker.fill)
            n = min(-count, taker.count)
            took, rest = taker.split(n)
            took = took.add(replace(lot, size=size))
            tick += 1
            if rest.count:
                heapq.heappush(takers, (-rest.count, tick, rest))
            if n < -count:
                heapq.heappush(loose, (count + n, -lot.size, tick, replace(lot, first=lot.first + n)))
            if size < lot.size:
                heapq.heappush(loose, (-n, size - lot.size, tick, replace(lot, cut=lot.cut + size, size=lot.size - size)))
            if took.fill == capacity:
                full.append(took)
            else:
                heapq.heappush(takers, (-n, -tick, took))
        # What found no taker starts packs of its own.
        todo = [t[2] for t in takers] + [Pattern(-c, x.size, (x,)) for c, _, _, x in loose]
    return full, todo


def power_of_two_packs(pattern: Pattern) -> list[Pattern]:
    """A short pack as packs of power-of-two fills."""
    out, lots = [], list(pattern.lots)
    for bit in range(pattern.fill.bit_length() - 1, -1, -1):
        room = pattern.fill & (1 << bit)
        mine: list[Lot] = []
        while room:
            lot = lots.pop(0)
            size = min(lot.size, room)
            mine.append(replace(lot, size=size))
            if size < lot.size:
                lots.insert(0, replace(lot, cut=lot.cut + size, size=lot.size - size))
            room -= size
        if mine:
            out.append(Pattern(pattern.count, 1 << bit, tuple(mine)))
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Placement rows, sorted: length, first rank, last rank, cut, size, sequence of the first, offset."""
    full, open_ = shortest_pack_first(histogram, capacity)
    closed, last = close_by_cutting(open_, capacity)
    packs = [*full, *closed, *(x for p in last for x in power_of_two_packs(p))]
    rows, sequence = [], 0
    for p in packs:
        offset = 0
        for x in p.lots:
            rows.append((x.length, x.first, x.first + p.count, x.cut, x.size, sequence, offset))
            offset += x.size
        sequence += p.count
    # Slices of the same pieces may have come apart at different ranks: cut their
    # ranges at each other's ends, so that equal ranges hold equal pieces.
    out, cut = [r for r in rows if r[4] == r[0]], {}
    for r in rows:
        if r[4] != r[0]:
            cut.setdefault(r[0], []).append(r)
    for length, own in cut.items():
        ends = np.unique([x for r in own for x in r[1:3]])
        for r in own:
            at = ends[np.searchsorted(ends, r[1]):np.searchsorted(ends, r[2])].tolist()
            out += [(length, a, b, r[3], r[4], r[5] + a - r[1], r[6]) for a, b in zip(at, [*at[1:], r[2]])]
    return np.array(sorted(out), np.int64).reshape(-1, 7)


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """All documents' pieces, a written table."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part = encoder(vocabulary), TaskContext.get().partitionId()
        width = enc.dtype.itemsize
        seen: dict[int, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                out: list[list] = [[] for _ in range(6)]
                for key, ids in zip(some["id"].to_pylist(), enc.encode(some["text"].to_pylist(), end_id)):
                    total = len(ids) // width
                    for start in range(0, total, capacity):
                        n = min(capacity, total - start)
                        rank = seen.get(n, 0)
                        seen[n] = rank + 1
                        for col, v in zip(out, (key, start, n, total, rank, ids[start * width:(start + n) * width])):
                            col.append(v)
                m = len(out[0])
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(out[0], pa.int64()), "start": pa.array(out[1], pa.int64()),
                    "length": pa.array(out[2], pa.int32()), "doc_tokens": pa.array(out[3], pa.int64()),
                    "part": pa.array([part] * m, pa.int32()), "local": pa.array(out[4], pa.int64()),
                    "width": pa.array([width] * m, pa.int32()), "ids": pa.array(out[5], pa.binary())})

    return written(rows.mapInArrow(run, _TOKENS), "pack-pieces")


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Every piece's place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids, width.

    ``ids`` are the piece's token ids, packed little-endian at ``width`` bytes.
    """
    pieces = token_pieces(docs, vocabulary, end_id, capacity, id_col, text_col)
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    bars = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    # The plan's size is bounded by the histogram's, not by the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(plan({r["length"]: r["n"] for r in bars}, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(offsets, ["part", "length"]).withColumn("rank", F.col("base") + F.col("local"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        placed = shared.value
        starts: dict[int, tuple[int, int]] = {}
        lengths, at = np.unique(placed[:, 0], return_index=True)
        for length, a, b in zip(lengths, at, [*at[1:], len(placed)]):
            starts[int(length)] = (int(a), int(b))
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            cols = ("id", "start", "length", "doc_tokens", "rank", "width", "ids")
            for key, start, length, total, rank, width, ids in zip(*(batch[c].to_pylist() for c in cols)):
                a, b = starts[length]
                firsts = placed[a:b, 1]
                hi = int(np.searchsorted(firsts, rank, "right"))
                lo = int(np.searchsorted(firsts, firsts[hi - 1], "left"))
                for _, first, _, cut, size, sequence, offset in placed[a + lo:a + hi].tolist():
                    mine = ids[cut * width:(cut + size) * width]
                    crc = zlib.crc32(np.frombuffer(mine, f"<u{width}").astype("<u4").tobytes())
                    for col, v in zip(out, (key, start + cut, size, crc, total, sequence + rank - first, offset, mine,
                                            width)):
                        col.append(v)
            kinds = [pa.int64()] * 7 + [pa.binary(), pa.int32()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "width"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return ranked.select("id", "start", "length", "doc_tokens", "rank", "width", "ids").mapInArrow(place, _PACKED)
