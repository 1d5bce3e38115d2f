"""Benchmark decontamination by a prefix-filtered join of windows.

An item's windows are its runs of ``window`` consecutive words (an item of
fewer words is one window).  A window is a set of shingles (``SHINGLE`` words,
fewer in windows that are shorter) with their positions, and a document is
contaminated where all shingles of a window stand at the window's distances.

1. One pass over all whole documents hashes their shingles and keeps those
   that a bitmap of the items' shingles lets through, as segments: maximal
   runs of such shingles.  Every occurrence of a window lies in one segment,
   so segments shorter than the shortest window go (length bound).  The pass
   also counts in how many documents each shingle stands, combined per task.
2. Shingles are ordered by rarity.  A window that is contained in full needs
   its rarest shingle alone (the prefix of a containment of 1).
3. Equal segments are one: the distinct segments are joined with the windows
   on the prefix shingle.  The shingle's place fixes the window's start, which
   must lie in the segment with all of the window (positional bound).
4. The item-sized window of the segment is compared word for word.
5. Documents take the places found in their segments, merged to words.

The bitmap has a bounded size (``words.MOST_BITS``); all else is joined, so
the items may be any number.

Defined results
    null or empty text, no words   a document without words; an item without windows
    null doc_id                    kept, with its counts
    null item_id                   its windows are hits, but there is no identifier to list
    repeated rows                  each document alone; equal items hit together, an identifier counts once
    ties in rarity                 the shingle of smaller hash, then the earlier one
    empty table                    an empty result; without items nothing is contaminated
    extra columns                  ignored
    very long texts                read whole, one at a time
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import written
from eventide.llm.exact_dedup import addressed, from_files
from eventide.llm.words import PerWord, bitmap, mix64, present, words_of

#: Words per shingle.
SHINGLE = 3
#: Words that are hashed in one go (a longer text alone).
CHUNK_WORDS = 400_000
#: Shingles counted by a task before it hands its counts on.
COUNTED = 500_000

_SCAN = "kind int, fh long, ri long, id long, n long, at int, k int, words string, hs array<long>, counts array<long>"
_NAMES = [c.split()[0] for c in _SCAN.split(", ")]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(),
          pa.list_(pa.int64()), pa.list_(pa.int64())]
_DOCUMENT, _SEGMENT, _COUNTS = 0, 1, 2


def word_hash(word: bytes) -> bytes:
    return hashlib.blake2b(word, digest_size=8).digest()


def shingles(w: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` word hashes."""
    h = np.full(max(len(w) - k + 1, 0), k, np.uint64)
    for i in range(k):
        h = mix64(h + w[i:len(w) - k + 1 + i])
    return h


def _batch(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))

    def column(c: str, t: pa.DataType) -> pa.Array:
        own = columns.get(c)
        return pa.nulls(n, t) if own is None else own if isinstance(own, pa.Array) else pa.array(own, t)

    return pa.RecordBatch.from_arrays([column(c, t) for c, t in zip(_NAMES, _TYPES)], _NAMES)


def windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """One row per distinct window: words, size, k, hs (its shingles' hashes), ids (a written table)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = PerWord(word_hash, "<u8")
        for batch in batches:
            for item, text in zip(batch["id"], batch["body"]):
                words = words_of(text.as_py())
                if not words:
                    continue
                size = min(window, len(words))
                k = min(SHINGLE, size)
                h = shingles(hashed.of(words), k).view(np.int64)
                starts = range(len(words) - size + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b" ".join(words[s:s + size]).decode() for s in starts]),
                     pa.array([size] * len(starts), pa.int32()), pa.array([k] * len(starts), pa.int32()),
                     pa.array([h[s:s + size - k + 1].tolist() for s in starts], pa.list_(pa.int64())),
                     pa.array([item.as_py()] * len(starts), pa.string())], ["words", "size", "k", "hs", "id"])

    read = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").cast("binary").alias("body"))
    rows = read.mapInArrow(run, "words string, size int, k int, hs array<long>, id string")
    # Nulls take no part in collect_set: an unnamed item's windows stay, without an identifier.
    return written(rows.groupBy("words", "size", "k").agg(F.first("hs").alias("hs"), F.collect_set("id").alias("ids")),
                   "leaks-windows")


def scan(docs: DataFrame, members: np.ndarray, least: dict[int, int], id_col: str, text_col: str) -> DataFrame:
    """All documents in one pass (a written table): per document a row of its count of words, per
    segment one of its place, words and shingles, per task the documents counted per shingle.

    ``least`` maps each length of shingles to the words of the shortest window that has such."""
    held = docs.sparkSession.sparkContext.broadcast(members)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, members = PerWord(word_hash, "<u8"), held.value
        seen, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def counted(new: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([seen, *new])
            weight = np.concatenate([times, np.ones(len(every) - len(seen), np.int64)])
            h, where = np.unique(every, return_inverse=True)
            return h, np.bincount(where, weight, len(h)).astype(np.int64)

        def chunk(batch: pa.RecordBatch, words: list[bytes], sizes: list[int]) -> Iterator[pa.RecordBatch]:
            nonlocal seen, times
            yield _batch(kind=[_DOCUMENT] * len(sizes), fh=batch["fh"], ri=batch["ri"], id=batch["id"], n=sizes)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            begins = np.cumsum([0, *sizes[:-1]])
            w = hashed.of(words)
            at, ks, rows, texts, hs, new = [], [], [], [], [], []
            for k, shortest in least.items():
                h = shingles(w, k)
                if not len(h):
                    continue
                hit = present(members, h) & (doc[:len(h)] == doc[k - 1:])
                p = np.flatnonzero(hit)
                if not len(p):
                    continue
                owner = doc[p]
                pairs = np.unique(np.stack([owner.astype(np.uint64), h[p]], 1), axis=0)
                new.append(pairs[:, 1])
                cut = np.flatnonzero((np.diff(p) > 1) | (np.diff(owner) > 0)) + 1
                run = np.stack([np.append(0, cut), np.append(cut, len(p))], 1)
                for a, b in run[run[:, 1] - run[:, 0] + k - 1 >= shortest].tolist():
                    first, last = int(p[a]), int(p[b - 1]) + k
                    at.append(first - int(begins[owner[a]]))
                    ks.append(k)
                    rows.append(int(owner[a]))
                    texts.append(b" ".join(words[first:last]).decode())
                    hs.append(h[p[a]:p[b - 1] + 1].view(np.int64).tolist())
            if at:
                yield _batch(kind=[_SEGMENT] * len(at), fh=batch["fh"].take(pa.array(rows)),
                             ri=batch["ri"].take(pa.array(rows)), at=at, k=ks, words=texts, hs=hs)
            if new:
                seen, times = counted(new)
            if len(seen) > COUNTED:
                yield from flush()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal seen, times
            if len(seen):
                yield _batch(kind=[_COUNTS], hs=[seen.view(np.int64).tolist()], counts=[times.tolist()])
            seen, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        for batch in batches:
            start, words, sizes = 0, [], []
            for i, text in enumerate(batch["body"]):
                own = words_of(text.as_py())
                words += own
                sizes.append(len(own))
                if len(words) >= CHUNK_WORDS or i == batch.num_rows - 1:
                    yield from chunk(batch.slice(start, len(sizes)), words, sizes)
                    start, words, sizes = i + 1, [], []
        yield from flush()

    texts = addressed(docs).select(F.xxhash64("loc.path").alias("fh"), F.col("loc.row").alias("ri"),
                                   F.col(f"row.{id_col}").cast("long").alias("id"),
                                   F.col(f"row.{text_col}").cast("string").cast("binary").alias("body"))
    return written(texts.mapInArrow(run, _SCAN), "leaks-scan")


def hits(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, spans (merged runs of hit words, from 0, end excluded),
    items (identifiers of the items with occurring windows, sorted as strings), and its address (fh, ri)."""
    whole = windows(items, window, item_col, item_text_col)
    members = bitmap(whole.select(F.explode("hs").alias("h")), "h")
    least = {r["k"]: r["size"] for r in whole.groupBy("k").agg(F.min("size").alias("size")).collect()}
    read = scan(from_files(docs), members, least, id_col, text_col)

    # Rarity over all documents; each window's rarest shingle is its prefix.
    counts = (read.where(F.col("kind") == _COUNTS).select(F.explode(F.arrays_zip("hs", "counts")).alias("c"))
              .groupBy(F.col("c.hs").alias("h")).agg(F.sum("c.counts").alias("df")))
    tokens = whole.select("words", "size", "k", "ids", F.posexplode("hs").alias("i", "h"))
    rare = F.struct(F.coalesce("df", F.lit(0)).alias("df"), "h", "i")
    prefix = (tokens.join(counts, "h", "left").groupBy("words", "size", "k")
              .agg(F.min(rare).alias("p"), F.first("ids").alias("ids"))
              .select(F.col("p.h").alias("h"), "k", F.col("p.i").alias("i"), "size", F.col("words").alias("own"), "ids"))
    prefix = written(prefix, "leaks-prefix")

    # Distinct segments against the windows on the prefix shingle, bounded by place, then word for word.
    segments = read.where(F.col("kind") == _SEGMENT).select("fh", "ri", "at", "k", "words", "hs")
    distinct = written(segments.groupBy("k", "words").agg(F.first("hs").alias("hs")), "leaks-segments")
    placed = distinct.select("k", "words", F.posexplode("hs").alias("p", "h")).join(prefix.hint("merge"), ["k", "h"])
    placed = placed.withColumn("s", F.col("p") - F.col("i")).withColumn("w", F.split("words", " "))
    placed = placed.where((F.col("s") >= 0) & (F.col("s") + F.col("size") <= F.size("w")))
    exact = placed.where(F.array_join(F.slice("w", F.greatest("s", F.lit(0)) + 1, F.col("size")), " ") == F.col("own"))
    found = exact.groupBy("k", "words").agg(
        F.collect_set(F.struct(F.col("s").alias("a"), (F.col("s") + F.col("size")).alias("b"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("ids"))).alias("ids"))
    found = written(found, "leaks-found")

    # These joins merge sorted runs: segments and places take far more memory than their compressed files tell.
    own = segments.join(found.hint("merge"), ["k", "words"]).select(
        "fh", "ri", F.expr("transform(spans, x -> struct(x.a + at AS a, x.b + at AS b))").alias("spans"), "ids")
    per_document = own.groupBy("fh", "ri").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
                                               F.array_distinct(F.flatten(F.collect_set("ids"))).alias("ids"))
    per_document = per_document.select("fh", "ri", "spans.a", "spans.b", F.array_sort("ids").alias("items"))
    per_document = per_document.mapInArrow(_merge, "fh long, ri long, spans array<struct<a:int,b:int>>, items array<string>")
    out = read.where(F.col("kind") == _DOCUMENT).select("fh", "ri", F.col("id").alias("doc_id"), F.col("n").alias("n_words"))
    empty = lambda t: F.expr(f"cast(array() AS {t})")
    return out.join(per_document.hint("merge"), ["fh", "ri"], "left").select(
        "doc_id", "n_words", F.coalesce("spans", empty("array<struct<a:int,b:int>>")).alias("spans"),
        F.coalesce("items", empty("array<string>")).alias("items"), "fh", "ri")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and touching spans (sorted by their start) as one."""
    for batch in batches:
        spans = []
        for a, b in zip(batch["a"], batch["b"]):
            a, b = a.values.to_numpy(), np.maximum.accumulate(b.values.to_numpy())
            new = np.append(True, a[1:] > b[:-1])
            spans.append([{"a": x, "b": y} for x, y in zip(a[new].tolist(), b[np.append(new[1:], True)].tolist())])
        yield pa.RecordBatch.from_arrays(
            [batch["fh"], batch["ri"], pa.array(spans, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
             batch["items"]], ["fh", "ri", "spans", "items"])


def report(docs: DataFrame, items: DataFrame, window: int = 10, **columns: str) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    out = hits(docs, items, window, **columns)
    n_hit = F.expr("aggregate(spans, 0L, (n, x) -> n + x.b - x.a)")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, window: int = 10, **columns: str) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, with their columns."""
    docs = from_files(docs)
    gone = hits(docs, items, window, **columns).where("size(spans) > 0").select("fh", "ri")
    located = addressed(docs).select("row", F.xxhash64("loc.path").alias("fh"), F.col("loc.row").alias("ri"))
    return located.join(gone, ["fh", "ri"], "left_anti").select("row.*")
