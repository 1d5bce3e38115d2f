"""Removal of repeated byte strings by column-wise multi-document suffix sorting.

Every string of ``length`` bytes that starts at two places or more, in one
document or in several, is found; the bytes such strings cover are removed.

1. Candidates.  The anchor of a window (``length`` bytes) is its ``GRAM``-byte
   gram of smallest hash, the leftmost of equals: a function of the window's
   bytes alone, so equal windows have equal anchors at equal offsets.  Windows
   in a row with one anchor form a strand; a strand whose anchor occurs nowhere
   else holds no repeated window and is dropped, all others are kept, whole.
2. Equal strands are combined into one with a weight before anything is
   gathered; all windows of a strand of weight two or more are repeated.
3. Construction.  The distinct strands of an anchor are a collection of
   documents.  Their suffixes are inserted column by column, from the right:
   each round reads one symbol per strand, which stands before the suffix that
   the strand has inserted last.  In suffix order these symbols are the
   round's part of the collection's Burrows-Wheeler transform; sorting them
   stably orders the suffixes longer by that symbol, and a common prefix is
   one more than the smallest between the two in the previous order.  Strands
   are aligned at the anchor, and equal windows lie at equal offsets from it:
   so a round only needs the order and common prefixes of the column before,
   which it reads and replaces in sequence, and a window is repeated if its
   common prefix with a neighbour reaches ``length``.
4. An anchor with more than ``HOT`` distinct strands is cut: windows within
   ``width`` offsets share a core of ``length - width + 1`` bytes, which takes
   the anchor's place; at width 1 the core is the window, and weights decide.
   No group that a task holds grows with the corpus, and no strand is dropped.

The columns of a batch are held in memory, a few MB: files outside the shared
folder would be local to one machine, files in it larger than the corpus.

Defined results
    null text           counts as empty; nothing is removed
    null identifier     kept: rows are told apart by file and position, not by identifier
    repeated rows       are documents of their own, so their long strings are repeated
    ties                none: the result does not depend on any order
    empty table         an empty result
    extra columns       ignored by ``spans``; ``deduplicate`` returns them unchanged
    very long texts     read in overlapping pieces; no window is lost at a cut
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import removed, written
from eventide.llm.exact_dedup import addressed, from_files

LENGTH = 400
#: Bytes of an anchor, a power of two.
GRAM = 64
#: Distinct strands of one anchor that a task sorts at once, and strands per batch.
HOT, BATCH = 2_048, 16_384
#: Offsets that share a core at the second level.
WIDTH = 16
#: Bytes hashed at a time, and windows per piece of a long text.
CHUNK = 1 << 20

_STRAND = "key long, c0 long, c1 long, fh long, ri long, pos long, n int, a int"
_BODY = "key long, c0 long, c1 long, weight long, a int, distinct long, body binary"
_RANGE = "c0 long, c1 long, lo int, hi int"


def _digest(data: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def anchors(data: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the gram at every position, anchor of the window at every position)."""
    # Random table and odd multipliers, the same in every task.
    rng = np.random.default_rng(400)
    h = rng.integers(0, 2**63, 256, np.uint64)[data]
    step = 1
    while step < gram:
        h = h[:-step] * (rng.integers(0, 2**62, 1, np.uint64)[0] * np.uint64(2) + np.uint64(1)) + h[step:]
        step *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    low = np.uint64(0xFFFFFF)
    best = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    size, wide = 1, length - gram + 1
    while size * 2 <= wide:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if wide > size:
        best = np.minimum(best[:size - wide], best[wide - size:])
    return h.view(np.int64), (best & low).astype(np.int64)


def _pieced(texts: list[bytes], length: int, gram: int) -> Iterator[tuple]:
    """Per piece of a text: (text, offset, first windows, windows, anchors' offsets, hashes of the anchors) of its strands."""
    pieces: list[tuple[int, int, bytes]] = []
    for i, t in enumerate(texts):
        for at in range(0, len(t) - length + 1, CHUNK):
            pieces.append((i, at, t[at:at + CHUNK + length - 1] if len(t) > CHUNK else t))
    while pieces:
        held, some = 0, []
        while pieces and (not some or held + len(pieces[-1][2]) <= CHUNK):
            some.append(pieces.pop())
            held += len(some[-1][2])
        grams, anchor = anchors(np.frombuffer(b"".join(p[2] for p in some), np.uint8), length, gram)
        base = 0
        for i, at, t in some:
            own = anchor[base:base + len(t) - length + 1]
            first = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
            count = np.diff(np.concatenate([first, [len(own)]]))
            where = own[first]
            yield i, at, first, count, where - base - first, grams[where]
            base += len(t)


def strands(texts: list[bytes], length: int, gram: int = GRAM) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, first window, windows, anchor's offset in the strand, hash of the anchor)."""
    for i, at, *columns in _pieced(texts, length, gram):
        for f, n, a, k in zip(*(c.tolist() for c in columns)):
            yield i, at + f, n, a, k


def strand_keys(texts: list[bytes], length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The distinct anchors' hashes of the strands, and how many strands have each."""
    keys = [piece[-1] for piece in _pieced(texts, length, gram)]
    return np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_counts=True)


def least_between(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """min(values[first : last + 1]) for each pair (a sparse table of doubling spans)."""
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), values.dtype)
    spans, size = values, 1
    for k in range(int(level.max(initial=0)) + 1):
        if k:
            spans = np.minimum(spans[:-size], spans[size:])
            size *= 2
        mine = np.flatnonzero(level == k)
        if len(mine):
            out[mine] = np.minimum(spans[first[mine]], spans[last[mine] - size + 1])
    return out


def repeated_windows(bodies: list[bytes], anchor: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each strand that another strand holds too (-1: none).

    Column-wise construction over all given strands, aligned at their anchors.
    """
    sizes = np.array(list(map(len, bodies)))
    left, right = int(anchor.max()), int((sizes - anchor).max())
    table = np.zeros((len(bodies), left + right), np.uint8)  # 0: no symbol; bytes are kept plus one
    for i, (b, a) in enumerate(zip(bodies, anchor.tolist())):
        table[i, left - a:left - a + len(b)] = np.frombuffer(b, np.uint8) + 1
    columns = np.ascontiguousarray(table.T)
    del table
    start = left - anchor
    order, common = np.arange(len(bodies)), np.zeros(len(bodies), np.int16)
    first, last = np.full(len(bodies), -1), np.full(len(bodies), -1)
    for t in range(len(columns) - 1, -1, -1):
        transform = columns[t][order]  # this round's part of the transform
        rank = np.argsort(transform, kind="stable")
        symbols = transform[rank]
        order = order[rank]
        grown = np.zeros_like(common)
        same = np.flatnonzero((symbols[1:] == symbols[:-1]) & (symbols[1:] != 0)) + 1
        if len(same):
            lo, hi = rank[same - 1] + 1, rank[same]
            least = common[hi]
            far = np.flatnonzero(hi > lo)
            if len(far):
                least[far] = least_between(common, lo[far], hi[far])
            grown[same] = np.minimum(least + 1, length)
        common = grown
        if t + length <= len(columns):
            hit = np.flatnonzero(common >= length)
            if len(hit):
                found = order[np.unique(np.concatenate([hit - 1, hit]))]
                first[found] = t - start[found]
                new = found[last[found] < 0]
                last[new] = t - start[new]
    return first, last


def _constructed(rows: DataFrame, length: int) -> DataFrame:
    """Ranges (c0, c1, lo, hi) covered by repeated windows, from strands (key, c0, c1, a, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def build(held: list) -> pa.RecordBatch:
            first, last = repeated_windows([r[4] for r in held], np.array([r[3] for r in held]), length)
            hit = np.flatnonzero(last >= 0)
            return pa.RecordBatch.from_pydict({
                "c0": pa.array([held[i][1] for i in hit], pa.int64()),
                "c1": pa.array([held[i][2] for i in hit], pa.int64()),
                "lo": pa.array(first[hit], pa.int32()), "hi": pa.array(last[hit] + length, pa.int32())})

        held: list = []
        for batch in batches:
            for r in zip(*(batch[c].to_pylist() for c in ("key", "c0", "c1", "a", "body"))):
                if len(held) >= BATCH and r[0] != held[-1][0]:
                    yield build(held)
                    held = []
                held.append(r)
        if held:
            yield build(held)

    rows = rows.select("key", "c0", "c1", "a", "body")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, _RANGE)


def _cut(rows: DataFrame, width: int, length: int) -> DataFrame:
    """Strands cut into parts of ``width`` window offsets, keyed by the parts' cores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for key, c0, c1, weight, a, body in zip(*(batch[c].to_pylist() for c in
                                                      ("key", "c0", "c1", "weight", "a", "body"))):
                windows = len(body) - length + 1
                for j in range((a - windows + 1) // width, a // width + 1):
                    # Windows whose start lies j * width to (j + 1) * width - 1 before the anchor.
                    lo, hi = a - (j + 1) * width + 1, a - j * width
                    core = body[max(hi, 0):lo + length]
                    part = body[max(lo, 0):min(hi, windows - 1) + length]
                    new = _digest(b"%d %d " % (key, j) + core)[0]
                    d0, d1 = _digest(part)
                    for col, v in zip(out, (new, d0, d1, weight, a - max(lo, 0), part, c0, c1, max(lo, 0))):
                        col.append(v)
                if len(out[0]) >= 4_096:
                    yield pack(out)
                    out = [[] for _ in range(9)]
            yield pack(out)

    def pack(out: list[list]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]
        names = ["key", "c0", "c1", "weight", "a", "body", "p0", "p1", "base"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    schema = "key long, c0 long, c1 long, weight long, a int, body binary, p0 long, p1 long, base int"
    return rows.select("key", "c0", "c1", "weight", "a", "body").mapInArrow(run, schema)


def _ranges(rows: DataFrame, length: int, hot: int, width: int, made: list[DataFrame]) -> DataFrame:
    """Covered ranges of distinct strands (key, c0, c1, weight, a, distinct, body); hot anchors are cut.

    ``made`` gets the tables that the result reads.
    """
    found = _constructed(rows.where(F.col("distinct") <= hot), length)
    over = rows.where(F.col("distinct") > hot)
    if over.isEmpty():
        return found
    parts = written(_cut(over, width, length), "suffix-parts")
    alike = parts.groupBy("key", "c0", "c1").agg(F.sum("weight").alias("weight"))
    keys = alike.groupBy("key").agg(F.count(F.lit(1)).alias("distinct"))
    alike = written(alike.join(keys, "key"), "suffix-alike")
    made += [parts, alike]
    whole = alike.where("weight > 1").select("c0", "c1", F.lit(0).alias("lo"), F.lit(None).cast("int").alias("hi"))
    if width > 1:
        some = alike.where("distinct > 1").drop("key")
        bodies = parts.dropDuplicates(["c0", "c1"]).select("key", "c0", "c1", "a", "body").join(some, ["c0", "c1"])
        # Weight settles a part of two copies or more; the others are sorted with them.
        inner = _ranges(bodies.select("key", "c0", "c1", "weight", "a", "distinct", "body"), length, hot, 1, made)
        whole = whole.unionByName(inner)
    back = parts.select("c0", "c1", "p0", "p1", "base", F.length("body").alias("size"))
    mapped = back.join(whole, ["c0", "c1"]).select(
        F.col("p0").alias("c0"), F.col("p1").alias("c1"), (F.col("base") + F.col("lo")).cast("int").alias("lo"),
        (F.col("base") + F.coalesce("hi", "size")).cast("int").alias("hi"))
    # One row per strand again: its repeated windows are less than ``length`` apart, so their cover is one range.
    mapped = mapped.groupBy("c0", "c1").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return found.unionByName(mapped)


def _located(docs: DataFrame) -> DataFrame:
    """(row, fh, ri): each row and its address."""
    return addressed(docs).select("row", F.xxhash64("loc.path").alias("fh"), F.col("loc.row").alias("ri"))


def _body(text_col: str) -> Column:
    """The bytes of a located row's text."""
    return F.coalesce(F.col(f"row.{text_col}").cast("string").cast("binary"), F.lit(b""))


def covered(docs: DataFrame, length: int = LENGTH, text_col: str = "text", hot: int = HOT,
            gram: int = GRAM) -> DataFrame:
    """(fh, ri, ranges): per row with repeated windows, the covered byte ranges (not yet merged)."""
    if length < 2 * gram:
        raise ValueError("a window must be at least two anchors long")
    docs = from_files(docs)
    texts = _located(docs).select("fh", "ri", _body(text_col).alias("body"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                keys, times = strand_keys(batch["body"].slice(at, 1024).to_pylist(), length, gram)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(times, pa.int64())], ["key", "w"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("c0", pa.int64()), ("c1", pa.int64()), ("fh", pa.int64()),
                            ("ri", pa.int64()), ("pos", pa.int64()), ("n", pa.int32()), ("a", pa.int32())])
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                fh, ri, bodies = (part[c].to_pylist() for c in ("fh", "ri", "body"))
                out: list[list] = [[] for _ in range(8)]
                for i, f, n, a, k in strands(bodies, length, gram):
                    d0, d1 = _digest(bodies[i][f:f + n + length - 1])
                    for col, v in zip(out, (k, d0, d1, fh[i], ri[i], f, n, a)):
                        col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, schema)], schema=schema)

    long = texts.where(F.length("body") >= length)
    # Texts are cut twice, for the anchors alone and then for the strands: most strands have an anchor of their
    # own, and a table of all of them would be larger than the corpus.
    # Written first: a join of two plain exchanges is one that Spark splits where a key is hot.
    shared = written(long.select("body").mapInArrow(count, "key long, w long").groupBy("key")
                     .agg(F.sum("w").alias("w")).where("w > 1").select("key"), "suffix-shared")
    kept = written(long.mapInArrow(find, _STRAND).join(shared, "key"), "suffix-candidates")
    removed(shared)
    alike = kept.groupBy("key", "c0", "c1").agg(F.count(F.lit(1)).alias("weight"),
                                                F.min(F.struct("fh", "ri", "pos", "n", "a")).alias("r"))
    keys = alike.groupBy("key").agg(F.count(F.lit(1)).alias("distinct"))
    alike = written(alike.join(keys, "key").select("key", "c0", "c1", "weight", "distinct", "r.*"), "suffix-distinct")

    # One copy of each strand that has others beside it goes to the construction.
    wanted = (alike.where("distinct > 1").groupBy("fh", "ri")
              .agg(F.collect_list(F.struct("key", "c0", "c1", "weight", "a", "distinct", "pos", "n")).alias("s")))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("c0", pa.int64()), ("c1", pa.int64()), ("weight", pa.int64()),
                            ("a", pa.int32()), ("distinct", pa.int64()), ("body", pa.binary())])
        for batch in batches:
            rows: list[dict] = []
            for body, own in zip(batch["body"].to_pylist(), batch["s"].to_pylist()):
                for s in own:
                    at, n = s.pop("pos"), s.pop("n")
                    rows.append({**s, "body": body[at:at + n + length - 1]})
                if len(rows) >= 4_096:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema)

    bodies = written(long.join(wanted, ["fh", "ri"]).select("body", "s").mapInArrow(fetch, _BODY), "suffix-bodies")
    made = [bodies]
    ranges = written(_ranges(bodies, length, hot, WIDTH, made), "suffix-ranges")
    removed(*made)
    single = ranges.join(alike.where("weight = 1").select("c0", "c1"), ["c0", "c1"], "left_semi")
    whole = alike.where("weight > 1").select("c0", "c1", F.lit(0).alias("lo"), (F.col("n") + length - 1).alias("hi"))
    # Strands are told by content; every place of one has the same covered range.
    places = kept.select("c0", "c1", "fh", "ri", "pos").join(single.unionByName(whole), ["c0", "c1"])
    out = written(places.groupBy("fh", "ri")
                  .agg(F.collect_list(F.struct((F.col("pos") + F.col("lo")).alias("lo"),
                                               (F.col("pos") + F.col("hi")).alias("hi"))).alias("ranges")), "suffix-covered")
    removed(kept, alike, ranges)
    return out


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the covered bytes."""
    out: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def whole_characters(body: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without the bytes of characters that lie only partly in them."""
    out = []
    for lo, hi in runs:
        while lo < hi and body[lo] & 0xC0 == 0x80:
            lo += 1
        while hi > lo and hi < len(body) and body[hi] & 0xC0 == 0x80:
            hi -= 1
        if lo < hi:
            out.append((lo, hi))
    return out


def remaining(body: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for lo, hi in runs:
        kept.append(body[at:lo])
        at = hi
    return b"".join([*kept, body[at:]])


def spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
          hot: int = HOT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the removed ``spans``."""
    docs = from_files(docs)
    rows = _located(docs).select(F.col(f"row.{id_col}").cast("long").alias("doc_id"), "fh", "ri", _body(text_col).alias("body"))
    joined = rows.join(covered(docs, length, text_col, hot), ["fh", "ri"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            bodies = batch["body"].to_pylist()
            for body, ranges in zip(bodies, batch["ranges"].to_pylist()):
                runs = merged([(r["lo"], r["hi"]) for r in ranges or ()])
                for col, v in zip(out, (len(body), sum(b - a for a, b in runs), len(runs),
                                        hashlib.sha256(remaining(body, runs)).hexdigest(),
                                        [{"lo": a, "hi": b} for a, b in runs])):
                    col.append(v)
            run = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), run]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, k) for c, k in zip(out, kinds))],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return joined.select("doc_id", "body", "ranges").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
             "spans array<struct<lo: long, hi: long>>")


def deduplicate(docs: DataFrame, length: int = LENGTH, text_col: str = "text", hot: int = HOT,
                gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated strings taken out of the text, whole characters only.

    A character that a removed run covers only in part stays, so that the text stays valid.
    """
    docs = from_files(docs)
    found = covered(docs, length, text_col, hot, gram)
    # The bytes are taken after the join, so that a text is dealt out once.
    joined = _located(docs).join(found, ["fh", "ri"], "left")
    # A text without any such string, null included, stays as it is.
    text = F.when(F.col("ranges").isNull(), F.col(f"row.{text_col}")).otherwise(_shortened()(_body(text_col), "ranges"))
    return joined.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


def _shortened():
    @F.udf("string", useArrow=True)
    def shorten(body, ranges):
        if not ranges:
            return None
        runs = whole_characters(body, merged([(r["lo"], r["hi"]) for r in ranges]))
        return remaining(body, runs).decode()

    return shorten
