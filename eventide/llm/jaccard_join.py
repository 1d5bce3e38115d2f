"""Near-duplicate groups by a parity-sketch join on word shingles.

1. A document's set of ``width``-word shingles is hashed; documents with equal
   sets are one class, which takes part once, whatever its size.
2. Token hashes are XOR-ed into sketches: a set is dealt over p parts by hash
   and each part holds the XOR of its tokens (its parity).  A token in one set
   but not in the other changes one part, so the number of unequal parts (the
   sketches' Hamming distance) is at most the symmetric difference.  Linked
   sets differ by D tokens at most, where D follows from the similarity and
   the size band.  With p > D parts one part at least must be equal
   (pigeonhole): documents are joined on (band, part, parity).  A class emits
   under its own size band and the next, so that neighbours in size meet.
   Empty parts are equal for no reason: there are spare parts for them, and a
   class with more empty parts than spares emits these, too, so that no link
   is lost.  Bands with D = 1 use the parities of the set with one token left
   out; with D = 0 only equal sets link, which are one class already.
3. Candidates of a key are compared with the key's pivot, not with each other;
   bit sketches (parity of the tokens per bit) whose Hamming distance
   exceeds D, or sizes too far apart, rule a pair out before the sets are
   fetched: short sketches first, then, for large sets, whose D is beyond what
   a short sketch can show, wide ones of a bit per token or more.  Sets are
   fetched for what is left of the pairs, in each round for its own, and go
   when they are compared.  Then connected components.  In keys that hold several, two more
   pivots are drawn by a hash of key and member, one in the largest component and one outside;
   at last, members that are not in their key's largest component are compared
   with the members of other components.
   Every pair that shares a key then lies in one component or was compared, so
   the components are exact, while a group of near copies costs a few comparisons
   per member.
4. Pairs are verified on the sets themselves.

Defined results
    null or empty text, no words   the empty set: size 0, linked with nothing
    null identifier                a row of its own; ``component_id`` is the smallest non-null one, if any
    repeated rows                  equal sets, so one class
    ties                           none: components do not depend on order
    empty table                    an empty result
    extra columns                  ignored by ``groups``; ``deduplicate`` returns them
    very long texts                read whole; a set is held by one task at a time
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import per_process, removed, shards, written
from eventide.llm.components import connected
from eventide.llm.exact_dedup import addressed, from_files

#: Word hashes kept per worker process: the first ones seen hold the common words.
CACHE_WORDS = 150_000
#: Texts, and pairs of sets, that a Python worker gets at once.
TEXT_ROWS, PAIR_ROWS = 1_000, 128
#: Part parities that a task holds before it sends them on.
HELD_KEYS = 500_000
#: Part parities per bucket that one task sorts, and the least number of buckets.
BUCKET_KEYS, LEAST_BUCKETS = 500_000, 256
#: Rounds of drawn pivots, after the first and before what is left is joined.
PIVOT_ROUNDS = 1
#: 64-bit words of the short bit sketch.  Sets with more tokens than it has bits have a wide one, too.
SKETCH = 16

_SKETCH = [f"s{i}" for i in range(SKETCH)]
_SETS = "id long, fh long, ri long, n long, d0 long, node binary, wide array<long>, " + ", ".join(f"{s} long" for s in _SKETCH)


class Similarity:
    """Jaccard similarity of ``num / den`` or more: size bands and difference bounds."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.edges = [1]
        self.parts: dict[int, int] = {}

    def band(self, size: int) -> int:
        """Band of a set size: partners lie in the same band or a neighbouring one."""
        while self.edges[-1] <= size:
            x = self.edges[-1]
            self.edges.append(max(x + 1, (x - 1) * self.den // self.num + 1))
        return int(np.searchsorted(self.edges, size, "right")) - 1

    def difference(self, sizes: int) -> int:
        """Largest symmetric difference of linked sets whose sizes sum up to ``sizes``."""
        return (self.den - self.num) * sizes // (self.den + self.num)

    def of_band(self, band: int) -> int:
        """The same for any two sets of which the larger lies in ``band``."""
        while len(self.edges) < band + 2:
            self.band(self.edges[-1])
        return self.difference(2 * (self.edges[band + 1] - 1))

    def parts_of(self, band: int) -> int:
        """Parts of the sketches compared in ``band``: more than the difference bound, with
        spares for the parts that stay empty even in the smallest set (by four deviations)."""
        if band not in self.parts:
            d, least = self.of_band(band), self.edges[max(band - 1, 0)]
            filled = lambda p: p - (e := p * math.exp(-least / p)) - 4 * math.sqrt(e)
            # Where sets are too small for any number, their empty parts are emitted instead.
            self.parts[band] = next((p for p in range(d + 2, 2 * d + 4) if filled(p) >= d + 1), d + 2)
        return self.parts[band]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Shingler:
    """Hashed shingle sets of texts."""

    def __init__(self):
        self.words: dict[bytes, bytes] = {}

    def _hash(self, word: bytes) -> bytes:
        h = self.words.get(word)
        if h is None:
            h = hashlib.blake2b(word, digest_size=8).digest()
            if len(self.words) < CACHE_WORDS:
                self.words[word] = h
        return h

    def set_of(self, text: bytes | None, width: int) -> np.ndarray:
        """Sorted distinct hashes of the text's shingles; bytes split at ASCII blanks and lower A-Z only."""
        words = text.lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        known = list(map(self.words.get, words))
        if None in known:
            known = [self._hash(w) if h is None else h for w, h in zip(words, known)]
        w = np.frombuffer(b"".join(known), "<u8")
        k = min(width, len(w))
        h = np.full(len(w) - k + 1, k, np.uint64)
        for i in range(k):
            h = mixed(h + w[i:len(w) - k + 1 + i])
        return np.unique(h)


def shingler() -> Shingler:
    return per_process("shingler", Shingler)


def part_keys(tokens: np.ndarray, sim: Similarity) -> np.ndarray:
    """Join keys of a set (sorted hashes), under its own size band and the next one."""
    own = sim.band(len(tokens))
    out = []
    for band in (own, own + 1):
        d = sim.of_band(band)
        if d == 0:
            continue
        salt = np.uint64(band) << np.uint64(40)
        if d == 1:
            whole = np.bitwise_xor.reduce(tokens)
            out.append(mixed(np.append(tokens ^ whole, whole) + salt))
            continue
        p = sim.parts_of(band)
        part = ((tokens >> np.uint64(32)) * np.uint64(p)) >> np.uint64(32)  # sorted, as the tokens are
        first = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])
        parity, index = np.bitwise_xor.reduceat(tokens, first), part[first]
        if p - len(index) >= p - d:
            empty = np.setdiff1d(np.arange(p, dtype=np.uint64), index)
            parity, index = np.append(parity, np.zeros(len(empty), np.uint64)), np.append(index, empty)
        out.append(mixed(mixed(parity) + salt + index))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def bit_sketch(tokens: np.ndarray, words: int = SKETCH) -> np.ndarray:
    """Parity of the tokens per bit, as ``words`` 64-bit words.  The XOR of its halves is the sketch of half as many."""
    bits = np.bincount((tokens % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def wide_sketch(tokens: np.ndarray) -> np.ndarray | None:
    """The sketch of the first doubling of ``SKETCH`` words that has a bit per token; none if that is the short one."""
    words = SKETCH
    while 64 * words < len(tokens):
        words *= 2
    return bit_sketch(tokens, words) if words > SKETCH else None


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    inter = int((both[1:] == both[:-1]).sum())
    return den * inter >= num * (len(a) + len(b) - inter)


def sets(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: identifier, address, set size, class and bit sketch (a written table)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = shingler()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                n, d0, node, wide = [], [], [], []
                sketch = np.zeros((part.num_rows, SKETCH), np.int64)
                for i, text in enumerate(part["body"].to_pylist()):
                    tokens = make.set_of(text, width)
                    digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
                    n.append(len(tokens))
                    d0.append(int.from_bytes(digest[:8], "little", signed=True))
                    node.append(digest)
                    wide.append(wide_sketch(tokens))
                    sketch[i] = bit_sketch(tokens)
                yield pa.RecordBatch.from_arrays(
                    [part["id"], part["fh"], part["ri"], pa.array(n, pa.int64()), pa.array(d0, pa.int64()),
                     pa.array(node, pa.binary()), pa.array(wide, pa.list_(pa.int64())),
                     *(pa.array(sketch[:, i]) for i in range(SKETCH))],
                    ["id", "fh", "ri", "n", "d0", "node", "wide", *_SKETCH])

    return written(_texts(docs, id_col, text_col).mapInArrow(run, _SETS), "jaccard-sets", batch_rows=TEXT_ROWS)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return addressed(docs).select(F.col(f"row.{id_col}").cast("long").alias("id"), F.xxhash64("loc.path").alias("fh"),
                                  F.col("loc.row").alias("ri"),
                                  F.col(f"row.{text_col}").cast("string").cast("binary").alias("body"))


def shared_keys(texts: DataFrame, width: int, num: int, den: int, buckets: int) -> DataFrame:
    """(key, d0): the classes of every key that two classes or more have."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, sim = shingler(), Similarity(num, den)

        def flush(keys: list[np.ndarray], ids: list[int]) -> pa.RecordBatch:
            k = np.concatenate(keys)
            who = np.repeat(np.array(ids, np.int64), list(map(len, keys)))
            bucket = (k % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            k, who, bucket = k[order], who[order], bucket[order]
            at = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
            return pa.RecordBatch.from_pydict({
                "bucket": pa.array(bucket[at[:-1]]),
                "keys": pa.array([k[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                "ids": pa.array([who[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())})

        seen: set[bytes] = set()
        keys: list[np.ndarray] = []
        ids: list[int] = []
        held = 0
        for batch in batches:
            for text in batch["body"]:
                tokens = make.set_of(text.as_py(), width)
                digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
                if not len(tokens) or digest in seen:
                    continue
                if len(seen) < 100_000:  # copies met again in this task need not be sent twice
                    seen.add(digest)
                own = part_keys(tokens, sim)
                if len(own):
                    keys.append(own)
                    ids.append(int.from_bytes(digest[:8], "little", signed=True))
                    held += len(own)
                if held >= HELD_KEYS:
                    yield flush(keys, ids)
                    keys, ids, held = [], [], 0
        if keys:
            yield flush(keys, ids)

    def match(group: pa.Table) -> pa.Table:
        pairs = np.empty((sum(len(k) for k in group["keys"].to_pylist()) // 8, 2), np.int64)
        at = 0
        for k, i in zip(group["keys"], group["ids"]):
            k, i = np.frombuffer(k.as_py(), np.int64), np.frombuffer(i.as_py(), np.int64)
            pairs[at:at + len(k), 0], pairs[at:at + len(k), 1] = k, i
            at += len(k)
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        new = np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)])  # copies from other tasks
        pairs = pairs[new]
        same = pairs[1:, 0] == pairs[:-1, 0]
        keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        return pa.table({"key": pa.array(pairs[keep, 0]), "d0": pa.array(pairs[keep, 1])})

    blocks = texts.select("body").mapInArrow(emit, "bucket int, keys binary, ids binary")
    return written(blocks.groupBy("bucket").applyInArrow(match, "key long, d0 long"), "jaccard-keys", batch_rows=TEXT_ROWS)


def _possible(a: str, b: str, num: int, den: int) -> Column:
    """Sizes and bit sketches that do not rule a link out."""
    c = lambda side, name: F.col(f"{side}.{name}")
    small, large = F.least(c(a, "n"), c(b, "n")), F.greatest(c(a, "n"), c(b, "n"))
    apart = sum((F.bit_count(c(a, f"s{i}").bitwiseXOR(c(b, f"s{i}"))) for i in range(SKETCH)), F.lit(0))
    return (small * den >= large * num) & (apart * (num + den) <= (small + large) * (den - num))


def _halved(sketch: Column) -> Column:
    half = (F.size(sketch) / 2).cast("int")
    return F.zip_with(F.slice(sketch, 1, half), F.slice(sketch, half + 1, half), lambda x, y: x.bitwiseXOR(y))


def narrowed(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """``pairs`` (a, b), of sizes that do not rule a link out, without those that the wide sketches of both rule out."""
    side = lambda node, m: (classes.where("wide IS NOT NULL")
                            .select(F.col("node").alias(node), F.struct("n", "wide").alias(m)))
    met = pairs.join(side("a", "x"), "a", "left").join(side("b", "y"), "b", "left")
    for _ in range(math.ceil(math.log2(den / num))):  # sizes differ by that factor at most: sketches by as many doublings
        x, y = F.col("x.wide"), F.col("y.wide")
        met = met.select("a", "b", F.struct("x.n", F.when(F.size(x) > F.size(y), _halved(x)).otherwise(x).alias("wide")).alias("x"),
                         F.struct("y.n", F.when(F.size(y) > F.size(x), _halved(y)).otherwise(y).alias("wide")).alias("y"))
    unequal = F.zip_with("x.wide", "y.wide", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("long"))
    apart = F.aggregate(unequal, F.lit(0).cast("long"), lambda total, n: total + n)
    possible = apart * (num + den) <= (F.col("x.n") + F.col("y.n")) * (den - num)
    return met.where(F.coalesce(possible, F.lit(True))).select("a", "b")


def sets_of(pairs: DataFrame, classes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(node, tokens): the sets of the classes in ``pairs``, one copy each (a written table)."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = shingler()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                tokens = [make.set_of(t.as_py(), width).tobytes() for t in part["body"]]
                yield pa.RecordBatch.from_arrays([part["node"], pa.array(tokens, pa.binary())], ["node", "tokens"])

    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = written(nodes.join(classes.select("node", "r.fh", "r.ri"), "node"), "jaccard-wanted")
    bodies = written(texts.join(wanted, ["fh", "ri"]).select("node", "body").mapInArrow(load, "node binary, tokens binary"),
                     "jaccard-bodies", batch_rows=TEXT_ROWS)
    removed(wanted)
    return bodies


def verified(pairs: DataFrame, bodies: DataFrame, num: int, den: int) -> DataFrame:
    """The linked ones of ``pairs`` (a, b), compared on their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), num, den)
                  for x, y in zip(batch["x"], batch["y"])]
            yield pa.RecordBatch.from_arrays([batch["a"].filter(pa.array(ok)), batch["b"].filter(pa.array(ok))], ["a", "b"])

    x = bodies.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    y = bodies.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def _pair(x: str, y: str) -> list[Column]:
    return [F.greatest(f"{x}.node", f"{y}.node").alias("a"), F.least(f"{x}.node", f"{y}.node").alias("b")]


def _untested(met: DataFrame, x: str, y: str, tested: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs of ``met`` that may be links and were not compared yet (a written table)."""
    pairs = met.where(_possible(x, y, num, den)).select(*_pair(x, y)).distinct()
    return written(narrowed(pairs.join(tested, ["a", "b"], "left_anti"), classes, num, den), "jaccard-late")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components by ``roots`` after further ``links``."""
    if not links.isEmpty():
        roots = connected(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links))
    removed(links)
    return roots


def _mixed(keyed: DataFrame, sketches: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the keys that hold several components (a written table): key, m, its
    component's root, and whether it lies outside the key's largest component."""
    nodes = sketches.join(roots, "node", "left").select("d0", F.struct("node", "n", *_SKETCH).alias("m"),
                                                        F.coalesce("root", "node").alias("root"))
    keys = (keyed.join(nodes, "d0").groupBy("key", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("key")
            .agg(F.max_by("root", F.struct("c", "root")).alias("most"), F.count(F.lit(1)).alias("roots"))
            .where("roots > 1").select("key", "most"))
    keys = written(keys, "jaccard-mixed")
    placed = keyed.join(keys, "key").join(nodes, "d0")
    placed = written(placed.select("key", "m", "root", (F.col("root") != F.col("most")).alias("outside")), "jaccard-placed")
    removed(keys)
    return placed


def groups(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
           text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, and whether it is its group's kept row
    (``kept``: the smallest identifier, then the first by address), with the address (fh, ri)."""
    docs = from_files(docs)
    rows = sets(docs, width, id_col, text_col)
    texts = _texts(docs, id_col, text_col)
    info = ["node", "n", *_SKETCH]
    address = F.min(F.struct("fh", "ri")).alias("r")
    classes = written(rows.where("n > 0").groupBy("d0", *info).agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "fh", "ri")).alias("least"), address,
        F.max("wide").alias("wide")), "jaccard-classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    buckets = buckets or shards(total // 2, BUCKET_KEYS, LEAST_BUCKETS)
    keyed = shared_keys(texts, width, num, den, buckets)

    # Classes that share a key, with their sketches; members of keys are their 64-bit names alone.
    sketches = written(keyed.select("d0").distinct().join(classes.select("d0", *info), "d0"), "jaccard-sketches")

    def linked(pairs: DataFrame) -> DataFrame:
        bodies = sets_of(pairs, classes, texts, width)
        links = written(verified(pairs, bodies, num, den), "jaccard-links", batch_rows=PAIR_ROWS)
        removed(bodies)
        return links

    # Round 1: members against their key's pivot.
    # (Written first: a join of two plain exchanges is one that Spark splits where a key is hot.)
    pivots = written(keyed.groupBy("key").agg(F.min("d0").alias("p0")), "jaccard-pivots")
    # A pair comes from many keys: sketches are fetched once per pair, not once per key and member.
    pairs = written(keyed.join(pivots, "key").where("d0 != p0").select("d0", "p0").distinct(), "jaccard-star")
    removed(pivots)
    side = lambda d0, m: sketches.select(F.col("d0").alias(d0), F.struct(*info).alias(m))
    star = pairs.join(side("d0", "m"), "d0").join(side("p0", "p"), "p0").where(_possible("m", "p", num, den))
    tested = written(narrowed(star.select(*_pair("m", "p")), classes, num, den), "jaccard-pairs")
    removed(pairs)
    compared = [tested]
    links = linked(tested)
    roots = connected(links)
    removed(links)

    # Rounds of drawn pivots: keys differ in theirs, so the components of a group of near copies merge
    # at a cost in proportion to the members, before any two sides of a key are joined.
    for n in range(PIVOT_ROUNDS):
        placed = _mixed(keyed, sketches, roots)
        drawn = F.xxhash64("key", F.lit(n), "m.node")
        end = F.struct("m", "root")
        ends = written(placed.groupBy("key").agg(F.min_by(end, F.when(F.col("outside"), drawn)).alias("few"),
                                                 F.min_by(end, F.when(~F.col("outside"), drawn)).alias("most")),
                       "jaccard-drawn")
        met = placed.join(ends.select("key", F.explode(F.array("few", "most")).alias("p")), "key").where("root != p.root")
        late = _untested(met.select("m", F.col("p.m").alias("p")), "m", "p", tested, classes, num, den)
        removed(placed, ends)
        compared.append(late)
        if late.isEmpty():
            continue
        tested = tested.unionByName(late)
        roots = _joined(roots, linked(late))

    # Last round: in keys that still hold several components, what is not in the largest one against the others.
    placed = _mixed(keyed, sketches, roots)
    if placed.isEmpty():  # no key does, and no rows to free
        removed(keyed, sketches)
    else:
        few = placed.where("outside").select("key", F.col("m").alias("x"), F.col("root").alias("rx"))
        others = placed.select("key", F.col("m").alias("y"), F.col("root").alias("ry"))
        late = _untested(few.join(others, "key").where("rx != ry"), "x", "y", tested, classes, num, den)
        removed(placed, keyed, sketches)
        compared.append(late)
        if not late.isEmpty():
            roots = _joined(roots, linked(late))
    removed(*compared)

    # Per class, then per component, then per row.
    rooted = classes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("first"))
    first = written(rooted.select("node", "root").join(least, "root").select("node", "first"), "jaccard-first")
    removed(classes)
    out = rows.select("id", "fh", "ri", "n", "node").join(first, "node", "left")
    kept = F.coalesce((F.col("fh") == F.col("first.fh")) & (F.col("ri") == F.col("first.ri")), F.lit(True))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("first.id")).otherwise(F.col("id")).alias("component_id"),
                      kept.alias("kept"), "fh", "ri")


def deduplicate(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group; rows without words all stay."""
    docs = from_files(docs)
    gone = groups(docs, width, num, den, id_col, text_col).where("NOT kept").select("fh", "ri")
    located = addressed(docs).select("row", F.xxhash64("loc.path").alias("fh"), F.col("loc.row").alias("ri"))
    return located.join(gone, ["fh", "ri"], "left_anti").select("row.*")
