"""Spelling variants: words one edit apart, found over a reduced alphabet.

1. Runs of letters are counted over all whole texts (combined per task); the
   vocabulary is the words of enough letters and occurrences.
2. Letters are hashed to ``SYMBOLS`` symbols.  Words that differ by one edit
   are reduced to words that differ by one edit or none: so each reduced
   word's full one-edit neighbourhood is generated (itself, every deletion,
   every replacement and insertion of a symbol) and joined with the reduced
   vocabulary.
3. One edit leaves either the first half of the other word's letters or the
   second half as it is, and the generated edit's place says which.  That half,
   in original letters, is part of the join key, so a reduced word that very
   many words share is split.  A bitmap of the vocabulary's keys, of bounded
   size, keeps neighbours that no word has out of the shuffle.
4. Candidates are verified on the original strings.
5. A word's form is its most frequent near word if that one is ``ratio`` times
   as frequent; roots follow the forms by pointer doubling.  Frequencies rise
   along forms, so there are no circles and few rounds.

Reduced words, halves and keys are 64-bit polynomial hashes; a collision adds a
candidate, which the verification drops.

Defined results
    null or empty text    no words
    null doc_id           counts as the empty text in the noise that is given
    repeated rows         each counts
    ties                  of near words with the largest count, the first in code-point order
    empty table           an empty result
    extra columns         ignored
    very long texts       read whole; a very long word has neighbours in proportion to its length
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import written
from eventide.llm.words import bitmap, mix64, present

#: Letters in Latin-1, A-Z lower-cased; all else is a blank.  One byte is one code point.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
#: Symbols of the reduced alphabet.
SYMBOLS = 6
#: Distinct words that a task counts before it hands its counts on.
COUNTED = 200_000
#: Letters of the words whose neighbours are generated at once.
CHUNK_LETTERS = 40_000

#: An odd base of the polynomial hashes, and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def counted(docs: DataFrame, least: int, id_col: str, text_col: str, change: Callable[[str], Callable] | None) -> DataFrame:
    """(word, n): runs of at least ``least`` letters and how often they stand in all texts.

    ``change`` (identifier as text -> (word -> word)), if given, rewrites the
    runs first, as Latin-1 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch["id"], batch["body"]):
                # Whatever Latin-1 does not hold becomes "?", which is no letter either.
                words = (text.as_py() or "").encode("latin-1", "replace").translate(LETTERS).split()
                words = [w for w in words if len(w) >= least]
                if change:
                    words = [w for w in map(change(doc.as_py() or ""), words) if len(w) >= least]
                seen.update(words)
            if len(seen) > COUNTED:
                yield flush()
        yield flush()

    read = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("body"))
    return read.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


def _sums(values: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes of each row: column i is the hash of the first i letters."""
    terms = values * _powers(_BASE, values.shape[1])
    return np.concatenate([np.zeros((len(values), 1), np.uint64), np.cumsum(terms, 1, dtype=np.uint64)], 1)


class Halves:
    """Words of one length: hashes of reduced words and of the halves that an edit leaves as they are."""

    def __init__(self, words: list[bytes], symbols: int):
        letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
        self.length = letters.shape[1]
        # The symbol of a letter: a multiplicative hash of its code point.
        self.symbols = symbols
        table = (mix64(np.arange(256, dtype=np.uint64)) >> np.uint64(32)) * np.uint64(symbols) >> np.uint64(32)
        self.reduced = table[letters] + np.uint64(1)
        self.own = _sums(letters.astype(np.uint64) + np.uint64(1))
        self.sums = _sums(self.reduced)
        self.power = _powers(_BASE, self.length + 2)
        self.back = _powers(_INVERSE, self.length + 2)

    def first(self, n: int) -> np.ndarray:
        """Hash of the first ``n`` letters."""
        return self.own[:, n:n + 1]

    def rest(self, n: int) -> np.ndarray:
        """Hash of the letters from ``n`` on."""
        return (self.own[:, -1:] - self.own[:, n:n + 1]) * self.back[n]

    @staticmethod
    def key(reduced: np.ndarray, half: np.ndarray, length: int, second: np.ndarray) -> np.ndarray:
        """Join key of a reduced word of ``length`` and one of its halves (0 or 1) in original letters."""
        return mix64(reduced + mix64(half + (second + np.uint64(2 * length))))

    def ends(self) -> np.ndarray:
        """The two keys that a word is found by: with its first half and with its second."""
        m = self.length // 2
        halves = np.concatenate([self.first(m), self.rest(m)], 1)
        return self.key(self.sums[:, -1:], halves, self.length, np.arange(2, dtype=np.uint64))

    def _kept_half(self, places: int, m: int, skip: int) -> tuple[np.ndarray, np.ndarray]:
        """For edits at each place: the half of the other word (cut at ``m``) that stays, and which it is."""
        second = (np.arange(places) < m).astype(np.uint64)
        return np.where(second, self.rest(m + skip), self.first(m)), second

    def neighbours(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(keys, which of them hold) of all words whose reduced form is one edit away, or none."""
        n, pre, whole = self.length, self.sums[:, :-1], self.sums[:, -1:]
        every = lambda k: (k, np.ones(k.shape, bool))
        yield every(self.ends())
        half, second = self._kept_half(n, n // 2, 0)
        for s in range(1, self.symbols + 1):  # another symbol at each place
            yield self.key(whole + (np.uint64(s) - self.reduced) * self.power[:n], half, n, second), self.reduced != s
        if n > 1:  # each place left out
            half, second = self._kept_half(n, (n - 1) // 2, 1)
            yield every(self.key(pre + (whole - self.sums[:, 1:]) * self.back[1], half, n - 1, second))
        half, second = self._kept_half(n + 1, (n + 1) // 2, -1)
        for s in range(1, self.symbols + 1):  # a symbol before each place, and at the end
            new = self.sums + np.uint64(s) * self.power[:n + 1] + (whole - self.sums) * self.power[1]
            yield every(self.key(new, half, n + 1, second))


_KEYED = "key long, word string, n long"


def _by_length(batches: Iterator[pa.RecordBatch], symbols: int) -> Iterator[tuple[Halves, pa.Array, pa.Array]]:
    """The batches' words as groups of one length and bounded size."""
    for batch in batches:
        words = [w.encode("latin-1") for w in batch["word"].to_pylist()]
        sizes = np.array(list(map(len, words)))
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            step = max(1, CHUNK_LETTERS // size)
            for at in range(0, len(own), step):
                rows = own[at:at + step]
                take = pa.array(rows)
                yield Halves([words[i] for i in rows], symbols), batch["word"].take(take), batch["n"].take(take)


def _keyed(keys: np.ndarray, rows: np.ndarray, words: pa.Array, n: pa.Array) -> pa.RecordBatch:
    take = pa.array(rows)
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), words.take(take), n.take(take)], ["key", "word", "n"])


def reduced_vocabulary(vocabulary: DataFrame, symbols: int) -> DataFrame:
    """(key, word, n): each word under its two keys (a written table)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, words, n in _by_length(batches, symbols):
            keys = group.ends()
            yield _keyed(keys.ravel(), np.repeat(np.arange(len(keys)), 2), words, n)

    return written(vocabulary.mapInArrow(run, _KEYED), "spelling-reduced")


def neighbourhoods(vocabulary: DataFrame, members: np.ndarray, symbols: int) -> DataFrame:
    """(key, word, n): each word under the keys of its reduced neighbourhood that some word may have (a written table)."""
    held = vocabulary.sparkSession.sparkContext.broadcast(members)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = held.value
        for group, words, n in _by_length(batches, symbols):
            rows, keys = [], []
            for k, holds in group.neighbours():
                row, at = np.nonzero(holds)
                k = k[row, at]
                hit = present(members, k)
                rows.append(row[hit])
                keys.append(k[hit])
            row, key = np.concatenate(rows), np.concatenate(keys)
            order = np.lexsort((key, row))
            row, key = row[order], key[order]
            new = np.append(True, (row[1:] != row[:-1]) | (key[1:] != key[:-1]))  # edits within runs of a symbol
            yield _keyed(key[new], row[new], words, n)

    return written(vocabulary.mapInArrow(run, _KEYED), "spelling-neighbours")


def near_words(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, other, other_n): all ordered pairs of words of ``vocabulary`` (word, n) that differ by
    exactly one inserted, deleted or replaced code point."""
    reduced = reduced_vocabulary(vocabulary, symbols)
    around = neighbourhoods(vocabulary, bitmap(reduced, "key"), symbols)
    other = reduced.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = around.join(other, "key").where((F.col("word") != F.col("other")) & (F.levenshtein("word", "other", 1) == 1))
    return pairs.select("word", "n", "other", "other_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each chain of forms, by pointer doubling on written tables."""
    at = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                F.col("next").isNotNull().alias("moved")), "spelling-roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, least: int = 7, occurrences: int = 2, ratio: int = 10, symbols: int = SYMBOLS,
             id_col: str = "doc_id", text_col: str = "text", change: Callable[[str], Callable] | None = None) -> DataFrame:
    """One row per word of the vocabulary: word, form, root, n, n_near, form_n."""
    if ratio <= 1:
        raise ValueError("a form must be more frequent than its word, or forms could run in circles")
    words = written(counted(docs, least, id_col, text_col, change).where(F.col("n") >= occurrences), "spelling-words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word")))
    near = near_words(words, symbols).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    near = written(near.select("word", "n_near", F.when(is_form, F.col("best.word")).alias("form"),
                               F.when(is_form, -F.col("best.less")).alias("form_n")), "spelling-near")
    out = words.join(near, "word", "left").join(roots(near.where("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
