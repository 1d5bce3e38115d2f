"""Words of whole texts as bytes, packed values per word, and membership bitmaps of bounded size."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Per UTF-8 byte: A-Z become a-z, the bytes of words ([0-9a-z] and all beyond ASCII) stay, others are blanks.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))
#: Words whose value a task keeps: the first ones seen hold the common words.
KEPT_WORDS = 200_000
#: Largest bitmap in bits (16 MB): with more members it only lets more strangers through.
MOST_BITS = 1 << 27


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text, lower-cased in A-Z."""
    return text.translate(WORD_BYTES).split() if text else []


class PerWord:
    """Values of fixed width for lists of words, remembered for the first ``KEPT_WORDS`` words of a task."""

    def __init__(self, make: Callable[[bytes], bytes], dtype: str):
        self.make, self.dtype = make, np.dtype(dtype)
        self.kept: dict[bytes, bytes] = {}

    def _new(self, word: bytes) -> bytes:
        value = self.kept.get(word) or self.make(word)
        if len(self.kept) < KEPT_WORDS:
            self.kept[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        known = list(map(self.kept.get, words))
        if None in known:
            known = [self._new(w) if v is None else v for w, v in zip(words, known)]
        return np.frombuffer(b"".join(known), self.dtype)


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (multiply and shift, twice)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def bitmap(keys: DataFrame, col: str) -> np.ndarray:
    """A bitmap of the 64-bit hashes in ``col``, two bits each, at most ``MOST_BITS`` large.

    It is made by one combined aggregate over its 64-bit slots, so the driver
    gets at most ``MOST_BITS`` / 64 pairs of numbers, whatever the table's size.
    """
    n = keys.select(F.approx_count_distinct(col)).first()[0]
    bits = min(MOST_BITS, 1 << max(10, math.ceil(math.log2(24 * max(n, 1)))))
    low = (bits - 1).bit_length()
    at = lambda shift: F.shiftrightunsigned(F.col(col), shift).bitwiseAND(bits - 1)
    slots = (keys.select(F.explode(F.array(at(0), at(low))).alias("b"))
             .select(F.shiftright("b", 6).alias("slot"), F.expr("shiftleft(1L, int(b & 63))").alias("v"))
             .groupBy("slot").agg(F.bit_or("v").alias("v"))).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[slots["slot"].to_numpy()] = slots["v"].to_numpy().view(np.uint64)
    return out


def present(members: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the 64-bit hashes ``h`` may be members; no member is missed."""
    bits = len(members) * 64
    low = np.uint64((bits - 1).bit_length())

    def test(b: np.ndarray) -> np.ndarray:
        return (members[b >> np.uint64(6)] >> (b & np.uint64(63))) & np.uint64(1) != 0

    hit = test(h & np.uint64(bits - 1))
    hit[hit] = test((h[hit] >> low) & np.uint64(bits - 1))
    return hit
