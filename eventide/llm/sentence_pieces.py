"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is marked (a leading mark, spaces as marks) and cut into marked words:
no piece of the vocabulary holds a mark after another character, so no piece
crosses a cut.  The distinct marked words of a batch are sorted, which lays
them out as a depth-first walk of their trie, and a lattice of pieces is
scored forward over each word; the states of the prefix that a word shares
with the one before are taken over, not computed again.

The model files here are byte-pair ones, whose library merges pairs by score.
Their segmentation is the only path of the lattice on which neighbouring
pieces are stable (merging the two pieces' characters gives those two pieces
again), so an arc scores 0 if it is stable after the state's last piece and
minus infinity otherwise, and one live state per prefix remains.  The results
equal the library's.  Words with runs of marks, whose pieces share one score,
are merged directly.

Defined results
    null or empty text    no ids; decodes to the empty text
    null identifier       kept
    unknown characters    their UTF-8 bytes' ids
    repeated rows, ties   each row alone; the segmentation is unique
    empty table           an empty result
    extra columns         ignored
    very long texts       encoded whole, word by word
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import per_process

MARK = "▁"
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Words and piece pairs kept per worker process: the first ones seen hold the common ones.
CACHE_WORDS, CACHE_PAIRS = 200_000, 200_000
#: Documents whose distinct words are walked together.
SLICE = 1_024


class Pieces:
    """The vocabulary of a model file, with encoding and decoding."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size())
                 if not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, self.ids))
        self.texts = {i: p.encode() for p, i in self.ids.items()} | {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a mark after another character: words can't be cut at marks")
        self.packed = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        self.byte_packed = [i.to_bytes(4, "little") for i in self.byte_ids]
        self.words: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merge(self, text: str) -> list[str]:
        """Byte-pair merging: best score first, leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = max((score.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == -np.inf:
                break
            parts[-at:-at + 2] = [parts[-at] + parts[-at + 1]]
        return parts

    def stable(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` gives these two pieces again."""
        found = self.pairs.get((left, right))
        if found is None:
            found = self.merge(left + right) == ([left, right] if left else [right])
            if len(self.pairs) < CACHE_PAIRS:
                self.pairs[left, right] = found
        return found

    def segment(self, words: list[str]) -> Iterator[tuple[str, list[str]]]:
        """(word, pieces) of distinct words, sharing forward states between neighbours in order."""
        ids, longest, pairs = self.ids, self.longest, self.pairs
        before, last = "", [""]  # last[i]: the final piece of the one live path over the first i characters
        for word in sorted(words):
            if MARK * 2 in word:
                yield word, self.merge(word)
                continue
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del last[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                # At most one arc into a prefix is stable, so the order is free: short ones are most often it.
                for start in range(end - 1, max(-1, end - longest - 1), -1):
                    piece = word[start:end]
                    if piece in ids or end - start == 1:
                        arc = (last[start], piece)
                        fits = pairs.get(arc)
                        if fits or fits is None and self.stable(*arc):
                            last.append(piece)
                            break
                else:
                    raise ValueError(f"no path over {word[:end]!r}")
            before, at, out = word, len(word), []
            while at:
                out.append(last[at])
                at -= len(last[at])
            yield word, out[::-1]

    def _packed(self, parts: list[str]) -> bytes:
        packed = list(map(self.packed.get, parts))
        if None in packed:  # unknown characters: one id per byte
            packed = [b"".join([self.byte_packed[b] for b in p.encode()]) if x is None else x
                      for p, x in zip(parts, packed)]
        return b"".join(packed)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, packed as little-endian 32-bit integers."""
        cut = [_WORDS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = {w for words in cut for w in words if w not in self.words}
        found = {w: self._packed(parts) for w, parts in self.segment(list(new))}
        for w in found:
            if len(self.words) >= CACHE_WORDS:
                break
            self.words[w] = found[w]
        kept = self.words.get
        out = []
        for words in cut:
            ids = list(map(kept, words))
            out.append(b"".join([found[w] if x is None else x for w, x in zip(words, ids)] if None in ids else ids))
        return out

    def decode(self, packed: list[bytes]) -> list[str]:
        """Texts of packed ids; bytes that are no UTF-8 become U+FFFD."""
        get = self.texts.get
        out = []
        for p in packed:
            text = b"".join(get(i, b"") for i in np.frombuffer(p, "<u4").tolist()).decode("utf-8", "replace")
            text = text.replace(MARK, " ")
            out.append(text[1:] if text.startswith(" ") else text)
        return out


def pieces(path: str) -> Pieces:
    """The process's vocabulary of a model file."""
    return per_process(f"pieces:{path}", lambda: Pieces(path))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) per row: ids packed as little-endian 32-bit integers."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                yield pa.RecordBatch.from_arrays(
                    [part["id"], pa.array(p.encode(part["text"].to_pylist()), pa.binary())], ["id", "ids"])

    return rows.mapInArrow(run, "id long, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` (id, ids) with the decoded ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                yield pa.RecordBatch.from_arrays(
                    [part["id"], part["ids"], pa.array(p.decode(part["ids"].to_pylist()), pa.string())],
                    ["id", "ids", "text"])

    return encoded.select("id", "ids").mapInArrow(run, "id long, ids binary, text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, decoded_sha256 of every whole text, encoded and decoded.

    Both directions run in one pass, so that a task has one Python worker and one vocabulary.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                ids = p.encode(part["text"].to_pylist())
                texts = p.decode(ids)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                     pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())],
                    ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string")
