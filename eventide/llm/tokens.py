"""Whole-text encoding with a ``tokenizers`` file, by cached words.

Byte-pair merges never cross a pre-token, and no pre-token of the two public
byte-level vocabularies reaches over a single space.  So a text is cut at its
spaces, the ids of each distinct piece are found once and kept as packed
little-endian integers, and a text's ids are its joined pieces.  A new piece
of plain characters is cut into pre-tokens by the file's own pattern, each of
which the library's model merges.  Whatever lies outside that (a space beside
another white-space character, the text of a special token, characters whose
normal form or class could differ between Unicode versions) is encoded whole
by the library.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np

from eventide.llm.common import per_process

#: Pieces kept per worker process: the first ones seen hold the common words.
CACHE_PIECES = 250_000
#: Latin letters, digits and signs: one code point each in every normal form.
PLAIN = re.compile("[ !-~\u00a1-\u012f\u0131-\u017e]*")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others, in order, for the code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """ids of whole texts as packed ``dtype`` integers (little-endian)."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        size = max([self.tokenizer.get_vocab_size(True), *added])
        self.dtype = np.dtype("<u2" if size < 65_536 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.limit = cache_pieces
        self.pieces: dict[str, bytes] = {}
        self.merged: dict[str, bytes] = {}
        self.whole = re.compile("|".join([r" \s", r"\s ", r"\s\s\s", r"\s\s\Z", *(re.escape(t.content) for t in added.values())]))
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        own = [s["pattern"]["Regex"] for s in spec["pre_tokenizer"].get("pretokenizers", []) if s["type"] == "Split"]
        # Either the file states its pattern and drops white space, or it is the usual byte-level one.
        self.keeps_space = not own
        self.cut = regex.compile(own[0] if own else BYTE_LEVEL_PATTERN).findall
        self.lower = spec.get("normalizer") is not None
        self.letters = byte_letters()

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _simple(self, text: str) -> bool:
        """No white space but single blanks and line feeds, nothing special."""
        if text.replace("\n", "").isprintable() and not any(x in text for x in ("  ", " \n", "\n ", "\n\n", "<|")):
            return True
        return not self.whole.search(text)

    def encode(self, texts: list[str | None], end: int | None = None) -> list[bytes]:
        """Packed ids of each text (null: empty), with ``end`` appended."""
        tail = b"" if end is None else np.array([end], self.dtype).tobytes()
        get, out = self.pieces.get, []
        for text in texts:
            if not text:
                out.append(tail)
            elif self._simple(text):
                pieces = self._split(text)
                ids = list(map(get, pieces))
                if None in ids:
                    ids = [self._piece(p) if x is None else x for p, x in zip(pieces, ids)]
                out.append(b"".join(ids) + tail)
            else:
                out.append(self._library(text) + tail)
        return out

    def _split(self, text: str) -> list[str]:
        if not self.keeps_space:
            return text.replace("\n", " ").split(" ")
        if "\0" in text:
            return [text]
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")

    def _piece(self, piece: str) -> bytes:
        if self.keeps_space and piece.isascii() and piece.removeprefix(" ").isalpha():
            return self._word(piece)
        if PLAIN.fullmatch(piece):
            ids = b"".join(map(self._merge, self.cut(piece.lower() if self.lower else piece)))
        else:
            ids = self._library(piece)
        if len(self.pieces) < self.limit:
            self.pieces[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """ids of a piece that is one pre-token: kept once, among the pieces or, where they are full, the words."""
        ids = self.merged.get(word)
        if ids is None:
            ids = self._model(word)
            for kept in (self.pieces, self.merged):
                if len(kept) < self.limit:
                    kept[word] = ids
                    break
        return ids

    def _merge(self, word: str) -> bytes:
        ids = self.merged.get(word)
        if ids is None and self.keeps_space and word.isascii() and word.removeprefix(" ").isalpha():
            ids = self.pieces.get(word)
        if ids is None:
            ids = self._model(word)
            if len(self.merged) < self.limit:
                self.merged[word] = ids
        return ids

    def _model(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()


#: Fixed value: the pattern of byte-level pre-tokens.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(path: str) -> WordEncoder:
    """The process's encoder for a vocabulary file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return per_process(f"encoder:{path}", lambda: WordEncoder(path))
