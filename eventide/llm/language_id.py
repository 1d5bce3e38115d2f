"""Language identification: averaged hashed subword embeddings and a linear softmax.

A word, with boundary marks, is a bag of character n-grams; each n-gram is
hashed to a row of an embedding matrix.  A text is the average over its words
of its words' averaged n-gram rows; a linear layer with a softmax on top gives
language probabilities.  Embeddings and layer are trained together by
mini-batch stochastic gradient descent in numpy.

Fitting uses a bounded sample: per language the ``per_language`` labelled
documents that hash lowest, for each value of the language column; of a longer text
its first ``MOST_CHARS`` characters; of all languages together
``MOST_DOCUMENTS`` documents and ``MOST_TOTAL`` characters at most.  A third of the sample, never trained
on, sets the softmax temperature (calibration) and the rejection threshold.  That is one on
familiarity, the mean log frequency of a text's n-grams in the learned texts:
it is low in a language never learned and in letter noise, where the softmax
score may still be high, and not low in a clean text that two learned languages
share, where the score is.  The threshold of a language lies halfway between
the calibration documents that the model gives that language and the same
documents with their letters shuffled, or at a low quantile of those documents
if that is lower.  A short text must fall below it by more: by
``SPREADS`` standard errors of its different words.  Prediction
reads every whole text in one pass without a shuffle; the language, source and
identifier columns are no inputs of it.

Defined results
    null text or no letter in it    ``und`` with score 0, rejected
    null language                   never learned from
    null identifier                 not held out, never learned from
    repeated rows, ties             each row is predicted alone; equal scores go to the first language by name
    empty table                     an empty result
    no labelled row at all          every text is ``und``
    extra columns                   ignored by ``predict``; ``identify`` keeps them
    very long texts                 read whole, word by word
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import per_process, written

#: Labelled documents fitted on, per language (the bound of the sample).
PER_LANGUAGE = 400
#: Characters of a text that are fitted on, which bounds the sample's bytes; texts are predicted whole.
MOST_CHARS = 200_000
#: Documents of all languages together, and their characters: with many languages each has a smaller share.
#: Of more distinct values than that, those of most documents are learned, one document each.
MOST_DOCUMENTS, MOST_TOTAL = 20_000, 320_000_000
#: Share of the calibration documents that the threshold may reject, standard errors that a text must
#: lie below it, and words of a calibration document that are shuffled.
REJECT_SHARE, SPREADS, SHUFFLED = 0.005, 4.0, 200
#: Frequency that a gram never seen counts as, and documents of a language from which its own threshold is taken.
UNSEEN, OWN_LEAST = 1e-5, 20
#: Rows of the embedding matrix, their width, and the n-gram lengths.
BUCKETS, WIDTH, GRAMS = 1 << 15, 16, (1, 2, 3)
#: Passes (at least), steps (at least, so that a small sample is learned, too),
#: documents per step and step size of the descent.
EPOCHS, STEPS, BATCH, RATE, SEED = 12, 1_200, 16, 0.5, 7
#: Word vectors kept per worker process: the first ones seen hold the common words.
CACHE_WORDS = 120_000
#: Characters of a word from which its grams are found alone, and words whose grams are found at once.
LONG_WORD, AT_ONCE = 40, 1_000
#: Words of texts that are averaged together (one text at least).
HELD_WORDS = 20_000


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """Lower-cased runs of word characters that hold a letter; digits and signs separate words."""
    # The pattern lets numbers such as a superscript two pass: alone, they are no word.
    return [w for w in _LETTERS.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))]


def grams(word: str) -> list[int]:
    """Bucket of each character n-gram of the marked word."""
    marked = f"<{word}>"
    return [zlib.crc32(marked[i:i + n].encode()) % BUCKETS for n in GRAMS for i in range(len(marked) - n + 1)]


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def _crc_on(state: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """CRC-32 registers after one more character each (a code point, as its UTF-8 bytes)."""
    size = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
    out = np.empty_like(state)
    for n, lead in ((1, 0), (2, 0xC0), (3, 0xE0), (4, 0xF0)):
        at = np.flatnonzero(size == n)
        s = state[at]
        for k in range(n - 1, -1, -1):
            byte = chars[at] >> (6 * k)
            byte = byte | lead if k == n - 1 else byte & 0x3F | 0x80
            s = _CRC[(s ^ byte) & 0xFF] ^ (s >> 8)
        out[at] = s
    return out


def grams_of(own: list[str]) -> np.ndarray:
    """``grams`` of many words at once: a row each, filled up with ``BUCKETS``."""
    chars = np.frombuffer("".join([f"<{w}>" for w in own]).encode("utf-32-le"), "<u4")
    size = np.array([len(w) + 2 for w in own])
    start = np.cumsum(size) - size
    at = np.arange(len(chars)) - np.repeat(start, size)  # place in the word
    left = np.repeat(size, size) - at  # characters from there on
    row = np.repeat(np.arange(len(own)), size)
    out = np.full((len(own), sum(int(size.max()) - n + 1 for n in GRAMS)), BUCKETS, np.int64)
    state, before = np.full(len(chars), 0xFFFFFFFF, np.uint32), np.zeros(len(own), np.int64)
    for n in range(1, max(GRAMS) + 1):
        fits = np.flatnonzero(left >= n)
        state[fits] = _crc_on(state[fits], chars[fits + n - 1])
        if n in GRAMS:
            out[row[fits], before[row[fits]] + at[fits]] = ~state[fits] % np.uint32(BUCKETS)
            before += np.maximum(size - n + 1, 0)
    return out


class WordVectors:
    """Averaged gram vectors of words; those seen first are kept."""

    def __init__(self, vectors: np.ndarray, most: int = CACHE_WORDS):
        self.vectors, self.most = vectors, most
        self.padded = np.concatenate([vectors, np.zeros_like(vectors[:1])])
        self.row: dict[str, int] = {}
        self.kept = np.zeros((1024, vectors.shape[1]), np.float32)

    def of(self, own: list[str]) -> np.ndarray:
        """The vectors of words; long ones are made one by one, so that a row of places stays short."""
        out = np.empty((len(own), self.vectors.shape[1]), np.float32)
        short = [i for i, w in enumerate(own) if len(w) <= LONG_WORD]
        for i in range(0, len(short), AT_ONCE):
            at = short[i:i + AT_ONCE]
            g = grams_of([own[j] for j in at])
            out[at] = self.padded[g].sum(axis=1) / (g < BUCKETS).sum(axis=1)[:, None].astype(np.float32)
        for i, w in enumerate(own):
            if len(w) > LONG_WORD:
                out[i] = self.vectors[grams(w)].mean(axis=0)
        return out

    def average(self, own: list[str]) -> np.ndarray:
        """Mean of the words' vectors."""
        return self.averages([own])[0]

    def averages(self, texts: list[list[str]]) -> np.ndarray:
        """Mean of the words' vectors of each text (of one word at least)."""
        ends = np.cumsum([0, *map(len, texts)]).tolist()
        own = list(chain.from_iterable(texts))
        rows = np.fromiter(map(self.row.get, own, repeat(-1)), np.int64, len(own))
        missing = np.flatnonzero(rows < 0)
        wanted = [own[i] for i in missing.tolist()]
        new = {w: k for k, w in enumerate(dict.fromkeys(wanted))}
        vectors = self.of(list(new))
        room = list(new)[:max(0, self.most - len(self.row))]
        first = len(self.row)
        while first + len(room) > len(self.kept):
            self.kept = np.concatenate([self.kept, np.zeros_like(self.kept)])
        self.kept[first:first + len(room)] = vectors[:len(room)]
        self.row.update(zip(room, range(first, first + len(room))))
        which = np.fromiter(map(new.get, wanted), np.int64, len(wanted))
        held = which < len(room)
        rows[missing[held]] = first + which[held]
        rows[missing[~held]] = -1 - which[~held]  # of those that found no room
        out = np.empty((len(texts), vectors.shape[1]), np.float32)
        for i, (lo, hi) in enumerate(zip(ends, ends[1:])):
            r = rows[lo:hi]
            total = self.kept[r[r >= 0]].sum(axis=0)
            if len(room) < len(new):
                total = vectors[-1 - r[r < 0]].sum(axis=0) + total
            out[i] = total / (hi - lo)
        return out


def different(own: list[str]) -> float:
    """Effective number of different words: repeated ones are no more evidence."""
    n = np.array(list(Counter(own).values()), float)
    return float(n.sum() ** 2 / (n ** 2).sum())


class Familiarity:
    """Threshold of each language, and the variance between a clean text's words."""

    def __init__(self, clean: np.ndarray, noise: np.ndarray, top: np.ndarray, within: float, langs: int):
        def least(x: np.ndarray, y: np.ndarray) -> float:
            return min(float(np.median(x) + np.median(y)) / 2, float(np.quantile(x, REJECT_SHARE)))

        own = [top == k for k in range(langs)]
        self.least = np.array([least(clean[x], noise[x]) if x.sum() >= OWN_LEAST else least(clean, noise) for x in own])
        self.within = within

    def strange(self, mean: np.ndarray, top: np.ndarray, words_: np.ndarray) -> np.ndarray:
        return mean + SPREADS * np.sqrt(self.within / words_) < self.least[top]


class Model:
    """Embeddings (with the grams' log frequency as a last column, if any), linear layer, temperature, clean texts' familiarity."""

    def __init__(self, langs: list[str], vectors: np.ndarray, layer: np.ndarray, temperature: float = 1.0,
                 familiar: Familiarity | None = None):
        self.langs, self.vectors, self.layer = langs, vectors, layer
        self.temperature, self.familiar = temperature, familiar
        self.key = zlib.crc32(vectors.tobytes())

    def state(self) -> tuple:
        """Plain values, which a broadcast carries to workers without this package."""
        known = self.familiar and (self.familiar.least, self.familiar.within)
        return self.langs, self.vectors, self.layer, self.temperature, known

    @classmethod
    def of(cls, state: tuple) -> Model:
        *own, known = state
        familiar = None
        if known:
            familiar = Familiarity.__new__(Familiarity)
            familiar.least, familiar.within = known
        return cls(*own, familiar)

    def probabilities(self, hidden: np.ndarray) -> np.ndarray:
        z = hidden[:, :len(self.layer)] @ self.layer / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, calibrated score, rejected) per text."""
        known = per_process(f"language words {self.key}", lambda: WordVectors(self.vectors))
        hidden = np.zeros((len(texts), self.vectors.shape[1]), np.float32)
        empty, count = [], np.ones(len(texts))
        held: dict[int, list[str]] = {}
        n = 0

        def flush() -> None:
            hidden[list(held)] = known.averages(list(held.values()))
            held.clear()

        for i, text in enumerate(texts):
            own = words(text) if text else []
            if own and self.langs:
                held[i] = own
                count[i] = len(own)
                n += len(own)
            else:
                empty.append(i)
            if n >= HELD_WORDS:
                flush()
                n = 0
        if held:
            flush()
        if not self.langs:
            return [("und", 0.0, True)] * len(texts)
        p = self.probabilities(hidden)
        top = p.argmax(axis=1)
        out = [(self.langs[t], float(x), False) for t, x in zip(top, p.max(axis=1))]
        if self.familiar:
            mean = hidden[:, -1]
            # Texts that pass with every word taken as evidence pass with fewer.
            for i in np.flatnonzero(self.familiar.strange(mean, top, count)).tolist():
                count[i] = different(words(texts[i] or "") or [""])
            for i in np.flatnonzero(self.familiar.strange(mean, top, count)).tolist():
                out[i] = (*out[i][:2], True)
        for i in empty:
            out[i] = ("und", 0.0, True)
        return out


def _bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: gram buckets and their weights (which sum to 1)."""
    out = []
    for text in texts:
        weights: dict[int, float] = {}
        counts = Counter(words(text))
        total = sum(counts.values())
        for w, n in counts.items():
            own = grams(w)
            for g in own:
                weights[g] = weights.get(g, 0.0) + n / total / len(own)
        out.append((np.fromiter(weights.keys(), np.int64, len(weights)),
                    np.fromiter(weights.values(), np.float32, len(weights))))
    return out


def log_frequency(bags: list[tuple[np.ndarray, np.ndarray]], wanted: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Per bucket: log of its mean weight in the documents ``rows``, in the language where that is largest."""
    most = np.zeros(BUCKETS)
    for k in np.unique(wanted[rows]):
        own, mine = np.zeros(BUCKETS), rows[wanted[rows] == k]
        for i in mine:
            own[bags[i][0]] += bags[i][1]
        most = np.maximum(most, own / len(mine))
    return np.log(most + UNSEEN).astype(np.float32)


def _familiarity(model: Model, texts: list[str], top: np.ndarray, logs: list[np.ndarray]) -> Familiarity:
    """From calibration texts, their languages by ``model`` and the log frequencies that each is held against."""
    rng = np.random.default_rng(SEED)

    def moments(own: list[str], log: np.ndarray) -> tuple[float, float]:
        counts = Counter(own)
        n = np.array(list(counts.values()), float)
        x = np.array([log[grams(w)].mean() for w in counts])
        mean = (n * x).sum() / n.sum()
        return mean, (n * (x - mean) ** 2).sum() / n.sum()

    def shuffled(own: list[str]) -> list[str]:
        letters = "".join(rng.permutation(list("".join(own))))
        ends = np.cumsum([0, *map(len, own)]).tolist()
        return [letters[a:b] for a, b in zip(ends, ends[1:])]

    clean = np.array([moments(words(t), log) for t, log in zip(texts, logs)])
    noise = np.array([moments(shuffled(words(t)[:SHUFFLED]), log)[0] for t, log in zip(texts, logs)])
    return Familiarity(clean[:, 0], noise, top, float(np.median(clean[:, 1])), len(model.langs))


def fit(texts: list[str], labels: list[str]) -> Model:
    """Train on two thirds of the given documents, calibrate on the rest."""
    langs = sorted(set(labels))
    rng = np.random.default_rng(SEED)
    vectors = (rng.random((BUCKETS, WIDTH), np.float32) - 0.5) / WIDTH
    layer = np.zeros((WIDTH, len(langs)), np.float32)
    bags = _bags(texts)
    wanted = np.array([langs.index(x) for x in labels], np.int64)
    order = rng.permutation(len(bags))
    learn, check = (order[len(order) // 3:], order[:len(order) // 3]) if len(order) >= 30 else (order, order)

    def hidden(rows: np.ndarray) -> np.ndarray:
        return np.array([bags[i][1] @ vectors[bags[i][0]] for i in rows], np.float32)

    each = max(1, -(-len(learn) // BATCH))
    epochs = max(EPOCHS, -(-STEPS // each))
    steps, done = epochs * each, 0
    for _ in range(epochs):
        rng.shuffle(learn)
        for at in range(0, len(learn), BATCH):
            rows = learn[at:at + BATCH]
            rate = RATE * (1 - done / steps)
            done += 1
            h = hidden(rows)
            z = h @ layer
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), wanted[rows]] -= 1
            back = p @ layer.T
            layer -= rate * h.T @ p
            for i, b in zip(rows, back):
                vectors[bags[i][0]] -= rate * bags[i][1][:, None] * b[None, :]  # a bag's buckets are distinct
    model = Model(langs, vectors, layer)
    if len(check):
        z, own = hidden(check) @ layer, wanted[check]

        def loss(t: float) -> float:
            e = z / t
            e = e - e.max(axis=1, keepdims=True)
            return float(np.mean(np.log(np.exp(e).sum(axis=1)) - e[np.arange(len(own)), own]))

        model.temperature = min((2.0 ** (k / 4) for k in range(-12, 17)), key=loss)
        top = model.probabilities(hidden(check)).argmax(axis=1)
        # What a text is held against must not hold the text itself: a small sample's halves serve each other.
        halves = [learn, learn] if learn is not check else [order[::2], order[1::2]]
        if all(map(len, halves)):
            logs = [log_frequency(bags, wanted, h) for h in halves[::-1]]
            inside = set(halves[0].tolist())
            against = [logs[0 if i in inside else 1] for i in check.tolist()]
            seen = np.concatenate([vectors, log_frequency(bags, wanted, learn)[:, None]], axis=1)
            known = _familiarity(model, [texts[i] for i in check], top, against)
            model = Model(langs, seen, layer, model.temperature, known)
    return model


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    id_, lang, text = F.col(id_col), F.col(lang_col).cast("string"), F.col(text_col).cast("string")
    usable = docs.where(id_.isNotNull() & ~held_out(id_col) & text.isNotNull() & lang.isNotNull())
    counts = (usable.groupBy(lang.alias("lang")).agg(F.approx_count_distinct(id_).alias("n"))
              .orderBy(F.desc("n"), "lang").limit(MOST_DOCUMENTS).collect())
    if not counts:
        return Model([], np.zeros((1, WIDTH), np.float32), np.zeros((WIDTH, 1), np.float32))
    share = max(1, min(per_language, MOST_DOCUMENTS // len(counts)))
    # A hash below a language's cut is expected of more documents than its share, so that few rows
    # are ranked, whatever the table's size.
    cuts = [(r["lang"], min(2**63 - 1, -2**63 + (2 * share + 64) * 2**64 // max(1, r["n"]))) for r in counts]
    cuts = F.broadcast(docs.sparkSession.createDataFrame(cuts, "lang string, cut long"))  # MOST_DOCUMENTS rows at most
    near = usable.select(F.xxhash64(id_, text).alias("h"), lang.alias("lang"),
                         F.substring(text, 1, min(MOST_CHARS, MOST_TOTAL // (share * len(counts)))).alias("text"))
    near = written(near.join(cuts, "lang").where("h <= cut").dropDuplicates(["lang", "h"]).select("lang", "h", "text"),
                   "language-sample")
    order = Window.partitionBy("lang").orderBy("h")
    keys = near.select("lang", "h").withColumn("r", F.row_number().over(order)).where(F.col("r") <= share)
    sample = near.join(keys.select("lang", "h"), ["lang", "h"]).orderBy("h", "lang").select("lang", "text").collect()
    sample = [r for r in sample if words(r["text"])]
    return fit([r["text"] for r in sample], [r["lang"] for r in sample])


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` (existing columns of these names are replaced)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.state())  # a few MB at most: BUCKETS x WIDTH plus the layer

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(text: pd.Series) -> pd.DataFrame:
        found = Model.of(shared.value).predict([t if isinstance(t, str) else None for t in text])
        return pd.DataFrame(found, columns=["lang_pred", "score", "rejected"])

    added = ["lang_pred", "score", "rejected"]
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                      predict(docs[f"`{text_col}`"].cast("string")).alias("p"))
    return row.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in added], *[F.col(f"p.{c}") for c in added])


def predictions(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Train on the rows not held out, predict every row."""
    model = train(docs, id_col)
    out = identify(docs.select(F.col(id_col).alias("doc_id"), "text"), model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")
