"""Licence scans by a positional index of rare words (SQL functions only).

Words are maximal runs of ``[0-9a-z]`` and non-ASCII characters of the text
with A-Z lower-cased.  The document frequency of every licence word is counted
over all documents; each notice's anchor is the word of highest IDF in its key
phrase.  A document is looked up by the anchors it holds: a word at position p
that is an anchor posted at position t of a notice makes p - t a candidate
start.  The
notice's postings are intersected with the document's words by relative
position, which gives the share of the notice's IDF that is matched; a label
holds if the notice's mandatory key phrase stands there in full.  Texts are
cut into words once; documents that lack a word of every key phrase keep only
their counts.  No step needs a shuffle but the counting of frequencies, which is
combined before it.

The three base phrases are notices that are mandatory as a whole, so each of
their places is found.  The score is the largest matched IDF share of any
notice whose key phrase stands, 0 without one.

Defined results
    null text           counts as empty: no words, no labels, score 0
    null identifier     kept
    repeated rows       each alone
    ties in IDF         the word that comes first in the notice is its anchor
    empty table         an empty result
    extra columns       ignored
    very long texts     scanned whole; nothing is collected across documents
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import text_or_empty, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Notice:
    """A licence notice: its label, its words, and the span of words that must stand."""

    label: str
    words: tuple[str, ...]
    start: int
    end: int
    base: bool = False

    @property
    def key(self) -> tuple[str, ...]:
        return self.words[self.start:self.end]


def notice(label: str, text: str, key: str | None = None, base: bool = False) -> Notice:
    words = tuple(text.split())
    phrase = tuple((key or text).split())
    at = next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)
    return Notice(label, words, at, at + len(phrase), base)


#: Notices: (label, notice, mandatory key phrase of it).
NOTICES = (
    *(notice(label, phrase, base=True) for phrase, label in BASE.items()),
    notice("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    notice("mit", "released under the mit license", "mit license"),
    notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted free of charge"),
    notice("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    notice("gpl-2.0", "under the terms of the gnu general public license version 2", "gnu general public license version 2"),
    notice("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    notice("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    notice("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    notice("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    notice("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    notice("cc0", "released into the public domain under cc0 1 0 universal", "cc0 1 0 universal"),
    notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
           "redistribution and use in source and binary forms"),
    notice("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    notice("unlicense", "this is free and unencumbered software released into the public domain",
           "free and unencumbered software"),
)


def lowered(text: str = "text") -> Column:
    """A-Z become a-z.  Lower-casing other letters changes no word's extent and no
    ASCII word, but for the Kelvin sign, which would become a k: it is masked."""
    return F.lower(F.replace(text_or_empty(text), F.lit("\u212a"), F.lit("\u00e5")))


def read_words(docs: DataFrame, notices: tuple[Notice, ...], id_col: str, text_col: str) -> DataFrame:
    """One pass over all whole texts, as a written table: doc_id, n_words, own (the licence
    words that it holds), and w (all its words) where some notice's whole key phrase is among them."""
    vocabulary = sorted({w for n in notices for w in n.words})
    keys = F.array(*[F.array(*[F.lit(w) for w in n.key]) for n in notices])
    low = docs.select(F.col(id_col).alias("doc_id"), lowered(text_col).alias("low"))
    words = low.select("doc_id", F.regexp_extract_all("low", F.lit(WORD), F.lit(0)).alias("all"))
    own = words.select("doc_id", "all", F.array_distinct(F.filter("all", lambda w: w.isin(vocabulary))).alias("own"))
    some = F.exists(keys, lambda k: F.size(F.array_except(k, F.col("own"))) == 0)
    return written(own.select("doc_id", F.size("all").alias("n_words"), "own", F.when(some, F.col("all")).alias("w")),
                   "licence-words")


def document_frequencies(words: DataFrame) -> tuple[int, dict[str, int]]:
    """(documents, documents that hold each licence word), over all documents."""
    # One row per licence word, combined before the shuffle; the null row counts the documents.
    counts = (words.select(F.explode(F.concat(F.array(F.lit(None).cast("string")), "own")).alias("w")).groupBy("w")
              .agg(F.count(F.lit(1)).alias("n")).collect())
    seen = {r["w"]: r["n"] for r in counts}
    return seen.pop(None, 0), seen


def scan(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows = read_words(docs, notices, id_col, text_col)
    n_docs, seen = document_frequencies(rows)
    idf = {w: math.log((n_docs + 1) / (seen.get(w, 0) + 1)) + 1.0 for n in notices for w in n.words}
    postings = _postings(notices, idf)
    rare = sorted({n.words[_anchor(n, idf)] for n in notices})

    # First level: where each anchor word stands.
    rows = rows.withColumn("hits", F.filter(F.transform("w", lambda x, i: F.struct(x.alias("w"), i.alias("p"))),
                                            lambda h: h["w"].isin(rare)))

    def placed(n: Column) -> Column:
        """The notice's places: candidate starts whose key phrase stands, with the share of IDF matched."""
        starts = F.transform(F.filter("hits", lambda h: h["w"] == n["anchor"]), lambda h: h["p"] - n["at"])
        # The key phrase stands at start + key_at; the rest of the notice may run over either end.
        stands = F.filter(starts, lambda s: (s + n["key_at"] >= 0)
                          & (F.slice("w", F.greatest(s + n["key_at"], F.lit(0)) + 1, F.size(n["key"])) == n["key"]))

        def share(s: Column) -> Column:
            got = F.transform(n["words"], lambda x, i: F.when(F.get("w", s + i) == x, F.get(n["idf"], i)).otherwise(0.0))
            return F.aggregate(got, F.lit(0.0), lambda a, b: a + b) / n["whole"]

        return F.transform(stands, lambda s: F.struct(n["label"].alias("label"), n["base"].alias("base"),
                                                      s.alias("start"), share(s).alias("share")))

    rows = rows.select("doc_id", "n_words", "w", F.flatten(F.transform(postings, placed)).alias("found"))
    base = F.filter("found", lambda f: f["base"])
    labels = lambda of: F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda f: f["label"]))), ",")
    starts = F.transform(base, lambda f: f["start"])
    known = F.col("w").isNotNull()
    top = F.coalesce(F.array_max(F.transform("found", lambda f: f["share"])), F.lit(0.0))
    return rows.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        F.when(known, F.size(base)).otherwise(0).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.when(known, labels(base)).otherwise("").alias("base_labels"),
        F.when(known, labels("found")).otherwise("").alias("labels"),
        F.when(known, F.least(top, F.lit(1.0))).otherwise(0.0).alias("score"))


def _anchor(n: Notice, idf: dict[str, float]) -> int:
    """The rarest word of the key phrase: where the phrase stands, its anchor is."""
    return max(range(n.start, n.end), key=lambda i: (idf[n.words[i]], -i))


def _postings(notices: tuple[Notice, ...], idf: dict[str, float]) -> Column:
    """The notices as one literal array: a fixed table, as small as the list above."""
    strings = lambda ws: F.array(*[F.lit(w) for w in ws])

    def entry(n: Notice) -> Column:
        at = _anchor(n, idf)
        return F.struct(F.lit(n.label).alias("label"), F.lit(n.base).alias("base"), F.lit(n.words[at]).alias("anchor"),
                        F.lit(at).alias("at"), strings(n.words).alias("words"),
                        F.array(*[F.lit(idf[w]) for w in n.words]).alias("idf"),
                        F.lit(sum(idf[w] for w in n.words)).alias("whole"), strings(n.key).alias("key"),
                        F.lit(n.start).alias("key_at"))

    return F.array(*[entry(n) for n in notices])
