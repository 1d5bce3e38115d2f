"""A corpus pipeline of the ``llm`` operators: each stage works on what the one before kept.

Stages take (spark, docs, sf_dir) and return the columns of ``documents``; the
last one returns the packed sequences' pieces.  A stage's result is written
as a table before the next one reads it, and goes when the next one's is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import exact_dedup, jaccard_join, language_id, packing, suffix_dedup
from eventide.llm.common import removed, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCABULARY, END_ID, CAPACITY = "word_bpe_49k.json", 2, 4_096
#: Near duplicates: words per shingle and least similarity in hundredths.
SHINGLE_WORDS, SIMILARITY = 5, 80
#: Bytes of a string that may stand only once: no passage of over 50 words is shorter (51 letters, 50
#: blanks).  The anchor's bytes follow from it (a window holds two at least).  op9's length is its own.
REPEAT_BYTES, REPEAT_GRAM = 101, 32


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the identifier accepts."""
    model = language_id.train(docs)
    return language_id.identify(docs, model).where("NOT rejected").select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of the documents with equal text."""
    return exact_dedup.deduplicate(docs).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.deduplicate(docs, SHINGLE_WORDS, SIMILARITY, 100).select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings that stand elsewhere, too, every passage of over 50 words
    among them; ``n_chars`` follows the text."""
    out = suffix_dedup.deduplicate(docs, REPEAT_BYTES, gram=REPEAT_GRAM)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast("long"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of ``CAPACITY`` tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(VOCABULARY), END_ID, CAPACITY).drop("ids", "width")


STAGES = [("language", language), ("exact dedup", exact), ("near dedup", near), ("repeated strings", repeats),
          ("packing", pack)]

#: No stage but the second can be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, made = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        removed(*made)
        made = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
