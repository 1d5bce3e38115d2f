"""Importance resampling towards a target distribution, without replacement.

1. A text's features, all runs of 1 to ``ngrams`` consecutive words, are
   hashed into buckets; each document is written once as a packed array of
   bucket numbers, and the corpus's and the target's bucket counts are one
   combined aggregate each.
2. A bucket's gain is its smoothed log ratio of target to corpus; a document's
   weight is the sum of the gains its array points at.
3. Gumbel noise from a hash of the identifier is added, so the highest scores
   are a draw without replacement in proportion to the weights.
4. The draw's last row is located without sorting all rows: a quantile sketch
   proposes a bracket of scores, exact counts outside it validate it or have
   it widened, and the rows of the bracket alone are sorted.
5. Drawn rows are numbered: ranges sorted side by side, each offset by the
   number of rows in the ranges before it.

Gains and counts are one number a bucket, all that reaches the driver or is
broadcast; they do not grow with the corpus.

Defined results
    null text            no features: weight 0; too short to be drawn
    null identifier      the noise of the empty string; after all others among ties
    repeated rows        each alone, with the same score; one may be drawn without the other
    ties                 smaller identifier first, repeated rows in any order
    empty table          an empty result; an empty target draws by smoothed counts alone
    extra columns        ignored
    very long texts      read whole; their array is held by one task at a time
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import shards, written
from eventide.llm.words import PerWord, words_of

#: Rank error of the quantile sketch is 1 / SKETCH of the rows.
SKETCH = 10_000
#: Rows per range where rows are numbered.
RANGE_ROWS = 500_000


def packed(docs: DataFrame, ngrams: int, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, n_features, features): the bucket numbers of every feature (a written table)."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = PerWord(lambda w: (crc32(w) % buckets).to_bytes(int(width[2]), "little"), width)
        for batch in batches:
            n_words, features = [], []
            for text in batch["body"]:
                words = words_of(text.as_py())
                n_words.append(len(words))
                parts = [one.of(words).tobytes()]
                for n in range(2, ngrams + 1):
                    runs = (b" ".join(words[i:i + n]) for i in range(len(words) - n + 1))
                    parts.append(np.array([crc32(r) % buckets for r in runs], width).tobytes())
                features.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(n_words, pa.int64()), pa.array([len(f) // int(width[2]) for f in features], pa.int64()),
                 pa.array(features, pa.binary())], ["id", "n_words", "n_features", "features"])

    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("body"))
    return written(read.mapInArrow(run, "id long, n_words long, n_features long, features binary"), "resample-features")


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket is hit: one number a bucket and task, summed."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for f in batch["features"]:
                total += np.bincount(np.frombuffer(f.as_py(), width), minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["bucket", "n"])

    sums = features.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got, out = sums.toArrow(), np.zeros(buckets, np.int64)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed ratio of target to corpus frequency, per bucket."""
    buckets, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = lambda s, t: ((t + 1.0) * (s_all + float(buckets))) / ((s + 1.0) * (t_all + float(buckets)))
    return np.array([math.floor(1000.0 * math.log(ratio(s, t))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(id_col: str, seed: int) -> Column:
    """floor(1000 x Gumbel) of an identifier, from 32 bits of its salted digest."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def scored(docs: DataFrame, target: DataFrame, ngrams: int, buckets: int, seed: int, id_col: str, text_col: str,
           target_col: str) -> DataFrame:
    """(id, n_words, n_features, weight, score, at) of every document; ``at`` is unique (a written table)."""
    width = "<u2" if buckets <= 1 << 16 else "<u4"
    corpus = packed(docs, ngrams, buckets, id_col, text_col)
    wanted = packed(target.select(F.lit(None).alias("id"), F.col(target_col).alias("text")), ngrams, buckets, "id", "text")
    table = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts(corpus, buckets), bucket_counts(wanted, buckets)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = table.value
        for batch in batches:
            weight = [int(gain[np.frombuffer(f.as_py(), width)].sum()) for f in batch["features"]]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["n_words"], batch["n_features"], pa.array(weight, pa.int64())],
                                             ["id", "n_words", "n_features", "weight"])

    rows = corpus.mapInArrow(run, "id long, n_words long, n_features long, weight long")
    rows = rows.withColumn("score", F.col("weight") + noise("id", seed))
    return written(rows.withColumn("at", F.monotonically_increasing_id()), "resample-scores")


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("at").asc()]


def numbered(rows: DataFrame, count: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with ``rank`` (from 1, in order): sorted ranges, each offset by the rows before it."""
    spark, order = rows.sparkSession, _order()
    ranges = rows.repartitionByRange(shards(count, range_rows), *order).sortWithinPartitions(*order)
    # The upper bits number the range, the lower 33 the row in it.
    out = written(ranges.withColumn("place", F.monotonically_increasing_id()), "resample-ranges")
    part = F.shiftright("place", 33).alias("part")
    sizes = sorted(out.groupBy(part).count().collect())
    before = np.cumsum([0, *(r["count"] for r in sizes)]).tolist()
    offsets = spark.createDataFrame([(r["part"], b) for r, b in zip(sizes, before)], "part long, before long")
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    return out.withColumn("part", part).join(offsets, "part").withColumn("rank", rank).drop("part", "place", "before")


def last_drawn(rows: DataFrame, count: int, drawn: int, reach: float = 2 / SKETCH):
    """The ``drawn``-th of ``count`` rows in order: its (score, id, at)."""
    share = 1.0 - drawn / count
    while True:
        if reach < 1:
            low, high = rows.agg(F.percentile_approx("score", [max(0.0, share - reach), min(1.0, share + reach)], SKETCH)).first()[0]
        else:
            low, high = rows.agg(F.min("score"), F.max("score")).first()
        inside = F.col("score").between(low, high)
        above, within = rows.agg(F.count_if(F.col("score") > high), F.count_if(inside)).first()
        if above < drawn <= above + within:
            break
        reach *= 8  # the exact counts do not bear the bracket out
    bracket = numbered(rows.where(inside), within)
    return bracket.where(F.col("rank") == drawn - above).select("score", "id", "at").first()


def draw(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, ngrams: int = 1,
         buckets: int = 10_000, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
         target_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null if it is not drawn)."""
    rows = scored(docs, target, ngrams, buckets, seed, id_col, text_col, target_col)
    long_enough = rows.where(F.col("n_words") >= min_words).select("score", "id", "at")
    count = long_enough.count()
    drawn = percent * count // 100
    columns = [F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank"]
    if not drawn:
        return rows.withColumn("rank", F.lit(None).cast("long")).select(*columns)
    last = last_drawn(long_enough, count, drawn)
    # In order, nulls come last among equal scores.
    sooner = F.lit(last["id"] is None) & F.col("id").isNotNull() if last["id"] is None else F.col("id") < last["id"]
    level = F.col("id").eqNullSafe(F.lit(last["id"]).cast("long")) & (F.col("at") <= last["at"])
    taken = (F.col("n_words") >= min_words) & (
        (F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & F.coalesce(sooner | level, F.lit(False))))
    ranks = numbered(rows.where(taken), drawn)
    rest = rows.where(~taken).withColumn("rank", F.lit(None).cast("long"))
    return ranks.select(*columns).unionByName(rest.select(*columns))
