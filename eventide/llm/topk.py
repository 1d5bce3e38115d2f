"""Exact top-k search by exhaustive term-at-a-time accumulation.

A dimension is a term; its posting list within a block of candidates holds
(candidate, weight) for the non-zero weights.  The query rows are sparse: for
each term, the queries that hold it scatter query weight times posting weights
into a dense score array (queries x candidates of the block).  Each block then
selects its k best per query, and a merge ranks the blocks' survivors.

Blocks: candidates are dealt by hash into shards of about ``SHARD`` rows and
queries into groups of about ``GROUP``; one task step scores one (group,
shard) pair, so its memory is bounded by SHARD x GROUP scores whatever the
table's size.

Scores are exact: components become floor(scale * x) as 64-bit integers, and
products and sums are integers too (they wrap beyond 64 bits; components
beyond the 64-bit range count as the nearest integer in it).

Defined results
    null vector, null or non-finite component   the row takes no part
    null identifier                             the row takes no part
    empty vector                                scores 0 against everything
    vectors of unequal length                   missing components count as 0
    ties                                        smaller vec_id first
    repeated rows                               each counts as a candidate; a repeated query is asked once,
                                                with its smallest vector; no row with the query's id is a candidate
    fewer than k candidates                     all of them
    empty table                                 an empty result
    extra columns                               ignored
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import shards, written

#: Candidates per shard and queries per group.
SHARD = 2_048
GROUP = 512
SCALE = 1024.0

_OUT = "query_id long, vec_id long, score long"


def _usable(vector: Column) -> Column:
    # A non-finite component makes the whole row unusable, as a null one does.
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def postings(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets per term, row of each posting, weight of each posting)."""
    width = max(map(len, rows), default=0)
    dense = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        dense[i, :len(r)] = r
    term, row = np.nonzero(dense.T)
    return np.searchsorted(term, np.arange(width + 1)), row, dense.T[term, row]


def accumulate(queries: list[np.ndarray], candidates: list[np.ndarray]) -> np.ndarray:
    """Dense scores (queries x candidates), one term after the other."""
    q_at, q_row, q_weight = postings(queries)
    c_at, c_row, c_weight = postings(candidates)
    scores = np.zeros((len(queries), len(candidates)), np.int64)
    for t in range(min(len(q_at), len(c_at)) - 1):
        q, c = slice(q_at[t], q_at[t + 1]), slice(c_at[t], c_at[t + 1])
        rows, cols = q_row[q], c_row[c]
        if len(rows) and len(cols):
            add = q_weight[q][:, None] * c_weight[c][None, :]
            if len(rows) == len(queries) and len(cols) == len(candidates):
                scores += add
            else:
                scores[np.ix_(rows, cols)] += add
    return scores


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, ties to the smaller id, unordered ties included exactly."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > cut)
        level = np.flatnonzero(scores == cut)
        level = level[np.argsort(ids[level], kind="stable")][:k - len(above)]
        return np.concatenate([above, level])
    return np.arange(len(scores))


def search(rows: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: float = SCALE, shard: int = SHARD, group: int = GROUP) -> DataFrame:
    """The k best rows for each query: query_id, rank, vec_id, score."""

    def sparse(df: DataFrame) -> DataFrame:
        vector = F.col(vector_col).cast("array<double>")
        return (df.select(F.col(id_col).cast("long").alias("id"), vector.alias("x"))
                .where(F.col("id").isNotNull() & _usable(F.col("x")))
                .select("id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("x")))

    candidates = sparse(rows)
    asked = written(sparse(queries).groupBy("id").agg(F.min("x").alias("x")), "topk-queries")
    n_shards, n_groups = shards(candidates.count(), shard), shards(asked.count(), group)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    hashed = F.xxhash64("id", "x")
    left = asked.select("id", "x", F.pmod(hashed, F.lit(n_groups)).cast("int").alias("g"), each(n_shards).alias("s"))
    right = candidates.select("id", "x", F.pmod(hashed, F.lit(n_shards)).cast("int").alias("s"),
                              each(n_groups).alias("g"))

    def score(q: pa.Table, c: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                          "score": pa.array([], pa.int64())})
        if not (q.num_rows and c.num_rows):
            return empty
        ids = c["id"].to_numpy()
        unpack = lambda t: [np.asarray(v.values, np.int64) for v in t["x"]]
        vectors = unpack(c)
        out = []
        own, asked_rows = q["id"].to_numpy(), unpack(q)
        for at in range(0, len(own), 64):
            scores = accumulate(asked_rows[at:at + 64], vectors)
            for query, line in zip(own[at:at + 64], scores):
                others = np.flatnonzero(ids != query)
                pick = others[best(line[others], ids[others], k)]
                out.append(pa.table({"query_id": pa.array(np.full(len(pick), query)), "vec_id": pa.array(ids[pick]),
                                     "score": pa.array(line[pick])}))
        return pa.concat_tables(out) if out else empty

    survivors = left.groupBy("g", "s").cogroup(right.groupBy("g", "s")).applyInArrow(score, _OUT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (survivors.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
