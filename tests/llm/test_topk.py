import random

import numpy as np

from eventide.llm import topk

INF, NAN = float("inf"), float("nan")


def _brute(rows, k):
    usable = [(i, np.floor(1024 * np.array(v, float)).astype(np.int64)) for i, v in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in usable if i % 100 == 0}):
        vq = min((tuple(v) for i, v in usable if i == q))
        scores = []
        for i, v in usable:
            if i != q:
                n = min(len(v), len(vq))
                scores.append((-int(v[:n] @ np.array(vq[:n], np.int64)), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return out


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in rows],
                                 "vec_id long, embedding array<float>, rank int, query_id string").repartition(3)


def _got(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_matches_brute_force_with_ties_and_bad_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25, rng.uniform(-1, 1)]) for _ in range(8)]) for i in range(260)]
    rows += [(300, [0.5] * 8), (301, [0.5] * 8), (302, [0.5] * 8), (301, [0.5] * 8), (400, None), (500, [None] * 8),
             (600, [INF] + [0.0] * 7), (700, [NAN] * 8), (None, [1.0] * 8), (800, [1.0, 2.0]), (801, []), (900, [0.0] * 8)]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    df = _frame(spark, rows)
    asked = df.where("vec_id % 100 = 0")
    want = _brute(rows, 10)
    assert _got(topk.search(df, asked, 10)) == want
    assert _got(topk.search(df, asked, 10, shard=37, group=2)) == want


def test_few_and_no_candidates(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5])]
    df = _frame(spark, rows)
    assert _got(topk.search(df, df.where("vec_id = 0"), 10)) == [(0, 1, 1, 1024 * 512 + 2048 * 512)]
    assert topk.search(df.limit(0), df.limit(0), 10).count() == 0


def test_accumulation_is_sparse():
    at, row, weight = topk.postings([np.array([0, 3, 0]), np.array([5]), np.array([], np.int64)])
    assert at.tolist() == [0, 1, 2, 2] and row.tolist() == [1, 0] and weight.tolist() == [5, 3]
