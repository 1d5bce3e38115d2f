import hashlib
import math
import random
import re
from zlib import crc32

import numpy as np
import pytest

from eventide.llm import resample as rs

from llm_cases import TEXTS

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _features(text, ngrams, buckets):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, ngrams + 1) for i in range(len(w) - n + 1)]


def _brute(docs, target, percent, min_words, ngrams, buckets, seed):
    read = [(i, *_features(t, ngrams, buckets)) for i, t in docs]
    s = np.bincount(sum((f for *_, f in read), []), minlength=buckets)
    t = np.bincount(sum((_features(x, ngrams, buckets)[1] for x in target), []), minlength=buckets)
    gain = [math.floor(1000 * math.log((b + 1) * (int(s.sum()) + buckets) / ((a + 1) * (int(t.sum()) + buckets))))
            for a, b in zip(s.tolist(), t.tolist())]
    out = []
    for i, n, f in read:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((x for x in out if x[1] >= min_words), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    rank = {id(x): r for r, x in enumerate(able[:percent * len(able) // 100], 1)}
    return sorted(((x[0], *x[2:], rank.get(id(x))) for x in out), key=repr)


def _got(df):
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()), key=repr)


def _docs(n):
    rng = random.Random(n)
    common, odd = [f"w{i}" for i in range(30)], [f"x{i}" for i in range(500)]
    return [(i if i % 50 else -i, " ".join(rng.choice(odd if rng.random() < i % 7 / 10 else common) for _ in range(rng.choice([3, 19, 20, 21, 60]))))
            for i in range(1, n)]


@pytest.mark.parametrize(("percent", "min_words", "ngrams", "buckets"), [(10, 20, 1, 10_000), (50, 1, 2, 100), (100, 0, 3, 70_000)])
def test_draw_matches_brute_force(spark, edge, percent, min_words, ngrams, buckets):
    docs = TEXTS + _docs(400)
    target = [t for _, t in _docs(40)[::3]] + [None, ""]
    df = edge.select("doc_id", "text").unionByName(spark.createDataFrame(docs[len(TEXTS):], "doc_id long, text string"))
    more = spark.createDataFrame([(t, "b") for t in target], "text string, bucket string")
    assert _got(rs.draw(df, more, percent, min_words, ngrams, buckets, 7)) == _brute(docs, target, percent, min_words, ngrams, buckets, 7)


def test_nothing_to_draw(spark, edge, nothing):
    few = rs.draw(edge, edge, percent=10, min_words=20)
    assert few.count() == len(TEXTS) and few.where("rank IS NOT NULL").count() == 0
    assert rs.draw(nothing, edge).count() == 0
    assert rs.draw(edge, nothing, percent=100, min_words=1).where("rank IS NOT NULL").count() == len(
        [t for _, t in TEXTS if _features(t, 1, 10)[0]])


def test_wrong_brackets_are_widened_and_ranges_joined(spark):
    """The exact counts refuse a bracket that lies beside the cutoff; ties and repeated rows get one place each."""
    rng = random.Random(5)
    rows = [(rng.choice([0, 0, 0, 1, 5, rng.randrange(10**6)]), i // 3 if i % 5 else None, i) for i in range(3_000)]
    df = spark.createDataFrame(rows, "score long, id long, at long").repartition(5)
    order = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    for drawn in (1, 17, 1_499, 2_900, 3_000):
        for reach in (1e-9, 2e-4, 1.0):
            assert tuple(rs.last_drawn(df, 3_000, drawn, reach)) == order[drawn - 1]
    placed = rs.numbered(df, 3_000, range_rows=100)
    assert [tuple(r)[:3] for r in placed.select("score", "id", "at", "rank").orderBy("rank").collect()] == order
    assert [r["rank"] for r in placed.orderBy("rank").collect()] == list(range(1, 3_001))
