import collections
import random

import numpy as np
import pytest

from eventide.llm import jaccard_join as jj
from eventide.llm.components import connected

from llm_cases import TEXTS


def _brute(texts, width, num, den):
    sets = []
    for _, t in texts:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = collections.defaultdict(list)
    for (i, _), r in zip(texts, root):
        least[r].append(i)
    first = {r: min((i for i in ids if i is not None), default=None) for r, ids in least.items()}
    return sorted(((i, len(s), first[r] if s else i) for (i, _), s, r in zip(texts, sets, root)), key=repr), len(first)


def _got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


def _near_copies(seed, n=140):
    """Groups of near copies of all sizes, from tiny sets on, and a hot one."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        if out and rng.random() < 0.6:
            w = rng.choice(out[-20:] + out[:2])[1].split()
            for _ in range(rng.randint(0, 1 + len(w) // 30)):
                at = rng.randrange(len(w))
                rng.choice([lambda: w.insert(at, "new"), lambda: w.__setitem__(at, "edit"), lambda: w.pop(at) if len(w) > 1 else None])()
        else:
            w = rng.choices(words, k=rng.choice([1, 3, 4, 5, 6, 9, 12, 15, 20, 30, 60, 120, 300]))
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize(("width", "num", "den"), [(4, 85, 100), (5, 80, 100), (1, 50, 100)])
def test_components_match_brute_force(spark, edge, width, num, den):
    texts = TEXTS + [(1000 + i, t) for i, t in _near_copies(width)]
    more = spark.createDataFrame(texts[len(TEXTS):], "doc_id long, text string")
    df = edge.select("doc_id", "text").unionByName(more)
    want, n = _brute(texts, width, num, den)
    out = jj.groups(df, width, num, den)
    assert _got(out) == want
    assert out.where("kept AND n_shingles > 0").count() + sum(x[1] == 0 for x in want) == n


def test_bands_and_parts_lose_no_pair():
    """Every pair within the bound shares a key, whatever the sizes."""
    rng = np.random.default_rng(5)
    for num, den in ((85, 100), (80, 100), (50, 100)):
        sim = jj.Similarity(num, den)
        for size in (1, 2, 5, 7, 8, 12, 13, 14, 20, 33, 64, 150, 700):
            for _ in range(12):
                a = np.unique(rng.integers(0, 2**64, size, np.uint64))
                keep = rng.permutation(len(a))[:max(1, -(-len(a) * num // den))]
                b = np.unique(np.concatenate([a[keep], rng.integers(0, 2**64, int(rng.integers(0, 3 + size // 9)), np.uint64)]))
                if jj.similar(a, b, num, den) and not np.array_equal(a, b):
                    assert set(jj.part_keys(a, sim).tolist()) & set(jj.part_keys(b, sim).tolist())


def test_deduplicate_keeps_columns_and_empty_tables(edge, nothing):
    out = jj.deduplicate(edge, 4, 85, 100)
    assert out.columns == edge.columns
    want, n = _brute(TEXTS, 4, 85, 100)
    assert out.count() == n
    assert jj.groups(nothing).count() == 0 and jj.deduplicate(nothing).count() == 0


def test_components_of_chains_and_stars(spark):
    key = lambda i: bytes([i // 256, i % 256])
    links = [(key(i), key(i + 1)) for i in range(40)] + [(key(100), key(100 + i)) for i in range(1, 30)] + [(key(9), key(9))]
    df = spark.createDataFrame(links, "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["root"]) for r in connected(df).collect()}
    assert got == {key(i): key(0) for i in range(41)} | {key(i): key(100) for i in range(100, 130)}
    assert connected(df.limit(0)).count() == 0
