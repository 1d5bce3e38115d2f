"""Which sets are fetched: those of pairs that no sketch rules out."""

import itertools

import numpy as np

from eventide.llm import jaccard_join as jj
from eventide.llm.common import written


def counted(monkeypatch):
    """Rows of the written tables, by name."""
    made = {}

    def noted(df, name, *args, **kw):
        out = written(df, name, *args, **kw)
        made.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jj, "written", noted)
    return made


def test_sets_are_fetched_for_pairs_not_for_all_members_of_keys(spark, monkeypatch):
    made = counted(monkeypatch)
    shared = [f"w{j}" for j in range(200)]  # two thirds of the words in common make keys, but no links
    texts = [[*shared, *(f"s{i}x{j}" for j in range(100))] for i in range(12)]
    texts.append([*texts[0][:-1], "new"])
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    out = jj.groups(df, 1, 80, 100)
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {i: i for i in range(12)} | {12: 0}
    assert made["jaccard-sketches"] == [13] and made["jaccard-bodies"] == [2]


def test_large_sets_are_ruled_out_by_wide_sketches(spark, monkeypatch):
    """A third of the words in common makes keys, and short sketches can't tell 6,000 words apart."""
    made = counted(monkeypatch)
    large, mid = [f"w{j}" for j in range(6000)], [f"m{j}" for j in range(2030)]
    texts = [large, [*large[:2000], *(f"x{j}" for j in range(4000))], mid, [*mid, *(f"y{j}" for j in range(40))]]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    out = jj.groups(df, 1, 80, 100)
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {0: 0, 1: 1, 2: 2, 3: 2}
    assert made["jaccard-sketches"] == [4] and made["jaccard-pairs"] == [1] and made["jaccard-bodies"] == [2]


def test_wide_sketches_fold():
    tokens = np.random.default_rng(1).integers(0, 2**64, 5000, np.uint64)
    wide = jj.wide_sketch(tokens)
    assert len(wide) == 128 and jj.wide_sketch(tokens[:1024]) is None and len(jj.wide_sketch(tokens[:1025])) == 32
    while len(wide) > jj.SKETCH:
        half = len(wide) // 2
        wide = wide[:half] ^ wide[half:]
        assert np.array_equal(wide, jj.bit_sketch(tokens, half))


def test_wide_sketches_rule_no_link_out(spark):
    rng = np.random.default_rng(2)
    for num, den in ((80, 100), (50, 100), (30, 100), (1, 1)):
        sets = []
        for size in (700, 1000, 1030, 2040, 2060, 3000, 4090, 6000):
            a = np.unique(rng.integers(0, 2**64, size, np.uint64))
            keep = -(-size * num // den)
            sets += [a, a[:keep], np.concatenate([a, rng.integers(0, 2**64, size * (den - num) // num, np.uint64)])]
            sets.append(np.concatenate([a[:keep], rng.integers(0, 2**64, size // 50, np.uint64)]))
        sets = [np.unique(s) for s in sets]
        node = lambda i: i.to_bytes(2, "big")
        rows = [(node(i), len(s), None if (w := jj.wide_sketch(s)) is None else w.tolist()) for i, s in enumerate(sets)]
        classes = spark.createDataFrame(rows, "node binary, n long, wide array<long>")
        near = [(a, b) for a, b in itertools.combinations(range(len(sets)), 2)
                if min(len(sets[a]), len(sets[b])) * den >= max(len(sets[a]), len(sets[b])) * num]
        links = {(node(a), node(b)) for a, b in near if jj.similar(sets[a], sets[b], num, den)}
        out = jj.narrowed(spark.createDataFrame([(node(a), node(b)) for a, b in near], "a binary, b binary"), classes, num, den)
        left = {(bytes(r["a"]), bytes(r["b"])) for r in out.collect()}
        assert left >= links and links
        if num * 10 >= den * 8:
            assert all(jj.similar(sets[int.from_bytes(a)], sets[int.from_bytes(b)], num, 2 * den)
                       for a, b in left if rows[int.from_bytes(a)][2] and rows[int.from_bytes(b)][2])
