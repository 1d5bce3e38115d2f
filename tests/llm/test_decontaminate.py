import hashlib
import random
import re

import pytest

from eventide.llm import decontaminate as dc

from llm_cases import PASSAGE, TEXTS

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _words(text):
    return WORD.findall((text or "").translate(LOWER))


def _brute(docs, items, window):
    out = []
    for i, text in docs:
        w, hit, ids = _words(text), set(), set()
        for item, other in items:
            own = _words(other)
            size = min(window, len(own))
            wanted = {tuple(own[s:s + size]) for s in range(len(own) - size + 1)} if own else set()
            for s in range(len(w) - size + 1 if wanted else 0):
                if tuple(w[s:s + size]) in wanted:
                    hit |= set(range(s, s + size))
                    ids |= {str(item)} if item is not None else set()
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=repr)


def _got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                   for r in df.collect()), key=repr)


ITEMS = [(1, "nothing of this stands in any of the other texts, but it is long enough"), (2, PASSAGE), (2, PASSAGE), (11, PASSAGE[50:400]),
         (3, "delta EPSILON zeta-eta"), (4, "kappa"), (5, "mu nu"), (6, None), (7, ""), (8, "!?"), (None, "omicron pi"),
         (9, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (10, "日本語 text")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, "k", 1) for i, t in ITEMS], "item_id long, text string, words string, h long").repartition(3)


def test_edge_cases_match_brute_force(edge, items):
    for window in (10, 4, 1):
        assert _got(dc.report(edge, items, window)) == _brute(TEXTS, ITEMS, window)


def test_random_texts_match_brute_force(spark):
    """Few words, so that shingles and windows overlap, repeat and nearly match."""
    rng = random.Random(3)
    text = lambda n, of: " ".join(rng.choice(of) for _ in range(n))
    few, many = [f"a{i}" for i in range(3)], [f"b{i}" for i in range(60)]
    items = [(i, text(rng.choice([2, 5, 9, 10, 11, 14, 30]), few if i % 3 else many)) for i in range(25)]
    docs = [(i, text(rng.choice([0, 1, 8, 40, 300]), few if i % 2 else many)) for i in range(40)]
    for i in range(40, 70):  # passages whole, cut short and with one word changed
        w = _words(rng.choice(items)[1])
        w = rng.choice([w, w[:9], w[1:], w[:5] + ["odd"] + w[6:], w + w])
        docs.append((i, text(rng.choice([0, 3]), many) + " " + " ".join(w).upper() + " " + text(4, many)))
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    assert _got(dc.report(d, b, 10)) == _brute(docs, items, 10)


def test_chunks_and_counts_in_parts_change_nothing(edge, items, monkeypatch):
    monkeypatch.setattr(dc, "CHUNK_WORDS", 3)
    monkeypatch.setattr(dc, "COUNTED", 2)
    assert _got(dc.report(edge, items, 4)) == _brute(TEXTS, ITEMS, 4)


def test_spans_clean_and_empty_tables(spark, edge, nothing, items):
    spans = {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in dc.hits(edge, items, 10).collect() if r["doc_id"]}
    assert spans[10] == [(1, 1 + len(_words(PASSAGE)))] and spans[13] == []
    kept = dc.clean(edge, items, 10)
    assert kept.columns == edge.columns
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == sorted(
        repr(i) for (i, _), b in zip(TEXTS, (x[5] for t in TEXTS for x in _brute([t], ITEMS, 10))) if not b)
    assert dc.report(nothing, items).count() == 0
    none = dc.report(edge, items.limit(0))
    assert none.count() == len(TEXTS) and none.where("contaminated OR n_items > 0").count() == 0


def test_bitmap_misses_no_member_and_stays_bounded(spark, monkeypatch):
    import numpy as np

    from eventide.llm import words

    h = np.random.default_rng(1).integers(-2**63, 2**63, 5_000, np.int64)
    keys = spark.createDataFrame([(int(x),) for x in h], "k long")
    others = np.random.default_rng(2).integers(0, 2**63, 5_000, np.int64).view(np.uint64)
    made = words.bitmap(keys, "k")
    assert words.present(made, h.view(np.uint64)).all() and words.present(made, others).mean() < 0.03
    monkeypatch.setattr(words, "MOST_BITS", 1 << 12)
    small = words.bitmap(keys, "k")
    assert len(small) * 64 == 1 << 12 and words.present(small, h.view(np.uint64)).all()
