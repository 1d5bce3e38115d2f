import collections
import random
import re

import numpy as np
import pytest

from eventide.llm import spelling as sp
from eventide.llm.queries import _noisy

from llm_cases import TEXTS

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _brute(docs, least, occurrences, ratio, noise=False):
    n = collections.Counter()
    for i, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOWER)
            n[_noisy("" if i is None else str(i))(w.encode("latin-1")).decode("latin-1") if noise else w] += 1
    n = {w: c for w, c in n.items() if len(w) >= least and c >= occurrences}
    near = {w: [v for v in n if v != w and _near(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=repr)


def _got(df):
    return sorted(((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()), key=repr)


def _docs(seed):
    """Variants of a few stems of all lengths, some many times as frequent, with runs of one letter."""
    rng = random.Random(seed)
    stems = ["a", "ab", "aaaaaa", "aaaaaaa", "aaaaaaaa", "banana", "bananas", "mississippi", "façade", "naïveté", "x" * 70, "×÷×÷"]
    out = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(1, 40)):
            w = rng.choice(stems[:1 + i % len(stems)])
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w) + 1)
                w = rng.choice([w[:at] + rng.choice("abnsé") + w[at:], w[:at] + w[at + 1:], w[:at] + rng.choice("abnsé") + w[at + 1:]]) or "a"
            words.append(rng.choice([w, w.upper(), w.title()]))
        out.append((2_000 + i, rng.choice([" ", ", ", "1"]).join(words)))
    return out


@pytest.mark.parametrize(("least", "occurrences", "ratio", "symbols"), [(1, 1, 2, 2), (1, 2, 10, 6), (7, 2, 10, 4), (3, 1, 1, 1)])
def test_variants_match_brute_force(spark, edge, least, occurrences, ratio, symbols):
    docs = TEXTS + _docs(least)
    if ratio == 1:  # forms of equal frequency could be circles: every ratio above 1 is safe
        ratio = 2
    df = edge.select("doc_id", "text").unionByName(spark.createDataFrame(docs[len(TEXTS):], "doc_id long, text string"))
    assert _got(sp.variants(df, least, occurrences, ratio, symbols)) == _brute(docs, least, occurrences, ratio)


def test_noise_of_the_query_and_flushed_counts(spark, edge, monkeypatch):
    docs = TEXTS + _docs(9)
    df = edge.select("doc_id", "text").unionByName(spark.createDataFrame(docs[len(TEXTS):], "doc_id long, text string"))
    monkeypatch.setattr(sp, "COUNTED", 5)
    assert _got(sp.variants(df, 7, 2, 10, change=_noisy)) == _brute(docs, 7, 2, 10, noise=True)


def test_neighbourhood_reaches_every_edit():
    rng = random.Random(2)
    for symbols in (1, 3, 6):
        for n in (1, 2, 3, 5, 8, 31, 64):
            w = bytes(rng.choice(b"abc") for _ in range(n))
            keys = set(np.concatenate([k[holds] for k, holds in sp.Halves([w], symbols).neighbours()]).tolist())
            for at in range(n + 1):
                for v in (w[:at] + w[at + 1:], w[:at] + b"d" + w[at:], w[:at] + b"d" + w[at + 1:]):
                    assert not v or set(sp.Halves([v], symbols).ends().ravel().tolist()) & keys


def test_long_chains_and_empty_tables(spark, nothing):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(21)]
    df = spark.createDataFrame(chain, "word string, form string")
    assert {tuple(r) for r in sp.roots(df).collect()} == {(a, "n21") for a, _ in chain}
    assert sp.roots(df.limit(0)).count() == 0
    assert sp.variants(nothing).count() == 0
