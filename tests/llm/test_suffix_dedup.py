import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from eventide.llm import suffix_dedup as sd

from llm_cases import TEXTS


def _brute(bodies, length):
    seen = {}
    for b in bodies:
        for p in range(len(b) - length + 1):
            seen[b[p:p + length]] = seen.get(b[p:p + length], 0) + 1
    out = []
    for b in bodies:
        cover = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                cover[p:p + length] = b"\1" * length
        runs = sum(1 for j in range(len(b)) if cover[j] and (j == 0 or not cover[j - 1]))
        out.append((len(b), sum(cover), runs, hashlib.sha256(bytes(c for c, f in zip(b, cover) if not f)).hexdigest()))
    return out


def _check(df, texts, hot=sd.HOT):
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                  for r in sd.spans(df, hot=hot).collect()), key=repr)
    want = _brute([(t or "").encode() for _, t in texts], 400)
    assert got == sorted(((i, *w) for (i, _), w in zip(texts, want)), key=repr)
    assert any(r[2] for r in got)


@pytest.mark.parametrize("hot", [sd.HOT, 1, 0])
def test_spans_match_brute_force(edge, hot):
    _check(edge, TEXTS, hot)


def test_random_repeats_with_edits(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    base, texts = text(160), []
    for i in range(24):
        w = base.split()
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = "edit"
        texts.append((i, text(rng.randint(0, 60)) + " " + " ".join(w[rng.randint(0, 40):]) + " " + text(rng.randint(0, 60))))
    texts += [(100, "ab" * 700), (101, "z" + "ab" * 500)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    _check(df, texts)
    _check(df, texts, hot=2)


def test_pieces_of_long_texts_lose_nothing(monkeypatch):
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, 9_000, np.uint8).tobytes()
    whole = [x for x in sd.strands([text], 400)]
    monkeypatch.setattr(sd, "CHUNK", 1_000)
    cut = [x for x in sd.strands([text], 400)]
    windows = lambda s: sorted(f + j for _, f, n, _, _ in s for j in range(n))
    assert windows(whole) == windows(cut) == list(range(9_000 - 399))
    keys = lambda s: {(f + j): k for _, f, n, _, k in s for j in range(n)}
    assert keys(whole) == keys(cut)


def test_construction_orders_and_prefixes():
    bodies = [b"xabcdefgh", b"yabcdefgh", b"zabcdefgq"]
    first, last = sd.repeated_windows(bodies, np.array([4, 4, 4]), 8)
    assert first.tolist() == [1, 1, -1] and last.tolist() == [1, 1, -1]


def test_text_stays_valid_and_columns_stay(edge, nothing):
    out = sd.deduplicate(edge)
    assert out.columns == edge.columns
    rows = {r["key"]: r["text"] for r in out.collect()}
    assert rows[10] == "" and rows[9] == "head " + " tail"[-5:] or rows[9].startswith("head")
    assert sd.spans(nothing).count() == 0 and sd.deduplicate(nothing).count() == 0
    assert sd.whole_characters("aéé".encode(), [(2, 4)]) == []
    assert sd.whole_characters("aéé".encode(), [(1, 4)]) == [(1, 3)]


def test_strands_with_anchors_of_their_own_are_not_written(spark, monkeypatch):
    rng = np.random.default_rng(7)
    texts = [rng.integers(97, 123, 1_200, np.uint8).tobytes() for _ in range(40)]
    texts.append(texts[0][300:900] + texts[1][:500])
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = sd.written(docs, "test-strands")
    rows, plain = {}, sd.written

    def counted(df, name, **options):
        out = plain(df, name, **options)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(sd, "written", counted)
    got = [r["text"].encode() for r in sd.deduplicate(docs, 101, gram=32).orderBy("doc_id").collect()]
    want = [texts[0][:300] + texts[0][900:], texts[1][500:], *texts[2:40], b""]
    assert got == want
    every = list(sd.strands(texts, 101, 32))
    keys, times = sd.strand_keys(texts, 101, 32)
    assert dict(zip(keys.tolist(), times.tolist())) == dict(Counter(s[-1] for s in every))
    assert 0 < max(rows.values()) < len(every) / 5


def test_texts_are_dealt_out_once(edge):
    plan = sd.deduplicate(edge)._jdf.queryExecution().optimizedPlan().toString()
    assert "AS body" not in plan[plan.index("Join LeftOuter"):].split("Aggregate")[0]
