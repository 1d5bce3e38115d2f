import os
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from eventide.llm import suffix_dedup as sd

SF = "/root/testdata/sf0.001"


def _exact(docs):
    kept = {}
    for i, t in sorted(docs.items()):
        kept.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
    return {i: docs[i] for i in kept.values()}


def _near(docs):
    sets = {}
    for i, t in docs.items():
        w = (t or "").encode().lower().split()
        k = min(cp.SHINGLE_WORDS, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(docs)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= cp.SIMILARITY * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: t for i, t in docs.items() if find(i) == i}


def _repeats(docs):
    n, seen = cp.REPEAT_BYTES, {}
    bodies = {i: (t or "").encode() for i, t in docs.items()}
    for b in bodies.values():
        for p in range(len(b) - n + 1):
            h = hash(b[p:p + n])
            seen[h] = seen.get(h, 0) + 1
    out = {}
    for i, b in bodies.items():
        cover = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - n + 1):
            if seen[hash(b[p:p + n])] > 1:
                cover[p:p + n] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], cover]).astype(int)))
        runs = sd.whole_characters(b, list(zip(edges[::2].tolist(), edges[1::2].tolist())))
        out[i] = sd.remaining(b, runs).decode()
    return out


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")
def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
    want = texts(docs)
    assert list(dict(cp.STAGES)) == ["language", "exact dedup", "near dedup", "repeated strings", "packing"]
    brute = {"exact dedup": _exact, "near dedup": _near, "repeated strings": _repeats}
    for name, stage in cp.STAGES[:-1]:
        docs = cp.written(stage(spark, docs, SF), "test-stage")
        assert docs.columns == cp.COLUMNS
        got = texts(docs)
        if name == "language":  # clean documents stay; what it learns is tested by itself
            assert set(got) == set(want)
        else:
            want = brute[name](want)
            assert got == want, name
    assert docs.where("n_chars <> char_length(text)").count() == 0
    tokenizer = Tokenizer.from_file(public_tokenizers.path(cp.VOCABULARY))
    pieces = {}
    for r in cp.STAGES[-1][1](spark, docs, SF).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(want)
    for i, own in pieces.items():
        ids = np.array(tokenizer.encode(want[i], add_special_tokens=False).ids + [cp.END_ID], "<u4")
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_stages_stand_edge_cases(spark, edge, nothing):
    own = edge.select(*cp.COLUMNS)
    for df in (own, nothing.select(*cp.COLUMNS)):
        docs = df
        for _, stage in cp.STAGES:
            docs = cp.written(stage(spark, docs, SF), "test-edge")
        assert (docs.count() > 0) == (df is own)


def test_rejected_documents_go(spark):
    rows = [(i, "the house and the garden of the other people", "en", "s", 1) for i in range(12)]
    rows += [(100, "1234 !!", "en", "s", 1), (101, None, None, "s", None), (102, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in cp.language(spark, docs, SF).collect()}
    assert kept == set(range(12))
