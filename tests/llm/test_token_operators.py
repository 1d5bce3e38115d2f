import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import TEXTS
from tokenizers import Tokenizer

from pyspark.sql.functions import spark_partition_id

from eventide.llm import packing, sentence_pieces, token_files
from eventide.llm.tokens import WordEncoder

ODD = ["a\n\n\nb", "a\n\n", "a\n\tb", "\n\nb", "", "a b  c", "x\n\ny z", "<|endoftext|> a", "İstanbul ǅ é é ﬁ",
       " a b c", "it's don't WE'LL 3 a3b", "  lead", "trail ", "a\tb \t", "日本 語 text", "a\0b c", "²³ ½ x²", "a\r\nb"]


def _path(name):
    return public_tokenizers.path(name)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("kept", [0, 200_000])
def test_encoder_equals_the_library(name, kept):
    enc, lib = WordEncoder(_path(name), kept), Tokenizer.from_file(_path(name))
    texts = ODD + [t or "" for _, t in TEXTS]
    for text, ids in zip(texts, enc.encode(texts, 2)):
        assert np.frombuffer(ids, enc.dtype).tolist() == lib.encode(text, add_special_tokens=False).ids + [2], text


def _ids(name, text):
    return np.array(Tokenizer.from_file(_path(name)).encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def test_token_files_round_trip(spark, edge, nothing, tmp_path):
    vocabulary = _path("byte_bpe_50k.json")
    want, start = [], 0
    for i, t in sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, (x[1] or "") > "")):
        ids = _ids("byte_bpe_50k.json", t)
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
    got = token_files.token_digests(edge, vocabulary).orderBy("start").collect()
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=repr) == sorted(want, key=repr)
    named = [r["doc_id"] for r in got]
    assert named == sorted(named, key=lambda i: (i is not None, i or 0))
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    assert token_files.token_digests(nothing, vocabulary).count() == 0
    # Small files; random access by select and range read.
    manifest = token_files.write_token_files(edge, vocabulary, 2, str(tmp_path / "f"), file_ids=50).persist()
    assert manifest.count() > 3
    assert token_files.read_token_files(manifest).select(spark_partition_id()).distinct().count() > 1
    asked = manifest.selectExpr("path AS file", "0 AS doc")
    docs = {tuple(_ids("byte_bpe_50k.json", t).tolist()) for _, t in TEXTS}
    assert all(tuple(r["ids"]) in docs for r in token_files.lookup(spark, manifest, asked).collect())


@pytest.mark.parametrize("values", [[0], [0, 0, 0], [0, 5, 5, 9, 1000], list(range(500)), [10**9], [0] * 200 + [7] * 200,
                                    np.cumsum(np.random.default_rng(0).integers(0, 3000, 700)).tolist()])
def test_boundaries_select(values):
    b = token_files.Boundaries.build(np.array(values))
    assert b.all().tolist() == values
    assert [b.select(i) for i in range(len(values))] == values


def _padding(fills, capacity):
    return sum(0 if f & (f - 1) == 0 else capacity - f for f in fills)


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 64, 4096])
    histogram = {rng.randint(1, capacity): rng.choice([1, 2, 300]) for _ in range(rng.choice([1, 4, 200]))}
    placed = packing.plan(histogram, capacity)
    seen, sequences = {}, {}
    for length, first, last, cut, size, sequence, offset in placed.tolist():
        for i in range(last - first):
            seen.setdefault((length, first + i), []).append((cut, size))
            sequences.setdefault(sequence + i, []).append((offset, size))
    assert len(seen) == sum(histogram.values())
    for (length, _), slices in seen.items():
        assert sorted(slices) == [(sum(s for _, s in sorted(slices)[:k]), x[1]) for k, x in enumerate(sorted(slices))]
        assert sum(s for _, s in slices) == length
    for own in sequences.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= capacity
    assert _padding([sum(s for _, s in own) for own in sequences.values()], capacity) == 0


def test_pack_covers_all_documents(edge, nothing):
    out = packing.pack(edge, _path("word_bpe_49k.json"), capacity=64).collect()
    pieces, sequences = {}, {}
    for r in out:
        assert r["ids_crc32"] == zlib.crc32(np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4").tobytes())
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    ids = {}
    for i, t in TEXTS:
        ids.setdefault(i, []).append(_ids("word_bpe_49k.json", t).tolist())
    for i, own in pieces.items():
        assert sum(r["length"] for r in own) == sum(map(len, ids[i]))
        if len(ids[i]) == 1:
            joined = [x for r in sorted(own, key=lambda r: r["start"]) for x in np.frombuffer(r["ids"], "<u2").tolist()]
            assert joined == ids[i][0] and {r["doc_tokens"] for r in own} == {len(joined)}
    assert set(pieces) == set(ids)
    assert _padding([sum(n for _, n in s) for s in sequences.values()], 64) == 0
    assert packing.pack(nothing, _path("word_bpe_49k.json")).count() == 0


def test_sentence_pieces_equal_the_library(edge, nothing):
    import sentencepiece

    model = _path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=model)
    own = sentence_pieces.Pieces(model)
    texts = ODD + ["aaaa bbbbbbb -------------", "            indented", "tail   ", " ", "<s> </s> <0x0A>"] + [t or "" for _, t in TEXTS]
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(text), text
    assert own.decode(own.encode(texts)) == texts
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"], r["decoded_sha256"])
                  for r in sentence_pieces.round_trip(edge, model).collect()), key=repr)
    want = [(i, len(e := lib.encode(t or "")), zlib.crc32(np.array(e, "<u4").tobytes()),
             hashlib.sha256((t or "").encode()).hexdigest()) for i, t in TEXTS]
    assert got == sorted(want, key=repr)
    assert sentence_pieces.round_trip(nothing, model).count() == 0
