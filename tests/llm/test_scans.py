import hashlib
import json
import re

import numpy as np
import pytest
from llm_cases import TEXTS
from pyspark.sql.functions import spark_partition_id

from eventide.llm import language_id as li
from eventide.llm import licenses, warc

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _base(text):
    words = re.findall(licenses.WORD, (text or "").translate(_LOWER))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        hits = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        places += hits
        labels |= {label} if hits else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licences_match_brute_force(edge, nothing, tmp_path):
    more = [(20 + i, t) for i, t in enumerate(["all rights reserved", "ALL RIGHTS RESERVED all rights reserved",
            "all rights\n\nreserved.", "cc", "ccby", "xcc by", "cc by.", "cc-by", "general public\tlicense", "cc cc by by"])]
    spark = edge.sparkSession
    df = edge.select("doc_id", "text", "key").unionByName(spark.createDataFrame(more, "doc_id long, text string").selectExpr("*", "0L AS key"))
    got = licenses.scan(df).collect()
    rows = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got]
    assert sorted(rows, key=repr) == sorted(((i, *_base(t)) for i, t in TEXTS + more), key=repr)
    by = {r["doc_id"]: r for r in got}
    assert by[15]["labels"] == "cc-by,cc-by-nc,reserved" and 0.9 < by[15]["score"] <= 1
    assert by[1]["labels"] == "" and by[1]["score"] == 0
    assert all(set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got)
    assert licenses.scan(nothing).count() == 0
    df.write.parquet(f"{tmp_path}/docs")
    plan = licenses.scan(spark.read.parquet(f"{tmp_path}/docs"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_archives_round_trip(spark, tmp_path):
    big = "<p>" + "é" * 600 + "</p>"
    pages = [(1, "http://a.example/x", big), (2, "http://www.a.example:8080/y?q=1", big), (3, "https://b.example", big),
             (4, "http://b.example/z", "small"), (5, "http://b.example/z", "small"), (6, None, None), (7, "", ""),
             (8, "not a url [", big + "x"), (8, "not a url [", big + "x"), (None, "http://n.example/", big), (9, "http://b.example/z\r\n", "t")]
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, key string").repartition(3)
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
           for r in warc.archive_round_trip(df).collect()]
    want = []
    for i, _, html in pages:
        data = (html or "").encode()
        ref = 3 if html == big and i != 3 else None
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if ref else "response", ref))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert warc.archive_round_trip(df.limit(0)).count() == 0
    # Blocks and archives of one capture each: the index is searched over many of them.
    manifest = warc.write_archives(df, str(tmp_path / "w"), archive_bytes=1)
    assert manifest.count() == len(pages)
    asked = df.where("page_id IN (4, 5)").unionByName(df.sparkSession.createDataFrame(
        [(99, "http://b.example/z", None, None)], df.schema))
    found = warc.lookup(manifest, asked).collect()
    assert sorted((r["page_id"], r["payload"].decode()) for r in found) == [(4, "small"), (5, "small")]
    # Reading is dealt to many tasks, however few bytes the asked rows have.
    assert warc.lookup(manifest, df).select(spark_partition_id()).distinct().count() > 1


def test_index_blocks(tmp_path, monkeypatch):
    assert warc.url_key("http://www.a.example:80/x?q=2") == "example,a,www)/x?q=2"
    assert warc.url_key(None) == ")/" and warc.url_key("http://h.example") == "example,h)/"
    import gzip

    lines = [[f"k{i // 3:04d}", i, i * 10, 10] for i in range(900)]
    blocks, directory, off = [], [], 0
    for i in range(0, 900, 7):
        b = gzip.compress("\n".join(json.dumps(x) for x in lines[i:i + 7]).encode())
        directory.append([lines[i][0], off, len(b)])
        blocks.append(b)
        off += len(b)
    path = tmp_path / "x.idx"
    path.write_bytes(b"".join([*blocks, json.dumps(directory).encode(), off.to_bytes(8, "little")]))
    index = warc.Index(str(path))
    assert all(index.captures(k, i) == [(o, n)] for k, i, o, n in lines)
    assert index.captures("k0000", 5) == [] and index.captures("a", 1) == [] and index.captures("z", 1) == []


ENGLISH = ["the house and the garden of the other people were", "that thing which there with them something the", "and they then thought the weather"]
GERMAN = ["das haus und der garten der anderen leute waren nicht", "dass ich nicht weiss wie das geschieht und", "über die strasse für schöne mädchen"]


def _labelled(n):
    rng = np.random.default_rng(n)
    out = []
    for i in range(n):
        lang, source = ("en", ENGLISH) if i % 2 else ("de", GERMAN)
        words = " ".join(source).split()
        out.append((i, " ".join(rng.choice(words, 25)), lang))
    return out


def test_language_held_out_accuracy_and_edges(spark, edge):
    rows = _labelled(300) + [(1000, None, "en"), (1001, "", "de"), (1002, "123 !!", "en"), (None, "the house", "en"), (1003, "the " * 5000, None)]
    df = spark.createDataFrame([(*r, 0.5, True) for r in rows], "doc_id long, text string, lang string, score double, rejected boolean").repartition(4)
    out = {r["doc_id"]: r for r in li.predictions(df).collect()}
    held = [(out[i]["lang_pred"], lang) for i, _, lang in rows[:300] if out[i]["held_out"]]
    assert 60 < len(held) < 140 and np.mean([a == b for a, b in held]) > 0.97
    for i in (1000, 1001, 1002):
        assert (out[i]["lang_pred"], out[i]["score"], out[i]["rejected"]) == ("und", 0.0, True)
    assert out[1003]["lang_pred"] == "en" and not out[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in out.values())
    import zlib

    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(300))
    kept = li.identify(df, li.train(df))
    assert sorted(kept.columns) == ["doc_id", "lang", "lang_pred", "rejected", "score", "text"]
    assert li.predictions(df.limit(0)).count() == 0
    none = li.predictions(df.withColumn("lang", df["lang"].substr(100, 1).cast("string")).where("false").unionByName(
        df.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang", "score", "rejected")))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}


def test_language_prediction_ignores_other_columns(spark):
    rows = _labelled(120)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = li.train(df)
    swapped = df.selectExpr("doc_id + 5000 AS doc_id", "text", "'xx' AS lang")
    same = lambda d: sorted((r["text"], r["lang_pred"], round(r["score"], 9)) for r in li.identify(d, model).collect())
    assert same(df) == same(swapped)


@pytest.mark.parametrize("most", [0, 10, 10_000])
def test_word_vectors_equal_direct_averages(most):
    rng = np.random.default_rng(0)
    vectors = rng.random((li.BUCKETS, 4), np.float32)
    known = li.WordVectors(vectors, most)
    for text in ("a b a c", "long words here", "a here x", "x"):
        own = li.words(text)
        want = np.mean([vectors[li.grams(w)].mean(axis=0) for w in own], axis=0)
        assert np.allclose(known.average(own), want, atol=1e-5)
