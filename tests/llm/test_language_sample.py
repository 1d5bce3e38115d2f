import pickle

from eventide.llm import language_id as li

SCHEMA = "doc_id long, text string, lang string"


def _free(n):
    """Identifiers that are not held out."""
    import zlib

    return [i for i in range(3 * n + 50) if zlib.crc32(str(i).encode()) % 3 != 1][:n]


def test_every_language_is_learned(spark):
    rows = [(i, f"word{chr(97 + k % 26)}{chr(97 + k // 26)} text", f"l{k:03}") for k, i in enumerate(_free(230))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert li.train(df).langs == sorted({r[2] for r in rows})


def test_a_language_of_long_texts_only_is_learned(spark):
    short, long = "the house and the garden ", "das haus und der garten "
    ids = _free(24)
    rows = [(i, short * 3, "en") if k % 2 else (i, long * 9_000, "de") for k, i in enumerate(ids)]
    assert len(long * 9_000) > li.MOST_CHARS
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    model = li.train(df)
    assert model.langs == ["de", "en"]
    assert [r[0] for r in model.predict([long * 2, short * 2])] == ["de", "en"]


def test_the_sample_of_many_languages_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(li, "MOST_DOCUMENTS", 12)
    fitted = []
    monkeypatch.setattr(li, "fit", lambda texts, labels: fitted.append(labels))
    rows = [(i, f"word {i}", f"l{k % 40:02}" if k % 3 else "common") for k, i in enumerate(_free(200))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    li.train(df)
    li.train(df.where("lang IN ('l01', 'l02', 'common')"), per_language=3)
    assert "common" in fitted[0] and len(fitted[0]) == len(set(fitted[0])) == 12
    assert sorted(fitted[1]) == sorted(["l01", "l02", "common"] * 3)


def test_a_model_travels_as_plain_values():
    model = li.fit(["the house and the garden"] * 20 + ["das haus und der garten"] * 20, ["en"] * 20 + ["de"] * 20)
    assert model.familiar and b"eventide" not in pickle.dumps(model.state())
    texts = ["the garden", "der garten", None, "qzx"]
    assert li.Model.of(model.state()).predict(texts) == model.predict(texts)
