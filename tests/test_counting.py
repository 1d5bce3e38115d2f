import datetime as dt

from eventide.functions import schemas
from eventide.operators import live_clicks, token_count, word_count
from tests.conftest import rows


def test_word_count_cases(spark):
    words = spark.createDataFrame([(1, "hello"), (2, "hello"), (3, "世界"), (4, None), (5, "ß")], schemas.WORDS)
    assert rows(word_count(words)) == sorted([("hello", 2), ("世界", 1), (None, 1), ("ß", 1)], key=repr)
    assert word_count(spark.createDataFrame([], schemas.WORDS)).count() == 0


def test_token_count_keeps_empty_tokens_like_split(spark):
    docs = spark.createDataFrame([("a b  a",), ("",), (None,)], "text string")
    assert rows(token_count(docs)) == sorted([("a", 2), ("b", 1), ("", 2)], key=repr)


def test_live_clicks_filter(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", "m", "click", 0, t), ("b", "m", "scroll", 0, t), ("c", "m", "click", 1, t),
                                ("d", "m", None, 0, t), ("e", "m", "click", None, t)], schemas.USER_ACTION)
    assert rows(live_clicks(df), "name") == [("a",)]
