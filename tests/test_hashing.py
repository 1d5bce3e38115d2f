import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from eventide.functions import HashCode, hash_code, hash_code_pandas, hash_code_udf, register_sql_functions


def _wrap(v):
    return ((v + (1 << 63)) % (1 << 64)) - (1 << 63)


CASES = [1, -1, 2 ** 61, 0, 2, -2, (1 << 61) - 1, (1 << 61) - 2, 2 ** 63 - 1, -(2 ** 63), 12345678901234, None]


def _expected(v, factor=12):
    return None if v is None else _wrap(hash(v) * factor)


def test_fixture_cases():
    f = HashCode()
    assert f.eval(1) == 12 and f.eval(-1) == -24 and f.eval(2 ** 61) == 12 and f.eval(None) is None


def test_native_udf_pandas_sql_agree(spark):
    df = spark.createDataFrame([(v,) for v in CASES], "id bigint")
    register_sql_functions(spark)
    df.createOrReplaceTempView("hash_in")
    out = spark.sql("SELECT id, hash_code2(id) AS s, hash_code_py(id) AS p FROM hash_in").select(
        "id", "s", "p", hash_code("id").alias("n"), hash_code_pandas()(F.col("id")).alias("v"),
        hash_code_udf(use_arrow=False)(F.col("id")).alias("r"), hash_code("id", 7).alias("n7"))
    for r in out.collect():
        exp = _expected(r["id"])
        assert (r["s"], r["p"], r["n"], r["v"], r["r"]) == (exp,) * 5, r
        assert r["n7"] == _expected(r["id"], 7)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(min_value=-(2 ** 63), max_value=2 ** 63 - 1), min_size=1, max_size=20))
def test_native_matches_python_hash(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "id bigint")
    got = {r["id"]: r["h"] for r in df.select("id", hash_code("id").alias("h")).collect()}
    for v in values:
        assert got[v] == _expected(v)


def test_vectorised_form_keeps_every_digit_beside_nulls(spark):
    values = [9007199254740993, None, (1 << 62) + 1, None, 2 ** 63 - 1, -(2 ** 63), -1, 0]
    df = spark.createDataFrame([(v,) for v in values], "id bigint").coalesce(1)  # one Arrow batch
    got = [r[0] for r in df.select(hash_code_pandas()(F.col("id"))).collect()]
    assert got == [_expected(v) for v in values]
