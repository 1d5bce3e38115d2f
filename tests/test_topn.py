import datetime as dt
import json

from eventide.operators import running_topn, topn_json, window_topn
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def _clicks(spark, spec):
    """spec: list of (sex, name, count) all inside the first minute."""
    out, i = [], 0
    for sex, name, n in spec:
        for _ in range(n):
            out.append((name, sex, T0 + dt.timedelta(seconds=i % 50)))
            i += 1
    return spark.createDataFrame(out, "name string, sex string, ts timestamp_ntz")


def test_window_topn_ties_and_short_groups(spark):
    df = _clicks(spark, [("m", "a", 3), ("m", "b", 2), ("m", "c", 2), ("m", "d", 1), ("f", "z", 1)])
    out = window_topn(df, "ts", "1 hour", "1 hour", ["sex"], "name", n=2)
    got = rows(out, "sex", "name", "cnt")
    assert got == sorted([("m", "a", 3), ("m", "b", 2), ("f", "z", 1)], key=repr)  # tie b/c -> name order


def test_running_topn_all_rows(spark):
    df = _clicks(spark, [("m", "a", 1), ("m", "b", 4), ("m", "c", 4), ("f", "y", 2)])
    got = rows(running_topn(df, "sex", "name", 10), "sex", "name", "cnt")
    assert got == sorted([("m", "b", 4), ("m", "c", 4), ("m", "a", 1), ("f", "y", 2)], key=repr)


def test_topn_json_rank_order(spark):
    df = _clicks(spark, [("m", "王", 2), ("m", "b", 3), ("m", "a", 2), ("m", "q", 1)])
    out = topn_json(df, "ts", "1 hour", "1 hour", "sex", "name", n=3).first()
    assert out["top10"] == '{"b":3,"a":2,"王":2}'
    assert list(json.loads(out["top10"]).items()) == [("b", 3), ("a", 2), ("王", 2)]


def test_topn_plan_limits_before_shuffle(spark):
    df = _clicks(spark, [("m", "a", 3)])
    plan = window_topn(df, "ts", "1 hour", "1 hour", ["sex"], "name", n=2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["m", "f", None]), st.sampled_from(list("abcdefg") + [None])),
                min_size=1, max_size=60), st.integers(1, 4))
def test_running_topn_equals_sort_and_slice(spark, events, n):
    df = spark.createDataFrame([(name, sex) for sex, name in events], "name string, sex string")
    got = rows(running_topn(df, "sex", "name", n), "sex", "name", "cnt")
    counts = {}
    for sex, name in events:
        counts[(sex, name)] = counts.get((sex, name), 0) + 1
    exp = []
    for sex in {s for s, _ in counts}:
        items = sorted(((name, c) for (s, name), c in counts.items() if s == sex),
                       key=lambda x: (-x[1], (x[0] is not None, x[0] or "")))  # NULLs first, as in Spark ASC
        exp += [(sex, name, c) for name, c in items[:n]]
    assert got == sorted(exp, key=repr)


def test_json_of_a_null_and_a_user_called_null(spark):
    from eventide.operators.topn import topn_json_from_counts

    df = spark.createDataFrame([("m", None, 3), ("m", "null", 2), ("m", 'q"\\[x]', 1)], "sex string, name string, cnt bigint")
    text = topn_json_from_counts(df, ["sex"], "name", 3).first()["top10"]
    assert text == '{"null":3,"null":2,"q\\"\\\\[x]":1}'
