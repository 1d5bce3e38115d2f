import datetime as dt
import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from eventide.operators import avg_, count_, hop_agg, max_, min_, session_agg, sum_, tumble_agg
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp_ntz, v double"


def _df(spark, events):
    return spark.createDataFrame(events, SCHEMA)


def test_tumble_edges_and_stats(spark):
    ev = [("a", T0, 1.0), ("a", T0 + dt.timedelta(seconds=9, microseconds=999999), 3.0),
          ("a", T0 + dt.timedelta(seconds=10), 5.0),          # exactly on the edge: next window
          ("b", T0 + dt.timedelta(seconds=1), None), ("b", None, 7.0)]
    out = tumble_agg(_df(spark, ev), "ts", "10 seconds", ["k"],
                     [max_("v", "mx"), min_("v", "mn"), avg_("v", "av"), count_("cnt")])
    got = rows(out, "k", "start_time", "end_time", "mx", "mn", "av", "cnt")
    ten = T0 + dt.timedelta(seconds=10)
    assert got == sorted([("a", T0, ten, 3.0, 1.0, 2.0, 2), ("a", ten, ten + dt.timedelta(seconds=10), 5.0, 5.0, 5.0, 1),
                          ("b", T0, ten, None, None, None, 1)], key=repr)


def _random_events(seed, n=200, keys=("a", "b", None), span_s=3600):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        t = T0 + dt.timedelta(microseconds=r.randrange(span_s * 1_000_000))
        out.append((r.choice(keys), t, r.choice([None, round(r.random() * 100, 2)])))
    # exact-gap and boundary neighbours
    out.append(("a", T0 + dt.timedelta(minutes=200), 1.0))
    out.append(("a", T0 + dt.timedelta(minutes=205), 1.0))
    out.append(("a", T0 + dt.timedelta(minutes=210, microseconds=1), 1.0))
    out.append(("a", T0 + dt.timedelta(minutes=214, seconds=59, microseconds=999999), 1.0))
    return out


@settings(max_examples=6, deadline=None)
@given(st.integers(0, 10_000))
def test_hop_panes_equal_direct(spark, seed):
    df = _df(spark, _random_events(seed))
    aggs = [count_("cnt"), count_("nv", "v"), sum_("v", "sv"), min_("v", "mn"), max_("v", "mx"), avg_("v", "av")]
    d = hop_agg(df, "ts", "10 minutes", "1 minute", ["k"], aggs, strategy="direct")
    p = hop_agg(df, "ts", "10 minutes", "1 minute", ["k"], aggs, strategy="panes")
    r = lambda x: x.withColumn("av", F.round("av", 9)).withColumn("sv", F.round("sv", 9))
    assert rows(r(d)) == rows(r(p))


@settings(max_examples=6, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from(["5 minutes", "90 seconds", "20 minutes"]), st.sampled_from([1, 3, 1024]))
def test_session_buckets_equal_native(spark, seed, gap, chunk):
    df = _df(spark, _random_events(seed, span_s=4 * 3600))
    aggs = [count_("cnt"), max_("v", "mx"), avg_("v", "av")]
    n = session_agg(df, "ts", gap, ["k"], aggs, strategy="native")
    b = session_agg(df, "ts", gap, ["k"], aggs, strategy="buckets", chunk=chunk)
    r = lambda x: x.withColumn("av", F.round("av", 9))
    assert rows(r(n)) == rows(r(b))


def test_session_gap_boundaries(spark):
    g = dt.timedelta(minutes=5)
    ev = [("c", T0, 1.0), ("c", T0 + g, 1.0),                                        # exactly gap: merged
          ("c", T0 + 2 * g + dt.timedelta(microseconds=1), 1.0),                     # just over: new
          ("c", T0 + 3 * g, 1.0),                                                     # just under: merged
          ("d", T0 + g, 1.0)]
    out = session_agg(_df(spark, ev), "ts", "5 minutes", ["k"], [count_("cnt")])
    got = rows(out, "k", "start_time", "end_time", "cnt")
    assert got == sorted([("c", T0, T0 + 2 * g, 2),
                          ("c", T0 + 2 * g + dt.timedelta(microseconds=1), T0 + 4 * g, 2),
                          ("d", T0 + g, T0 + 2 * g, 1)], key=repr)
