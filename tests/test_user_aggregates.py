import collections
import math
import pickle
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.aggregates import TopCounts, Variance, merge_runs, partials, user_agg, user_window_agg

from tests.conftest import rows

# The tests' own classes travel by value, as those of a script do.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Longest:
    """Immutable accumulators; the methods that the table form needs are absent."""

    def create_accumulator(self):
        return ""

    def accumulate(self, acc, word, other):
        return max(acc, f"{word}{other}", key=lambda w: (len(w), w))

    def merge(self, acc, others):
        return max([acc, *others], key=lambda w: (len(w), w))

    def get_value(self, acc):
        return acc


class Counted(TopCounts):
    """Tells how many accumulators each merge took in."""

    def merge(self, acc, others):
        others = list(others)
        acc[("merged", len(others))] = acc.get(("merged", len(others)), 0) + 1
        super().merge(acc, others)

    def emit_value(self, acc):
        return [(k[1], v) for k, v in acc.items() if isinstance(k, tuple)]


def _rows(n=400, seed=1):
    rng = random.Random(seed)
    keys = ["a", "b", None, "hot", "hot", "hot"]
    return [(rng.choice(keys), rng.choice([0.0, -0.0, 1.5, math.nan, None]), rng.choice(["x", "y", "é", None, 'q"t']), i / 7) for i in range(n)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(_rows(), "k string, d double, name string, v double").repartition(6)


def test_top_counts_of_groups_match_python(frame):
    want = collections.defaultdict(collections.Counter)
    for k, _, name, _ in _rows():
        want[k][name] += 1
    agg = TopCounts(2)
    for salts in (1, 5):
        got = {r["k"]: r["value"] for r in user_agg(frame, ["k"], ["name"], agg, "string", salts=salts).collect()}
        assert got == {k: agg.get_value(dict(c)) for k, c in want.items()}


def test_floating_keys_nan_zero_and_two_arguments(spark, frame):
    """NaN is one group, 0.0 and -0.0 are one, NULL is one; accumulators need not be changed in place."""
    out = user_agg(frame, ["d", "k"], ["name", "v"], Longest(), "string", "w")
    want = {}
    for k, d, name, v in _rows():
        at = ("nan" if d is not None and math.isnan(d) else d and abs(d) or d, k)
        at = (0.0 if at[0] == 0 and d is not None else at[0], k)
        want[at] = max(want.get(at, ""), f"{name}{v}", key=lambda w: (len(w), w))
    got = {("nan" if r["d"] is not None and math.isnan(r["d"]) else r["d"], r["k"]): r["w"] for r in out.collect()}
    assert got == want


def test_variance_without_keys_and_of_an_empty_table(frame):
    v = [r[3] for r in _rows()]
    mean = sum(v) / len(v)
    assert user_agg(frame, [], ["v"], Variance(), "double").first()["value"] == pytest.approx(sum((x - mean) ** 2 for x in v) / len(v))
    assert user_agg(frame.limit(0), ["k"], ["v"], Variance(), "double").count() == 0


def test_a_hot_key_ships_one_accumulator_a_task(spark):
    """Whatever the rows, the shuffle carries tasks x groups accumulators, merged a bounded number at a time."""
    df = spark.range(0, 60_000, 1, 12).select(F.lit("hot").alias("k"), (F.col("id") % 3).alias("name"))
    parts = partials(df, ["k"], ["name"], TopCounts(3))
    assert parts.count() == 12
    assert sum(sum(pickle.loads(r["_acc"]).values()) for r in parts.collect()) == 60_000


def test_merges_are_called_in_bounded_steps(spark, monkeypatch):
    from eventide.operators import aggregates

    monkeypatch.setattr(aggregates, "MERGED_AT_ONCE", 4)
    df = spark.range(0, 900, 1, 30).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("name"))
    counted = merge_runs(partials(df, ["k"], ["name"], Counted(1)), ["k"], Counted(1), Counted(1).emit_value,
                         T.DataType.fromDDL("array<struct<size:int,times:int>>"))
    sizes = {r["size"]: r["times"] for r in counted.first()["_acc"]}
    assert max(sizes) == 4 and sum(s * t for s, t in sizes.items()) == 30


def test_groups_beyond_the_bound_are_handed_on(frame):
    few = partials(frame, ["k", "name"], ["v"], Variance(), held=2)
    many = partials(frame, ["k", "name"], ["v"], Variance())
    assert few.count() > many.count()
    counts = [rows(merge_runs(p, ["k", "name"], Variance(), lambda acc: acc[0], T.LongType())) for p in (few, many)]
    assert counts[0] == counts[1] and sum(r[2] for r in counts[0]) == 400


def test_windows_share_panes(spark):
    """Sliding and tumbling windows against the built-in count; a row without a time counts nowhere."""
    df = spark.range(500).select(F.timestamp_seconds(F.col("id") * 7 % 900).cast("timestamp_ntz").alias("t"), (F.col("id") % 3).cast("string").alias("k"),
                                 (F.col("id") % 5).alias("name")).unionByName(
        spark.createDataFrame([(None, "0", 1)], "t timestamp_ntz, k string, name long"))
    for size, slide in (("60 seconds", "20 seconds"), ("60 seconds", "60 seconds")):
        out = user_window_agg(df, "t", size, slide, ["k"], ["name"], TopCounts(9), "string")
        got = rows(out.select("start_time", "end_time", "k", F.expr("aggregate(map_values(from_json(value, 'map<string,int>')), 0, (a, b) -> a + b)").alias("n")))
        want = df.groupBy(F.window("t", size, slide).alias("w"), "k").agg(F.count("name").cast("int").alias("n"))
        assert got == rows(want.select(F.col("w.start").alias("start_time"), F.col("w.end").alias("end_time"), "k", "n"))
    with pytest.raises(ValueError):
        user_window_agg(df, "t", "50 seconds", "20 seconds", ["k"], ["name"], TopCounts(9), "string")
