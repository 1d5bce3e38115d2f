"""Top-N over sliding windows: rows are dealt out once, and expanded into windows after that."""

import collections
import datetime as dt
import json
import random

import pytest

from eventide.operators import topn_json, window_topn
from tests.conftest import rows

T0 = dt.datetime(1969, 12, 31, 23, 58)  # panes on both sides of the epoch


def _events(seed, n=300, span=400):
    r = random.Random(seed)
    out = [(r.choice(["a", "b", "c", "d", None]), r.choice(["m", "f", None]), T0 + dt.timedelta(seconds=r.randrange(span * 4) / 4))
           for _ in range(n)]
    return out + [("a", "m", None)] + [("a", "m", T0 + dt.timedelta(seconds=s)) for s in (0, 30, 60, 90, 1000)] * 2


def _expected(events, size, slide, n):
    held = collections.defaultdict(collections.Counter)
    epoch = dt.datetime(1970, 1, 1)
    for name, sex, ts in events:
        if ts is not None:
            t = (ts - epoch).total_seconds()
            start = t // slide * slide
            while start > t - size:
                held[start, sex][name] += 1
                start -= slide
    at = lambda s: epoch + dt.timedelta(seconds=s)
    order = lambda e: (-e[1], e[0] is not None, e[0] or "")
    return sorted(((at(s), at(s + size), sex, name, c) for (s, sex), k in held.items()
                   for name, c in sorted(k.items(), key=order)[:n]), key=repr)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("strategy,size,slide", [("direct", 60, 1), ("panes", 60, 1), ("panes", 30, 10), ("direct", 20, 10),
                                                 ("direct", 25, 10), ("direct", 10, 10)])
def test_every_window_has_its_counts(spark, kind, strategy, size, slide):
    events = _events(size + slide)
    utc = lambda t: t if t is None or kind == "timestamp_ntz" else t.replace(tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(a, b, utc(t)) for a, b, t in events], f"name string, sex string, ts {kind}").repartition(3)
    top = window_topn(df, "ts", f"{size} seconds", f"{slide} seconds", ["sex"], "name", 2, strategy)
    assert top.schema["start_time"].dataType == df.schema["ts"].dataType
    cols = [c if c not in ("start_time", "end_time") else f"cast({c} as timestamp_ntz) {c}" for c in top.columns]
    want = _expected(events, size, slide, 2)
    assert rows(top.selectExpr(*cols)) == want
    texts = topn_json(df, "ts", f"{size} seconds", f"{slide} seconds", "sex", "name", 2, strategy=strategy)
    assert texts.columns == ["sex", "top10", "start_time", "end_time"]
    got = collections.Counter(len(json.loads(r["top10"])) for r in texts.collect())
    assert sum(k * v for k, v in got.items()) == len(want) and sum(got.values()) == len({w[:3] for w in want})


def test_rows_are_shuffled_not_windows(spark):
    """Rows are dealt out before they become windows; a second exchange has the leading items only."""
    df = spark.createDataFrame(_events(1), "name string, sex string, ts timestamp_ntz")
    for out in (window_topn(df, "ts", "60 seconds", "1 second", ["sex"], "name", 2),
                topn_json(df, "ts", "1 day", "1 hour", "sex", "name", 2)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and "Expand" not in plan
        dealt = plan.index("REPARTITION_BY_NUM")
        assert plan.index("Final") < plan.index("ENSURE_REQUIREMENTS") < plan.index("Partial") < plan.index("Generate explode(sequence(_s") < dealt
