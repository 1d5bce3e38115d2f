import collections
import datetime as dt
import os
import sys
import tempfile
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from eventide.operators.aggregates import TopCounts
from eventide.sources.files import parquet_dir
from eventide.streaming import late as lt
from eventide.streaming import runtime as rt
from eventide.streaming.stateful import EXPIRY_CONF, latest, stateful_windows, table_aggregate

from tests.conftest import rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp_ntz, sex string, name string"


class Total:
    """A table aggregate that knows nothing of leading items: all entries are read to emit."""

    def create_accumulator(self):
        return {}

    def accumulate(self, acc, name):
        acc[name] = acc.get(name, 0) + 1

    def merge(self, acc, others):
        for o in others:
            for k, v in o.items():
                acc[k] = acc.get(k, 0) + v

    def emit_value(self, acc):
        if acc:
            yield len(acc), sum(acc.values())


class Source:
    """A folder that gets one micro-batch of (second, sex, name) after the other."""

    def __init__(self, spark):
        self.spark, self.path, self.n = spark, tempfile.mkdtemp(prefix="eventide-stateful-"), 0

    def add(self, batch):
        at = [(s if s is None else T0 + dt.timedelta(seconds=s), x, n) for s, x, n in batch]
        path = f"{self.path}/b{self.n}"
        self.spark.createDataFrame(at, SCHEMA).coalesce(1).write.parquet(path)
        for f in os.listdir(path):  # the file source reads in order of modification
            t = time.time() - 10_000 + 10 * self.n
            os.utime(f"{path}/{f}", (t, t))
        self.n += 1
        return self

    def stream(self):
        return parquet_dir(self.spark, f"{self.path}/*", SCHEMA, stream=True, max_files_per_trigger=1)


def _windows(counted, size, slide, until, n):
    """Top n per window of (second, sex, name), for windows that end by ``until``."""
    held = collections.defaultdict(collections.Counter)
    for s, x, name in counted:
        for start in range(int(s // slide * slide - size + slide), int(s // slide * slide) + 1, slide):
            if start + size <= until:
                held[start, x][name] += 1
    top = TopCounts(n)
    at = lambda s: T0 + dt.timedelta(seconds=s)
    return sorted(((at(s), at(s + size), x, name, c) for (s, x), k in held.items() for name, c in top.emit_value(dict(k))), key=repr)


def test_windows_fire_on_the_watermark_and_restart(spark):
    """Micro-batches with pauses longer than a stretch of state, several groups, a row without a time, and a restart."""
    batches = [[(1, "m", "a"), (1.5, "m", "b"), (8, "f", "a"), (None, "m", "z"), (12, "m", "b")], [(13, None, None), (31, "m", "a")],
               [(29, "m", "c"), (900, "f", "c")], [(905, "f", "c"), (906, "m", None), (2000, "m", "a")]]
    source, path = Source(spark), tempfile.mkdtemp(prefix="eventide-fire-")
    out = lambda: stateful_windows(source.stream(), "10 seconds", "2 seconds", ["sex"], ["name"], TopCounts(2), "name string, cnt long")
    for b in batches[:2]:
        source.add(b)
    first = rows(rt.run_to_table(out(), "w", path=path))
    counted = [r for b in batches[:2] for r in b if r[0] is not None]
    assert first == _windows(counted, 10, 2, 26, 2)
    for b in batches[2:]:
        source.add(b)
    counted += [r for b in batches[2:] for r in b]
    assert rows(rt.run_to_table(out(), "w", path=path)) == _windows(counted, 10, 2, 1995, 2)


def test_late_rows_count_only_in_windows_still_open(spark):
    """At watermark 95 s: a row at 91 s counts in windows that end later, one at 80 s in none; the
    split by windows names exactly the second as late."""
    source = Source(spark).add([(100, "m", "a")]).add([(91, "m", "late"), (80, "m", "gone"), (104, "m", "a")]).add([(300, "m", "x")])
    got = rows(rt.run_to_table(stateful_windows(source.stream(), "10 seconds", "5 seconds", ["sex"], ["name"], TopCounts(3),
                                                "name string, cnt long"), "w"))
    of = lambda name: [((r[0] - T0).total_seconds(), r[4]) for r in got if r[3] == name]
    assert of("gone") == [] and of("late") == [(90.0, 1)]
    assert of("a") == [(95.0, 2), (100.0, 2)]
    split = lt.run_split_late(source.stream(), size="10 seconds", slide="5 seconds")
    assert [r["name"] for r in split.where("late").collect()] == ["gone"]


def test_one_value_per_window_and_state_rows(spark):
    """JSON text per window; the state holds a row per pane, not per window and name, and is empty at the end."""
    source = Source(spark).add([(i / 4, "m", str(i % 3)) for i in range(80)])
    out = stateful_windows(source.stream(), "8 seconds", "1 second", ["sex"], ["name"], TopCounts(3), "top string")
    q, path = rt.start_to_table(out, "w")
    rt.wait(q)
    states = [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
    assert states is not None
    got = rt.read_table(spark, path, out.schema)
    assert {r["top"] for r in got.where("start_time >= '2024-01-01' AND end_time <= '2024-01-01 00:00:14'").collect()} <= {
        '{"0":11,"1":11,"2":10}', '{"0":11,"2":11,"1":10}', '{"1":11,"2":11,"0":10}'}
    assert got.where(f"end_time > timestamp_ntz'{T0 + dt.timedelta(seconds=14)}'").count() == 0
    with pytest.raises(ValueError):
        stateful_windows(source.stream(), "9 seconds", "2 seconds", ["sex"], ["name"], TopCounts(3), "top string")


def _run(source, agg, result, path, **options):
    out = table_aggregate(source.stream(), ["sex"], ["name"], agg, result, **options)
    opts = rt.StreamOptions(conf=EXPIRY_CONF) if "ttl" in options else None
    return rt.run_to_table(out, "t", path=path, opts=opts)


def test_table_aggregate_emits_changed_groups_and_restarts(spark):
    result, path = "name string, cnt long", tempfile.mkdtemp(prefix="eventide-table-")
    source = Source(spark).add([(0, "m", "a"), (0, "m", "b"), (0, "m", "a"), (0, None, "q")]).add([(0, "f", "x")])
    first = _run(source, TopCounts(1), result, path)
    assert rows(first.select("sex", "version", "position", "name", "cnt")) == sorted(
        [("m", 1, 1, "a", 2), (None, 1, 1, "q", 1), ("f", 1, 1, "x", 1)], key=repr)
    source.add([(0, "m", "b")]).add([(0, "m", "b"), (0, "f", None)]).add([(0, "f", None)])
    out = _run(source, TopCounts(1), result, path)  # b draws level (a stays), then leads; the others stay as they are
    assert rows(out.where("version > 1").select("sex", "version", "name", "cnt")) == sorted(
        [("m", 2, "b", 3), ("f", 2, None, 1), ("f", 3, None, 2)], key=repr)
    assert rows(latest(out, ["sex"], TopCounts(1), result)) == sorted([("m", "b", 3), (None, "q", 1), ("f", None, 2)], key=repr)


def test_parts_of_a_hot_group_join(spark):
    names = [str(i * i % 23) for i in range(300)]
    source = Source(spark).add([(0, "m", n) for n in names[:150]]).add([(0, "m", n) for n in names[150:]])
    out = _run(source, TopCounts(4), "name string, cnt long", tempfile.mkdtemp(), parts=5)
    assert 1 < out.select("_part").distinct().count() <= 5
    want = TopCounts(4).emit_value(dict(collections.Counter(names)))
    assert rows(latest(out, ["sex"], TopCounts(4), "name string, cnt long")) == sorted([("m", *w) for w in want], key=repr)


def test_whole_accumulators_and_expiry(spark):
    """Entries expire after their time to live; what is left is emitted, and an emptied group, too."""
    path, result = tempfile.mkdtemp(prefix="eventide-ttl-"), "names int, rows int"
    source = Source(spark).add([(0, "m", "a"), (0, "m", "b"), (0, "m", "a"), (0, "f", "x")])
    first = _run(source, Total(), result, path, ttl="8 seconds")
    assert rows(first.select("sex", "version", "names", "rows")) == [("f", 1, 1, 1), ("m", 1, 2, 3)]
    time.sleep(9)
    source.add([(0, "m", "b")])
    out = _run(source, Total(), result, path, ttl="8 seconds")
    last = latest(out, ["sex"], Total(), result)
    assert rows(last.where("sex = 'm'")) == [("m", 1, 1)]
    # the timer of the group without new rows fires in the same micro-batch
    assert rows(out.where("sex = 'f' AND version = 2").select("position", "names")) == [(0, None)]


def test_split_keeps_every_row_once_and_replays(spark):
    source = Source(spark).add([(10, "m", "a"), (None, "m", "n")]).add([(4.9, "m", "l1"), (5, "m", "k"), (30, "m", "a")])
    path = tempfile.mkdtemp(prefix="eventide-late-")
    out = lt.run_split_late(source.stream(), path=path)
    assert rows(out, "name", "late") == [("a", False), ("a", False), ("k", False), ("l1", True), ("n", False)]
    source.add([(None, "m", "n2")]).add([(24, "m", "l2"), (26, "m", "k2")])
    out = lt.run_split_late(source.stream(), path=path)
    want = sorted([("a", False), ("a", False), ("k", False), ("l1", True), ("n", False), ("n2", False), ("l2", True), ("k2", False)])
    assert rows(out, "name", "late") == want
    schema = source.stream().schema
    assert rows(lt.read_split(spark, path, schema, late=True), "name") == [("l1",), ("l2",)]
    # a batch replayed after its outputs were published is written again, by the watermark it had
    assert lt.watermark_before(spark, f"{path}/data", 1) == lt.watermark_before(spark, f"{path}/data", 2) - 20_000_000
    last = max(int(f) for f in os.listdir(f"{path}/_checkpoint/commits") if f.isdigit())
    os.rename(f"{path}/_checkpoint/commits/{last}", f"{path}/_checkpoint/replayed")
    crc = f"{path}/_checkpoint/commits/.{last}.crc"
    if os.path.exists(crc):
        os.rename(crc, f"{path}/_checkpoint/replayed.crc")
    assert rows(lt.run_split_late(source.stream(), path=path), "name", "late") == want
    assert lt.read_split(spark, tempfile.mkdtemp(), schema).count() == 0
