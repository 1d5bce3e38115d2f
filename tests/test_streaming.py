import datetime as dt
import json
import os
import tempfile
import time

from eventide.functions import schemas
from eventide.operators import count_
from eventide.sources import decode_json, json_value_files, parquet_dir
from eventide.streaming import jobs as sjobs
from eventide.streaming import runtime as rt
from eventide.streaming.runtime import StreamOptions
from tests.conftest import requires_testdata, rows

T0 = dt.datetime(2024, 1, 1)


def _write_batches(batches):
    """One text file of JSON messages per micro-batch, with increasing mtimes."""
    d = tempfile.mkdtemp(prefix="eventide-stream-")
    now = time.time() - 1000
    for i, batch in enumerate(batches):
        p = os.path.join(d, f"b{i:03d}.json")
        with open(p, "w") as f:
            for sec, cluster in batch:
                f.write(json.dumps({"cluster_name": cluster, "host_ip": "10.0.0.1", "cpu_usage": 1.5,
                                    "ts": (T0 + dt.timedelta(seconds=sec)).strftime("%Y-%m-%d %H:%M:%S")}) + "\n")
            f.write("not json\n")
        os.utime(p, (now + i, now + i))
    return d


def _cpu_stream(spark, d):
    return decode_json(json_value_files(spark, d, stream=True, max_files_per_trigger=1), schemas.CPU_USAGE)


def test_late_rows_over_micro_batches(spark):
    """Spark filters late rows by the watermark of the batch before last and
    evicts by the previous batch's.  W0 = 25 - 5 = 20 s after batch 0:
    ts=3 s in batch 1 is still counted (the late filter there uses 0);
    ts=2 s in batch 2 is dropped (late filter uses W0 = 20 s)."""
    d = _write_batches([[(1, "c"), (12, "c"), (25, "c")], [(3, "c"), (31, "c")], [(2, "c"), (45, "c")],
                        [(58, "c")], [(70, "c")]])
    out = sjobs.run_window_agg(_cpu_stream(spark, d), "tumble", ["cluster_name"], [count_("cnt")], "10 seconds")
    got = rows(out, "start_time", "cnt")
    assert got == [(T0, 2)] + [(T0 + dt.timedelta(seconds=s), 1) for s in (10, 20, 30, 40, 50)]


def test_stream_session_and_restart(spark):
    d = _write_batches([[(0, "c"), (200, "c")], [(600, "c")], [(1000, "c"), (1290, "c")]])
    path = tempfile.mkdtemp(prefix="eventide-restart-")
    out = sjobs.run_window_agg(_cpu_stream(spark, d), "session", ["cluster_name"], [count_("cnt")], "5 minutes",
                               path=path)
    first = rows(out, "start_time", "end_time", "cnt")
    assert first == [(T0, T0 + dt.timedelta(seconds=500), 2), (T0 + dt.timedelta(seconds=600), T0 + dt.timedelta(seconds=900), 1)]
    # more input arrives; the same checkpoint resumes and closes the open session
    now = time.time()
    with open(os.path.join(d, "b900.json"), "w") as f:
        f.write(json.dumps({"cluster_name": "c", "cpu_usage": 1.0, "ts": "2024-01-01 02:00:00"}) + "\n")
    os.utime(os.path.join(d, "b900.json"), (now, now))
    out = sjobs.run_window_agg(_cpu_stream(spark, d), "session", ["cluster_name"], [count_("cnt")], "5 minutes",
                               path=path)
    assert (T0 + dt.timedelta(seconds=1000), T0 + dt.timedelta(seconds=1590), 2) in rows(out, "start_time", "end_time", "cnt")


def test_stream_topn_and_running_topn(spark):
    d = tempfile.mkdtemp(prefix="eventide-clicks-")
    now = time.time() - 100
    batches = [[("a", 1), ("a", 2), ("b", 3)], [("b", 4), ("b", 5), ("c", 6)], [("c", 70), ("c", 71), ("c", 72)], [("z", 200)]]
    for i, b in enumerate(batches):
        p = os.path.join(d, f"b{i}.json")
        with open(p, "w") as f:
            for name, sec in b:
                f.write(json.dumps({"name": name, "sex": "m", "action": "click", "is_delete": 0,
                                    "ts": (T0 + dt.timedelta(seconds=sec)).strftime("%Y-%m-%d %H:%M:%S")}) + "\n")
        os.utime(p, (now + i, now + i))
    stream = lambda: decode_json(json_value_files(spark, d, stream=True, max_files_per_trigger=1), schemas.USER_ACTION)
    top = sjobs.run_window_topn(stream(), "1 minute", "1 minute", ["sex"], "name", 1)
    assert rows(top, "start_time", "name", "cnt") == [(T0, "b", 3), (T0 + dt.timedelta(minutes=1), "c", 3)]
    run = sjobs.run_running_topn(stream(), "sex", "name", 2)
    assert rows(run, "name", "cnt") == [("b", 3), ("c", 4)]


@requires_testdata
def test_multi_batch_streams_equal_single_batch(spark):
    """Four ts-ordered micro-batches give what one batch gives (no row is late)."""
    from eventide.operators import live_clicks
    from eventide.operators.timeutil import with_event_time
    from eventide.plans import adapters, catalog
    from eventide.sources.files import parquet_dir

    sf = "/root/testdata/sf0.001"
    base = tempfile.mkdtemp(prefix="eventide-mb-")
    schema = catalog._write_quarters(spark, sf, f"{base}/src")
    stream = lambda: parquet_dir(spark, f"{base}/src/*", schema, stream=True, max_files_per_trigger=1)
    cpu = lambda: with_event_time(adapters.cpu_usage(stream()))
    clicks = lambda: live_clicks(with_event_time(adapters.user_actions(stream())))
    one = {k: catalog.queries()[k](spark, sf) for k in ("stream_cpu_sliding", "stream_cpu_session",
                                                        "stream_sex_topn", "stream_running_topn")}
    many = {
        "stream_cpu_sliding": sjobs.run_window_agg(cpu(), "hop", ["cluster_name"], [count_("cnt")], "10 minutes",
                                                   "60 seconds"),
        "stream_cpu_session": sjobs.run_window_agg(cpu(), "session", ["cluster_name"], [count_("cnt")], "5 minutes"),
        "stream_sex_topn": sjobs.run_window_topn(clicks(), "1 day", "1 hour", ["sex"], "name", 5),
        "stream_running_topn": sjobs.run_running_topn(with_event_time(adapters.user_actions(stream())), "sex",
                                                      "name", 10),
    }
    for k in one:
        cols = sorted(one[k].columns)
        assert rows(one[k].select(cols)) == rows(many[k].select(cols)), k


def test_same_job_functions_on_streams(spark):
    import pytest as _pytest

    from eventide.operators import running_topn
    from eventide.operators.timeutil import with_event_time
    from eventide.plans import jobs

    d = _write_batches([[(0, "c"), (200, "c")], [(900, "c")]])
    cpu = with_event_time(decode_json(json_value_files(spark, d, stream=True), schemas.CPU_USAGE))
    out = jobs.cpu_session(cpu)          # batch default (buckets) switches to the stream plan
    assert out.isStreaming
    with _pytest.raises(ValueError, match="foreachBatch"):
        running_topn(cpu, "cluster_name", "host_ip", 3)


def test_out_of_order_within_bound_is_kept(spark):
    # 12 s arrives after 15 s but within the 5 s bound: counted in [10, 20)
    d = _write_batches([[(1, "c"), (15, "c")], [(12, "c"), (14, "c")], [(40, "c")]])
    out = sjobs.run_window_agg(_cpu_stream(spark, d), "tumble", ["cluster_name"], [count_("cnt")], "10 seconds")
    assert rows(out, "start_time", "cnt") == [(T0, 1), (T0 + dt.timedelta(seconds=10), 3)]


def test_versioned_fold_keeps_recent_versions(spark):
    from eventide.streaming.runtime import committed_versions, read_version, versioned_fold

    path = tempfile.mkdtemp(prefix="eventide-vf-") + "/t"
    step = lambda prev, b: b if prev is None else prev.unionByName(b)
    fn = versioned_fold(path, step)
    for i in range(5):
        fn(spark.createDataFrame([(i,)], "x int"), i)
    fn(spark.createDataFrame([(4,)], "x int"), 4)   # replay of the last batch
    assert committed_versions(spark, path) == [3, 4]
    assert sorted(r.x for r in read_version(spark, path).collect()) == [0, 1, 2, 3, 4]


@requires_testdata
def test_stream_panes_equal_direct(spark):
    """Pane pre-aggregation chains two stateful aggregations (linked by window_time)."""
    from eventide.operators import max_
    from eventide.operators.timeutil import with_event_time
    from eventide.plans import adapters, catalog

    res = {}
    for st in ("direct", "panes"):
        s = with_event_time(adapters.cpu_usage(catalog._t(spark, "/root/testdata/sf0.001", "events", stream=True)))
        res[st] = sjobs.run_window_agg(s, "hop", ["cluster_name"], [count_("cnt"), max_("cpu_usage", "mx")],
                                       "10 minutes", "1 minute", strategy=st)
    assert res["direct"].count() > 0
    assert rows(res["direct"]) == rows(res["panes"].select(res["direct"].columns))


def test_running_topn_changelog(spark):
    d = tempfile.mkdtemp(prefix="eventide-rchg-")
    now = time.time() - 100
    for i, b in enumerate([["a", "b"], ["b", "b"], ["c", "c", "c", "c"]]):
        p = os.path.join(d, f"b{i}.json")
        with open(p, "w") as f:
            for name in b:
                f.write(json.dumps({"name": name, "sex": "m", "action": "click", "is_delete": 0,
                                    "ts": "2024-01-01 00:00:01"}) + "\n")
        os.utime(p, (now + i, now + i))
    path = tempfile.mkdtemp(prefix="eventide-rchg-out-")
    stream = decode_json(json_value_files(spark, d, stream=True, max_files_per_trigger=1), schemas.USER_ACTION)
    top = sjobs.run_running_topn(stream, "sex", "name", 1, path=path, changelog=True)
    assert rows(top, "name", "cnt") == [("c", 4)]
    ch = spark.read.parquet(f"{path}/changes")
    got = sorted((r["batch_id"], r["op"], r["name"], r["cnt"]) for r in ch.collect())
    assert got == [(0, "+", "a", 1), (1, "+", "b", 3), (1, "-", "a", 1), (2, "+", "c", 4), (2, "-", "b", 3)]


def _clicks(spark, tmp_path, n_files=3):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    for i in range(n_files):
        rows_ = [(f"u{j % 3}", "m" if j % 2 else "f", "click", 0, t0 + dt.timedelta(minutes=10 * i + j)) for j in range(8)]
        spark.createDataFrame(rows_, schemas.USER_ACTION).coalesce(1).write.parquet(f"{tmp_path}/in/f{i}")
    schema = spark.read.parquet(f"{tmp_path}/in/f0").schema
    return lambda: parquet_dir(spark, f"{tmp_path}/in/*", schema, stream=True, max_files_per_trigger=1)


def test_two_sinks_run_side_by_side_on_an_interval_and_resume(spark, tmp_path):

    source = _clicks(spark, tmp_path)
    opts = rt.StreamOptions(trigger="1 second", checkpoint=f"{tmp_path}/ck")
    before = repr(opts)
    for attempt in range(2):
        counts, top = sjobs.start_click_rank(source(), f"{tmp_path}/out", n=1, size="10 minutes", slide="10 minutes", opts=opts)
        try:
            for q, _, _ in (counts, top):
                q.processAllAvailable()
            assert counts[0].isActive and top[0].isActive
        finally:
            counts[0].stop(), top[0].stop()
        a = rt.read_table(spark, counts[1], counts[2]).count()
        b = rt.read_batches(spark, f"{top[1]}/data", top[2]).count()
        assert a == 4 and b == 4, (attempt, a, b)  # two closed windows, two groups each, once
    assert repr(opts) == before
    assert {"sex_count", "sex_topn"} <= set(os.listdir(f"{tmp_path}/ck"))


def test_options_are_kept_as_given_and_checkpoints_honoured(spark, tmp_path):
    source = _clicks(spark, tmp_path)
    opts = rt.StreamOptions(checkpoint=f"{tmp_path}/ck1")
    first = rows(sjobs.run_running_topn(source(), "sex", "name", 2, opts, f"{tmp_path}/top"))
    assert opts == rt.StreamOptions(checkpoint=f"{tmp_path}/ck1") and os.path.exists(f"{tmp_path}/ck1/metadata")
    out = sjobs.run_window_agg(source(), "tumble", ["sex"], [sjobs.count_("cnt")], "10 minutes",
                               opts=rt.StreamOptions(checkpoint=f"{tmp_path}/ck2"), path=f"{tmp_path}/agg")
    assert out.count() == 4 and os.path.exists(f"{tmp_path}/ck2/metadata")
    assert first == rows(sjobs.run_running_topn(source(), "sex", "name", 2, opts, f"{tmp_path}/top"))


def test_versions_do_not_depend_on_the_committers_marker(spark, tmp_path):
    source = _clicks(spark, tmp_path)
    want = rows(sjobs.run_running_topn(source(), "sex", "name", 2, path=f"{tmp_path}/a"))
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        assert rows(sjobs.run_running_topn(source(), "sex", "name", 2, path=f"{tmp_path}/b")) == want and want
    finally:
        hadoop.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_unpublished_batches_are_not_read_and_batches_compact(spark, tmp_path):
    path = f"{tmp_path}/batches"
    for i in range(4):
        rt.publish(spark.range(i, i + 2), path, f"batch_id={i}")
    spark.range(100).write.parquet(f"{path}/batch_id=9")  # a write that never finished
    want = rows(rt.read_batches(spark, path))
    assert len(want) == 8
    assert rt.compact_batches(spark, path, upto=2) == 2
    assert rt.committed(spark, path, "batch_id") == [2, 3] and rows(rt.read_batches(spark, path)) == want
    assert rt.compact_batches(spark, path) == 3 and rows(rt.read_batches(spark, path)) == want
