"""Scale properties of the registered batch plans (checked on the planned tree)."""

import re

import pytest

import __spark_entry__ as se
from eventide.plans import catalog
from tests.conftest import requires_testdata

pytestmark = requires_testdata

SF = "/root/testdata/sf0.001"
BATCH = [k for k in catalog.queries() if not k.startswith(("stream_", "cdc_stream", "cdc_jdbc", "jdbc_"))]


def _plan(spark, name):
    df = se.queries()[name](spark, SF)
    qe = df._jdf.queryExecution()
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return qe.executedPlan().treeString(), qe.explainString(mode)


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_or_single_partition(spark, name):
    tree, _ = _plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert bad not in tree, (name, bad)


@pytest.mark.parametrize("name", ["wordcount", "wordcount_tokens", "cpu_tumbling", "cpu_sliding_direct",
                                  "sex_count", "running_topn", "cdc_snapshot"])
def test_partial_aggregate_before_shuffle(spark, name):
    tree, _ = _plan(spark, name)
    lines = tree.splitlines()
    first_exchange = max(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    below = "\n".join(lines[first_exchange:])
    assert re.search(r"partial_(count|max|min|sum|avg)", below), name


@pytest.mark.parametrize("name", ["sex_topn", "sex_top_json", "running_topn"])
def test_topn_limits_on_both_sides_of_the_shuffle(spark, name):
    tree, _ = _plan(spark, name)
    assert "WindowGroupLimit" in tree and ", Partial" in tree and ", Final" in tree, name


@pytest.mark.parametrize("name,cols", [("wordcount", "struct<event_type:string>"),
                                       ("cpu_tumbling", "struct<ts:timestamp_ntz,event_type:string,value:double>"),
                                       ("hash_code", "struct<o_orderkey:bigint,o_orderstatus:string>")])
def test_scan_reads_only_needed_columns(spark, name, cols):
    _, formatted = _plan(spark, name)
    assert f"ReadSchema: {cols}" in formatted, name


@pytest.mark.parametrize("name", ["hash_code", "hash_code_sql", "lateral_left", "json_decode", "cpu_session"])
def test_native_paths_stay_in_the_jvm(spark, name):
    tree, _ = _plan(spark, name)
    assert "EvalPython" not in tree and "FlatMapGroupsInPandas" not in tree, name


def test_sessions_read_their_input_once(spark):
    df = se.queries()["cpu_session"](spark, SF)
    df.collect()
    tree = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in tree and tree.count("FileScan") - tree.count("ReusedExchange") <= 2, tree
    final = tree.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1, final


def test_building_a_plan_starts_no_job_and_follows_arguments(spark):
    from eventide.operators.timeutil import spread

    grouped = spark.range(1000).groupBy("id").count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "plan-only")
    try:
        assert spread(grouped) is grouped
        assert "RoundRobinPartitioning(7)" in spread(grouped, 7)._jdf.queryExecution().toString()
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert not tracker.getJobIdsForGroup("plan-only")


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    from eventide.session import checkpoint_root

    class Context:
        master = "spark://host:7077"
        getConf = lambda self: {}
        getCheckpointDir = lambda self: None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_event_time_without_a_zone_needs_utc(spark):
    from eventide.operators.timeutil import with_event_time

    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError, match="UTC"):
            with_event_time(df)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
