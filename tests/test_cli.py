import datetime as dt
import json
import os
import tempfile

from eventide.__main__ import main

T0 = dt.datetime(2024, 1, 1)


def test_cli_wordcount_and_click_top_json(spark, tmp_path):
    (tmp_path / "w.csv").write_text("1,a\n2,b\n3,a\n")
    main(["wordcount", "--input", str(tmp_path / "w.csv"), "--output", str(tmp_path / "wc")])
    got = sorted(tuple(r) for r in spark.read.schema("word string, cnt bigint").csv(str(tmp_path / "wc")).collect())
    assert got == [("a", 2), ("b", 1)]
    d = tmp_path / "msgs"
    d.mkdir()
    with open(d / "m.json", "w") as f:
        for name, sec in [("x", 1), ("y", 2), ("x", 3), ("z", 200)]:
            f.write(json.dumps({"name": name, "sex": "m", "action": "click", "is_delete": 0,
                                "ts": (T0 + dt.timedelta(seconds=sec)).strftime("%Y-%m-%d %H:%M:%S")}) + "\n")
    main(["click-top-json", "--json-dir", str(d), "--output", str(tmp_path / "tj"), "--n", "1"])
    out = spark.read.parquet(str(tmp_path / "tj" / "data")).where("start_time = '2024-01-01 00:00:01'").first()
    assert out["top10"] == '{"x":2}'


def test_cli_jdbc_udtf_udf_cdc(spark, tmp_path):
    import uuid

    from eventide.functions import schemas
    from eventide.sinks import jdbc_execute, jdbc_write
    from eventide.sources import jdbc_table

    url, props = "jdbc:derby:memory:eventide_cli;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    src, dst = f"w_{uuid.uuid4().hex[:6]}", f"wc_{uuid.uuid4().hex[:6]}"
    jdbc_write(spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], schemas.WORDS_JDBC), url, src, "overwrite", props)
    jdbc_execute(spark, url, [f'CREATE TABLE {dst} ("word" VARCHAR(64) NOT NULL PRIMARY KEY, "cnt" BIGINT)'], props)
    main(["jdbc-wordcount", "--url", url, "--source", src, "--sink", dst, "--driver", props["driver"],
          "--word-type", "VARCHAR(64)"])
    assert sorted(tuple(r) for r in jdbc_table(spark, url, dst, properties=props).collect()) == [("a", 2), ("b", 1)]

    (tmp_path / "in.csv").write_text('k1,"[{""bs3_name"": ""n"", ""bs3_name_id"": 1, ""bs1_name_id"": 2, '
                                     '""bs2_name_id"": 3, ""bs2_name"": ""x"", ""bs1_name"": ""y""}]"\nk2,\n')
    main(["udtf", "--input", str(tmp_path / "in.csv"), "--outer", "--output", str(tmp_path / "udtf")])
    assert spark.read.parquet(str(tmp_path / "udtf" / "result")).count() == 2
    (tmp_path / "w.csv").write_text("1,a\n-1,b\n")
    main(["udf", "--input", str(tmp_path / "w.csv"), "--output", str(tmp_path / "udf")])
    got = {r["id"]: r["hash_id"] for r in spark.read.parquet(str(tmp_path / "udf" / "result")).collect()}
    assert got == {1: 12, -1: -24}

    changes = spark.createDataFrame([("c", 1, None, (1, "a")), ("c", 2, None, (2, "b")), ("d", 3, (2, None), None)],
                                    schemas.CHANGE_RECORD)
    changes.write.parquet(str(tmp_path / "changes" / "b0"))
    main(["cdc", "--changes", str(tmp_path / "changes" / "*"), "--output", str(tmp_path / "snap")])
    from eventide.sinks.cdc_files import read_snapshot
    assert [tuple(r) for r in read_snapshot(spark, str(tmp_path / "snap" / "table")).collect()] == [(1, "a")]


def test_cli_sliding_panes_equal_direct(spark, tmp_path):
    d = tmp_path / "metrics"
    d.mkdir()
    with open(d / "m.json", "w") as f:
        for sec, c in [(5, "a"), (65, "a"), (70, "b"), (400, "a"), (2000, "a")]:
            f.write(json.dumps({"cluster_name": c, "host_ip": "10.0.0.1", "cpu_usage": 1.0,
                                "ts": (T0 + dt.timedelta(seconds=sec)).strftime("%Y-%m-%d %H:%M:%S")}) + "\n")
    main(["sliding", "--json-dir", str(d), "--output", str(tmp_path / "direct")])
    main(["sliding", "--json-dir", str(d), "--output", str(tmp_path / "panes"), "--panes"])
    a = spark.read.parquet(str(tmp_path / "direct" / "data"))
    b = spark.read.parquet(str(tmp_path / "panes" / "data")).select(a.columns)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
