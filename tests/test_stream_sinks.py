import datetime as dt
import json
import os
import tempfile
import time
import uuid

from eventide.functions import schemas
from eventide.sinks import jdbc_execute
from eventide.sinks.cdc_jdbc import create_cdc_tables
from eventide.sinks.tables import create_table, insert_into
from eventide.sources import csv_table, decode_json, jdbc_table, json_value_files, parquet_dir
from eventide.streaming import jobs as sjobs
from eventide.streaming.runtime import copy_checkpoint, start_console
from tests.conftest import rows

URL = "jdbc:derby:memory:eventide_stream_tests;create=true"
PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
T0 = dt.datetime(2024, 1, 1)


def _csv_batches(batches):
    d = tempfile.mkdtemp(prefix="eventide-words-")
    now = time.time() - 100
    for i, b in enumerate(batches):
        p = os.path.join(d, f"w{i}.csv")
        with open(p, "w") as f:
            f.write("".join(f"{k},{w}\n" for k, w in b))
        os.utime(p, (now + i, now + i))
    return d


def test_stream_wordcount_into_jdbc_with_restart(spark):
    table = f"wc_{uuid.uuid4().hex[:8]}"
    jdbc_execute(spark, URL, [f'CREATE TABLE {table} ("word" VARCHAR(64) NOT NULL PRIMARY KEY, "cnt" BIGINT)'], PROPS)
    d = _csv_batches([[(1, "a"), (2, "b"), (3, "a")], [(4, "a"), (5, "c")]])
    ck = tempfile.mkdtemp(prefix="eventide-wc-ck-")
    stream = lambda: csv_table(spark, d, schemas.WORDS, stream=True, maxFilesPerTrigger=1)
    sjobs.run_jdbc_wordcount(stream(), URL, table, PROPS, checkpoint=ck, casts={"word": "VARCHAR(64)"})
    assert rows(jdbc_table(spark, URL, table, properties=PROPS)) == [("a", 3), ("b", 1), ("c", 1)]
    # a new file arrives; the restarted query continues from its checkpoint
    with open(os.path.join(d, "w9.csv"), "w") as f:
        f.write("6,b\n7,d\n")
    sjobs.run_jdbc_wordcount(stream(), URL, table, PROPS, checkpoint=ck, casts={"word": "VARCHAR(64)"})
    assert rows(jdbc_table(spark, URL, table, properties=PROPS)) == [("a", 3), ("b", 2), ("c", 1), ("d", 1)]


def test_cdc_stream_into_jdbc(spark):
    table = f"wcdc_{uuid.uuid4().hex[:8]}"
    create_cdc_tables(spark, URL, table, PROPS)
    base = tempfile.mkdtemp(prefix="eventide-cdc-")
    batches = [[("c", 5, None, (1, "late-old"))],                       # arrives first, but is older
               [("r", 1, None, (1, "a")), ("r", 2, None, (2, "b"))],
               [("u", 6, (1, None), (1, "a2")), ("d", 7, (2, None), None), ("c", 8, None, (3, "c"))],
               [("u", 3, (2, None), (2, "stale"))]]                     # older than the delete of 2
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schemas.CHANGE_RECORD).write.parquet(f"{base}/src/b{i}")
        time.sleep(0.01)
    schema = spark.read.parquet(f"{base}/src/b0").schema
    sjobs.run_cdc_jdbc(parquet_dir(spark, f"{base}/src/*", schema, stream=True, max_files_per_trigger=1),
                       URL, table, PROPS, checkpoint=f"{base}/ck")
    assert rows(jdbc_table(spark, URL, table, properties=PROPS)) == [(1, "a2"), (3, "c")]


def _click_files():
    d = tempfile.mkdtemp(prefix="eventide-rank-")
    now = time.time() - 100
    data = [[("a", "m", 1), ("b", "m", 2), ("a", "m", 3), ("x", "f", 4)], [("c", "m", 70)], [("d", "m", 200)]]
    for i, b in enumerate(data):
        p = os.path.join(d, f"c{i}.json")
        with open(p, "w") as f:
            for name, sex, sec in b:
                f.write(json.dumps({"name": name, "sex": sex, "action": "click", "is_delete": 0,
                                    "ts": (T0 + dt.timedelta(seconds=sec)).strftime("%Y-%m-%d %H:%M:%S")}) + "\n")
        os.utime(p, (now + i, now + i))
    return d


def test_click_rank_two_sinks_and_checkpoint_copy(spark):
    d = _click_files()
    src = lambda: decode_json(json_value_files(spark, d, stream=True, max_files_per_trigger=1), schemas.USER_ACTION)
    path = tempfile.mkdtemp(prefix="eventide-rank-out-")
    counts, top = sjobs.run_click_rank(src(), path, n=1, size="1 minute", slide="1 minute")
    assert rows(counts, "sex", "cnt", "start_time") == [("f", 1, T0), ("m", 1, T0 + dt.timedelta(minutes=1)), ("m", 3, T0)]
    assert rows(top, "sex", "name", "cnt") == [("f", "x", 1), ("m", "a", 2), ("m", "c", 1)]
    # a copy of the stopped checkpoint resumes like the original
    copy_checkpoint(spark, f"{path}/sex_count/_checkpoint", f"{path}/copy/_checkpoint")
    out = sjobs.run_window_agg(src(), "hop", ["sex"], [sjobs.count_("cnt")], "1 minute", "1 minute",
                               path=f"{path}/copy")
    assert out.count() == 0  # nothing new: the copy already consumed every file


def test_insert_into_and_console(spark, capsys):
    loc = tempfile.mkdtemp(prefix="eventide-table-")
    name = f"wordcount_{uuid.uuid4().hex[:6]}"
    create_table(spark, name, "word STRING, cnt BIGINT", loc)
    words = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], schemas.WORDS)
    insert_into(spark, name, "SELECT word, count(1) AS cnt FROM {w} GROUP BY word", w=words)
    assert rows(spark.table(name)) == [("a", 2), (None, 1)]
    d = _csv_batches([[(1, "a")]])
    q = start_console(csv_table(spark, d, schemas.WORDS, stream=True), tempfile.mkdtemp(prefix="eventide-con-"))
    q.awaitTermination()
    assert q.exception() is None
