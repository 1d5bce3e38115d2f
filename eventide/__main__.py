"""Run the jobs from the command line.

    python -m eventide wordcount --input words.csv [--output out_dir]
    python -m eventide click-rank --json-dir msgs/ --output out/ [--n 5]
    python -m eventide click-top-json --kafka host:9092 --topic user_action --output out/
    python -m eventide running-topn --json-dir msgs/ --output out/ [--n 10] [--changelog]
    python -m eventide tumbling|sliding|session --json-dir metrics/ --output out/
    python -m eventide udf --input words.csv
    python -m eventide udtf --input input.csv [--outer]
    python -m eventide jdbc-wordcount --url URL --source words --sink wordcount
    python -m eventide cdc --changes changes/ (--url URL --table words_cdc | --output snap/)

Stream jobs read JSON messages from a folder of text files (``--json-dir``)
or a Kafka topic (``--kafka`` + ``--topic``; needs the connector jar), run
with ``--trigger`` (default: process what is there and stop) and keep their
checkpoint below ``--output`` (or ``--checkpoint``).  Without ``--output``
results are printed: the first ``--rows`` of them (20 unless said otherwise).
"""

from __future__ import annotations

import argparse

from eventide import get_session
from eventide.functions import schemas
from eventide.operators import with_event_time
from eventide.operators.windows import avg_, count_, max_, min_
from eventide.plans import jobs
from eventide.sinks import csv_sink, jdbc_upsert, show
from eventide.sinks.dialects import dialect_for
from eventide.sources import csv_json_cells, csv_table, decode_json, jdbc_table, json_value_files, kafka_json
from eventide.sources.files import parquet_dir
from eventide.streaming import jobs as sjobs
from eventide.streaming.runtime import StreamOptions, use_rocksdb


def _messages(spark, a, schema):
    if a.kafka:
        raw = kafka_json(spark, a.kafka, a.topic, a.group)
    else:
        raw = json_value_files(spark, a.json_dir, stream=True, max_files_per_trigger=a.max_files)
    return with_event_time(decode_json(raw, schema), "ts", schemas.WATERMARK_DELAY)


def _emit(df, a):
    if a.output:
        df.write.mode("overwrite").parquet(a.output + "/result")
    else:
        show(df, a.rows)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="eventide")
    ap.add_argument("job", choices=["wordcount", "click-rank", "click-top-json", "running-topn", "tumbling",
                                    "sliding", "session", "udf", "udtf", "jdbc-wordcount", "cdc"])
    ap.add_argument("--input"); ap.add_argument("--output"); ap.add_argument("--outer", action="store_true")
    ap.add_argument("--json-dir"); ap.add_argument("--kafka"); ap.add_argument("--topic"); ap.add_argument("--group")
    ap.add_argument("--max-files", type=int); ap.add_argument("--trigger", default="availableNow")
    ap.add_argument("--checkpoint"); ap.add_argument("--rocksdb", action="store_true")
    ap.add_argument("--n", type=int); ap.add_argument("--rows", type=int, default=20,
                                                                help="result rows to print without --output")
    ap.add_argument("--url"); ap.add_argument("--source"); ap.add_argument("--sink"); ap.add_argument("--table")
    ap.add_argument("--changes"); ap.add_argument("--driver")
    ap.add_argument("--changelog", action="store_true", help="running-topn: also write +/- change rows")
    ap.add_argument("--panes", action="store_true", help="sliding, click-rank, click-top-json: pre-aggregate slide-wide panes (dense streams)")
    ap.add_argument("--word-type", help="jdbc-wordcount: SQL type the staged word is cast to in the MERGE "
                                        "(e.g. VARCHAR(256) where strings are staged as CLOB)")
    ap.add_argument("--dialect", choices=["merge", "mysql", "postgres"], help="SQL dialect of --url (default: by the URL)")
    ap.add_argument("--master")
    a = ap.parse_args(argv)

    spark = get_session(a.master)
    if a.rocksdb:
        use_rocksdb(spark)
    opts = StreamOptions(trigger=a.trigger, checkpoint=a.checkpoint)
    props = {"driver": a.driver} if a.driver else None

    if a.job == "wordcount":
        out = jobs.wordcount(csv_table(spark, a.input, schemas.WORDS))
        csv_sink(out, a.output) if a.output else show(out, a.rows)
    elif a.job == "udf":
        _emit(jobs.with_hash(csv_table(spark, a.input, schemas.WORDS)), a)
    elif a.job == "udtf":
        _emit(jobs.split_lateral(csv_json_cells(spark, a.input), outer=a.outer), a)
    elif a.job == "jdbc-wordcount":
        d = dialect_for(a.url, a.dialect)
        counts = jobs.wordcount(jdbc_table(spark, a.url, a.source, "id", properties=props, quote=d.mark))
        jdbc_upsert(counts, a.url, a.sink, ["word"], props, casts={"word": a.word_type} if a.word_type else None, dialect=d)
    elif a.job == "click-rank":
        counts, top = sjobs.run_click_rank(_messages(spark, a, schemas.USER_ACTION), a.output, n=a.n or 5,
                                           opts=opts, strategy="panes" if a.panes else "direct")
        if not a.output:
            show(counts, a.rows); show(top, a.rows)
    elif a.job == "click-top-json":
        from eventide.operators import live_clicks
        out = sjobs.run_window_topn_json(live_clicks(_messages(spark, a, schemas.USER_ACTION)), jobs.CLICK_WINDOW,
                                         jobs.CLICK_SLIDE, "sex", "name", a.n or 10, opts=opts, path=a.output,
                                         strategy="panes" if a.panes else "direct")
        show(out, a.rows)
    elif a.job == "running-topn":
        show(sjobs.run_running_topn(_messages(spark, a, schemas.USER_ACTION), "sex", "name", a.n or 10,
                                    opts=opts, path=a.output, changelog=a.changelog), a.rows)
    elif a.job in ("tumbling", "sliding", "session"):
        cpu = _messages(spark, a, schemas.CPU_USAGE)
        if a.job == "tumbling":
            out = sjobs.run_window_agg(cpu, "tumble", ["cluster_name"],
                                       [max_("cpu_usage", "max_cpu_usage"), min_("cpu_usage", "min_cpu_usage"),
                                        avg_("cpu_usage", "avg_cpu_usage")], jobs.TUMBLE_SIZE, opts=opts, path=a.output)
        elif a.job == "sliding":
            out = sjobs.run_window_agg(cpu, "hop", ["cluster_name"], [count_("cnt")], jobs.SLIDE_SIZE,
                                       jobs.SLIDE_STEP, opts=opts, path=a.output,
                                       strategy="panes" if a.panes else "direct")
        else:
            out = sjobs.run_window_agg(cpu, "session", ["cluster_name"], [count_("cnt")], jobs.SESSION_GAP,
                                       opts=opts, path=a.output)
        show(out, a.rows)
    elif a.job == "cdc":
        schema = spark.read.parquet(a.changes).schema
        changes = parquet_dir(spark, a.changes, schema, stream=True, max_files_per_trigger=a.max_files)
        if a.url:
            sjobs.run_cdc_jdbc(changes, a.url, a.table, props, opts, checkpoint=a.checkpoint, dialect=a.dialect)
        else:
            show(sjobs.run_cdc_snapshot(changes, opts, path=a.output), a.rows)


if __name__ == "__main__":
    main()
