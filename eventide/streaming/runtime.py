"""Running Structured Streaming jobs: checkpoints, triggers, state store, sinks.

* Checkpoints and sink folders live below the shared checkpoint folder
  (``eventide.session.shared_path``); a restarted query resumes from them
  (offsets, state, sink log), which is the recovery and upgrade path.
* ``trigger="availableNow"`` processes what is there and stops (tests,
  catch-up); a duration string runs micro-batches on that interval.
* ``StreamOptions`` carries per-query settings applied only while the query
  starts (it clones the session conf then); the RocksDB state store with
  changelog checkpointing is the default (state off the JVM heap, incremental
  snapshots).  ``use_rocksdb`` sets it for a whole session instead.
* Versioned ``foreachBatch`` outputs (``<path>/v=<batch_id>``) make a batch
  replayed after a failure overwrite its own version: exactly-once results.
  ``batch_id=<id>`` outputs do the same for per-batch results.  Both are
  published by a record of their own in ``<path>/_commits``, written last:
  readers see exactly the outputs with a record, whatever the file committer
  leaves behind.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.session import shared_path

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def rocksdb_conf(changelog: bool = True) -> dict:
    """Settings of the RocksDB state store with incremental (changelog) checkpoints.

    Row-total tracking is off: it costs a lookup per write (about a quarter of
    a large windowed batch here) and only feeds the ``numRowsTotal`` metric.
    """
    return {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": str(changelog).lower(),
            "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


def use_rocksdb(spark: SparkSession, changelog: bool = True) -> None:
    """RocksDB state store for every query started afterwards in this session.
    (Per query: ``StreamOptions(conf=rocksdb_conf())``.)  The choice is fixed in
    a query's checkpoint at its first start."""
    for k, v in rocksdb_conf(changelog).items():
        spark.conf.set(k, v)


@dataclass
class StreamOptions:
    checkpoint: str | None = None
    trigger: str = "availableNow"       # or an interval such as "10 seconds"
    output_mode: str = "append"
    query_name: str | None = None
    # State/shuffle partitions of the query, fixed in its checkpoint at the first
    # start.  None keeps the session's spark.sql.shuffle.partitions; give a number
    # where the stream is to grow beyond what suits the session's batch jobs.
    state_partitions: int | None = None
    # Extra SQL settings of this query only (fixed when it starts).  By default
    # the RocksDB state store with changelog checkpoints: state lives off the
    # JVM heap and on local disk (the default store keeps it all in executor
    # memory), and checkpoints upload only what changed.
    conf: dict = field(default_factory=lambda: rocksdb_conf())


# Pre-merge session windows inside each partition before the shuffle to the
# state store (a partial aggregate for sessions): a hot key then ships its
# local sessions, not its rows.
SESSION_LOCAL_MERGE = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def _start(writer, spark: SparkSession, opts: StreamOptions) -> StreamingQuery:
    """Start with ``opts.state_partitions`` and ``opts.conf`` in effect: the query
    clones the session conf when it starts, the session is restored after."""
    conf = dict(opts.conf)
    if opts.state_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(opts.state_partitions)
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _apply_trigger(writer, trigger: str):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def start_files(df: DataFrame, path: str, fmt: str = "parquet", opts: StreamOptions | None = None,
                partition_by: list[str] | None = None) -> StreamingQuery:
    """Append-mode file sink (its own commit log gives exactly-once files)."""
    opts = opts or StreamOptions()
    ck = opts.checkpoint or f"{path}/_checkpoint"
    w = df.writeStream.format(fmt).option("path", f"{path}/data").option("checkpointLocation", ck)
    w = w.outputMode(opts.output_mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if opts.query_name:
        w = w.queryName(opts.query_name)
    return _start(_apply_trigger(w, opts.trigger), df.sparkSession, opts)


def start_foreach_batch(df: DataFrame, fn, checkpoint: str, opts: StreamOptions | None = None) -> StreamingQuery:
    opts = opts or StreamOptions()
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).outputMode(opts.output_mode)
    if opts.query_name:
        w = w.queryName(opts.query_name)
    return _start(_apply_trigger(w, opts.trigger), df.sparkSession, opts)


def wait(q: StreamingQuery) -> StreamingQuery:
    """Block until the query ends; raise what ended it."""
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def start_to_table(df: DataFrame, name: str, opts: StreamOptions | None = None,
                   path: str | None = None) -> tuple[StreamingQuery, str]:
    """Start writing an append-mode stream to a parquet table; (query, path)."""
    path = path or shared_path(df.sparkSession, name)
    return start_files(df, path, "parquet", opts), path


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table of ``start_to_table`` as committed so far (through the sink's commit log)."""
    fs, p, _ = _fs(spark, f"{path}/data")
    if not fs.exists(p):  # no batch has committed output yet
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/data")


def run_to_table(df: DataFrame, name: str, spark: SparkSession | None = None,
                 opts: StreamOptions | None = None, path: str | None = None) -> DataFrame:
    """Run an append-mode streaming DataFrame to a parquet table; return the table.

    With the default ``availableNow`` trigger this blocks until the input
    present at start is consumed; with an interval use ``start_to_table``.
    """
    spark = spark or df.sparkSession
    q, path = start_to_table(df, name, opts, path)
    wait(q)
    return read_table(spark, path, df.schema)


# --- versioned tables written from foreachBatch -----------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _record(spark: SparkSession, path: str, name: str):
    fs, p, jvm = _fs(spark, f"{path}/_commits/{name}")
    return fs, p, jvm


def publish(df: DataFrame, path: str, name: str, payload: Callable[[], dict] | None = None,
            partition_by: list[str] | None = None) -> None:
    """Write ``<path>/<name>`` and then its commit record.  A replay takes the record
    back first, so that a write cut short is never seen.  ``payload`` is asked after
    the write for what the record is to carry."""
    spark = df.sparkSession
    fs, record, _ = _record(spark, path, name)
    fs.delete(record, False)
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{path}/{name}")
    out = fs.create(record, True)
    if payload:
        out.write(bytearray(json.dumps(payload()).encode()))
    out.close()


def commit_payload(spark: SparkSession, path: str, name: str) -> dict:
    """What the commit record of ``<path>/<name>`` carries."""
    fs, record, jvm = _record(spark, path, name)
    source = fs.open(record)
    try:
        return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode() or "{}")
    finally:
        source.close()


def committed(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers ``n`` of the published outputs ``<path>/<kind>=<n>``."""
    fs, p, _ = _fs(spark, f"{path}/_commits")
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}="))


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions ``v=<n>`` under ``path`` whose write was published."""
    return committed(spark, path, "v")


def read_version(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The latest published version (strictly below ``before`` if given), or None."""
    vs = [v for v in committed_versions(spark, path) if before is None or v < before]
    if not vs:
        return None
    return spark.read.parquet(f"{path}/v={vs[-1]}")


def write_version(df: DataFrame, path: str, version: int) -> None:
    publish(df, path, f"v={version}")


def drop_versions_before(spark: SparkSession, path: str, keep_from: int) -> None:
    """Delete published versions older than ``keep_from`` (their successors are published)."""
    fs, p, jvm = _fs(spark, path)
    for v in committed_versions(spark, path):
        if v < keep_from:
            fs.delete(_record(spark, path, f"v={v}")[1], False)
            fs.delete(jvm.org.apache.hadoop.fs.Path(p, f"v={v}"), True)


def drop_batches_upto(spark: SparkSession, path: str, last: int) -> None:
    """Delete published batches up to ``last`` (a version has what is needed of them)."""
    fs, p, jvm = _fs(spark, path)
    for i in committed(spark, path, "batch_id"):
        if i <= last:
            fs.delete(_record(spark, path, f"batch_id={i}")[1], False)
            fs.delete(jvm.org.apache.hadoop.fs.Path(p, f"batch_id={i}"), True)


def versioned_fold(path: str, step, retain: int = 2):
    """foreachBatch function: ``new = step(previous_version_or_None, batch_df)``,
    written as version ``v=<batch_id>``.  A replayed batch id reads the same
    previous version and overwrites its own: idempotent.  Versions older than
    the last ``retain`` committed ones are deleted (a replay of batch b needs
    only the version before b)."""

    def _fn(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        prev = read_version(spark, path, before=batch_id)
        write_version(step(prev, batch_df), path, batch_id)
        vs = [v for v in committed_versions(spark, path) if v <= batch_id]
        if len(vs) > retain:
            drop_versions_before(spark, path, vs[-retain])

    return _fn


def batch_partitioned_writer(path: str, transform):
    """foreachBatch function publishing ``transform(batch)`` as ``<path>/batch_id=<id>``
    (overwrite, so a replay leaves one copy)."""

    def _fn(batch_df: DataFrame, batch_id: int) -> None:
        publish(transform(batch_df), path, f"batch_id={batch_id}")

    return _fn


def read_batches(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Union of all published ``batch_id=<n>`` outputs (an empty frame of ``schema`` if none)."""
    ids = committed(spark, path, "batch_id")
    if not ids:
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    return spark.read.parquet(*[f"{path}/batch_id={i}" for i in ids])


def compact_batches(spark: SparkSession, path: str, upto: int | None = None) -> int | None:
    """Merge the published batches (up to ``upto``) into the newest of them; its number.

    A stream that runs for long leaves one folder per batch.  Batches that a
    restarted query may replay must stay apart: pass an ``upto`` below the
    last batch while the query runs.  The merged output is written aside and
    then takes the newest batch's place; a compaction cut short at any point
    is completed or undone by running it again.
    """
    fs, p, jvm = _fs(spark, path)
    path_of = lambda name: jvm.org.apache.hadoop.fs.Path(p, name)
    done = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    for name in [n for n in done if n.startswith("merged-")]:  # an earlier run was cut short
        first, last = map(int, name.split("-")[1:])
        _swap(spark, path, first, last) if fs.exists(path_of(f"_commits/{name}")) else fs.delete(path_of(name), True)
    ids = [i for i in committed(spark, path, "batch_id") if upto is None or i <= upto]
    if len(ids) < 2:
        return ids[0] if ids else None
    name = f"merged-{ids[0]}-{ids[-1]}"
    publish(read_batches_of(spark, path, ids), path, name)
    _swap(spark, path, ids[0], ids[-1])
    return ids[-1]


def read_batches_of(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    return spark.read.parquet(*[f"{path}/batch_id={i}" for i in ids])


def _swap(spark: SparkSession, path: str, first: int, last: int) -> None:
    """Put ``merged-<first>-<last>`` in the place of the batches it holds."""
    fs, p, jvm = _fs(spark, path)
    at = lambda name: jvm.org.apache.hadoop.fs.Path(p, name)
    name = f"merged-{first}-{last}"
    if fs.exists(at(name)):
        for i in [i for i in committed(spark, path, "batch_id") if first <= i <= last]:
            fs.delete(at(f"_commits/batch_id={i}"), False)
        for st in fs.listStatus(p):
            n = st.getPath().getName()
            if n.startswith("batch_id=") and first <= int(n.split("=")[1]) <= last:
                fs.delete(st.getPath(), True)
        fs.rename(at(name), at(f"batch_id={last}"))
    fs.create(at(f"_commits/batch_id={last}"), True).close()
    fs.delete(at(f"_commits/{name}"), False)


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark in force for micro-batch ``batch_id`` (milliseconds), as its checkpoint has it;
    0 before the first one."""
    fs, p, jvm = _fs(spark, f"{checkpoint}/offsets/{batch_id}")
    if batch_id < 0 or not fs.exists(p):
        return 0
    source = fs.open(p)
    try:
        lines = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode().splitlines()
    finally:
        source.close()
    return json.loads(lines[1])["batchWatermarkMs"]


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of the query that owns ``checkpoint``: kept over restarts, new for a fresh one."""
    return json.loads(spark.read.option("wholetext", True).text(f"{checkpoint}/metadata").first()[0])["id"]


def ntz_bounds(df: DataFrame) -> DataFrame:
    """Window bounds back to TIMESTAMP without zone (event time was cast for the watermark)."""
    for c in ("start_time", "end_time"):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def copy_checkpoint(spark: SparkSession, src: str, dst: str) -> str:
    """Copy a *stopped* query's checkpoint (offsets, commits, state) to ``dst``.

    The copy is a restore point: a query started later on ``dst`` resumes
    exactly where the stopped one was, e.g. after an upgrade, while the
    original checkpoint keeps running or is rolled back to.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    sp, dp = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    jvm.org.apache.hadoop.fs.FileUtil.copy(sp.getFileSystem(conf), sp, dp.getFileSystem(conf), dp, False, conf)
    return dst


def start_console(df: DataFrame, checkpoint: str, output_mode: str = "append", trigger: str = "availableNow",
                  num_rows: int = 20) -> StreamingQuery:
    """The ``print`` sink for streams (inspection only: rows go to the driver log)."""
    w = (df.writeStream.format("console").option("checkpointLocation", checkpoint)
         .option("numRows", num_rows).option("truncate", False).outputMode(output_mode))
    return _apply_trigger(w, trigger).start()
