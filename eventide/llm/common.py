"""Helpers shared by the operators: written tables and per-process memory."""

from __future__ import annotations

import math
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import shared_path

#: White space of the digest contracts: [\x20\x09-\x0D].
BLANKS = r"[\x20\x09-\x0D]+"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: With it, Spark removes the shuffle files of a query when it ends, not when the driver next collects garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, partition_by: str | None = None, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    This cuts the lineage: what is lost with an executor is read again from
    the shared folder instead of being computed again, so the shuffle files of
    ``df`` go when it is written.  ``batch_rows`` bounds the rows that Python
    functions in ``df`` get at once, where rows are large.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    w = df.write.option("compression", "zstd")
    with _settings(spark, {CLEAN_SHUFFLES: "true"} | ({BATCH_ROWS: str(batch_rows)} if batch_rows else {})):
        (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def removed(*tables: DataFrame) -> None:
    """Delete what ``written`` made: tables that only frames have read which are written themselves.

    What a step leaves adds up over the steps of a job.  Frames that are yet to
    be run, returned ones included, must not read any of the tables.
    """
    for t in tables:
        context = t.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(t._written)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def written_as(df: DataFrame, name: str) -> str:
    """Write ``df`` below the shared folder and return the path."""
    path = shared_path(df.sparkSession, name)
    with _settings(df.sparkSession, {CLEAN_SHUFFLES: "true"}):
        df.write.option("compression", "zstd").parquet(path)
    return path


@contextmanager
def _settings(spark: SparkSession, own: dict[str, str]) -> Iterator[None]:
    """The session with other settings for a while."""
    before = {k: spark.conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def per_process(name: str, make: Callable[[], object]) -> object:
    """The one object that a Python worker process keeps from task to task.

    The library's functions travel to the workers by value, so their module
    globals are new in every task; ``sys.modules`` is what a process keeps.
    Asking for another name drops what was kept: workers outlive stages, and
    caches of earlier ones would add up.
    """
    kept = sys.modules.setdefault("_eventide_kept", types.ModuleType("_eventide_kept")).__dict__
    if kept.get("owner") != name:
        kept["owner"] = kept["value"] = None
        pa.default_memory_pool().release_unused()
        kept["value"], kept["owner"] = make(), name
    return kept["value"]


def shards(rows: int, per_shard: int, least: int = 1) -> int:
    """How many shards ``rows`` need at ``per_shard`` each."""
    return max(least, math.ceil(rows / per_shard))


def reading_tasks(spark: SparkSession, volume: int, per_task: int) -> int:
    """Tasks for rows that each stand for much more to be read than their own bytes.

    Spark merges partitions by the rows' bytes unless their number is given: it
    is the session's number of shuffle partitions, or more where a task would
    otherwise get over ``per_task`` of ``volume``.
    """
    return shards(volume, per_task, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def store(path: str):
    """(file system, path in it) of a folder or file of the shared store.

    pyarrow's file systems reach mounted folders, HDFS and object stores, so
    tasks can write and range-read files that are no Spark tables.
    """
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def publish(path: str, data: bytes) -> None:
    """Write a file in one step: readers see all of it or nothing."""
    import uuid

    files, at = store(path)
    files.create_dir(at.rsplit("/", 1)[0], recursive=True)
    part = f"{at}.{uuid.uuid4().hex}.part"
    with files.open_output_stream(part) as out:
        out.write(data)
    files.move(part, at)
