"""Late rows as an output: each micro-batch is tagged by the watermark in force.

The watermark in force in a micro-batch is the newest event time of all earlier
ones, less the delay; it never falls.  A row is late if its time lies before it
or, with a window, if the last window that holds it has ended by then (which is
when ``stateful_windows`` counts it nowhere).  Rows without a time are kept.

A micro-batch is written once, in two partitions, and its newest event time is
observed on the way.  The commit record, written last, carries the watermark
that the next micro-batch works with: a replayed batch finds the watermark of
the batches before it and gives the same rows.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventide.functions import schemas
from eventide.operators.timeutil import duration_micros, to_micros
from eventide.session import shared_path
from eventide.streaming import runtime as rt


def is_late(ts: str, watermark_us: int | None, size: str | None = None, slide: str | None = None) -> Column:
    """Whether a row is late by a watermark in microseconds (None: nothing is)."""
    if watermark_us is None:
        return F.lit(False)
    t = to_micros(F.col(ts))
    if size is None:
        late = t < watermark_us
    else:
        step = duration_micros(slide or size)
        late = F.floor(t / step) * step + duration_micros(size) <= watermark_us
    return F.coalesce(late, F.lit(False))


def watermark_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The watermark (microseconds) in force in a micro-batch: what the last commit before it carries."""
    ids = [i for i in rt.committed(spark, path, "batch_id") if i < batch_id]
    return rt.commit_payload(spark, path, f"batch_id={ids[-1]}")["watermark_us"] if ids else None


def start_split_late(stream: DataFrame, ts: str = "ts", delay: str = schemas.WATERMARK_DELAY, size: str | None = None,
                     slide: str | None = None, opts: rt.StreamOptions | None = None, path: str | None = None):
    """(query, path): the stream's rows in ``<path>/data/batch_id=<id>/late=<true|false>``."""
    path = path or shared_path(stream.sparkSession, "split-late")
    data, behind = f"{path}/data", duration_micros(delay)
    opts = replace(opts or rt.StreamOptions(), checkpoint=opts and opts.checkpoint or f"{path}/_checkpoint")

    def tag(batch: DataFrame, batch_id: int) -> None:
        before = watermark_before(batch.sparkSession, data, batch_id)
        seen = Observation()
        rows = batch.withColumn("late", is_late(ts, before, size, slide)).observe(
            seen, F.max(to_micros(F.col(ts))).alias("newest"))

        def payload() -> dict:
            newest = seen.get["newest"]
            return {"watermark_us": before if newest is None else max(newest - behind, before if before is not None else newest - behind)}

        rt.publish(rows, data, f"batch_id={batch_id}", payload, partition_by=["late"])

    return rt.start_foreach_batch(stream, tag, opts.checkpoint, opts), path


def read_split(spark: SparkSession, path: str, schema, late: bool | None = None) -> DataFrame:
    """The published rows with their ``late`` tag, or those of one tag without it."""
    ids = rt.committed(spark, f"{path}/data", "batch_id")
    fields = schema.add("late", "boolean")
    if not ids:
        rows = spark.createDataFrame([], fields)
    else:
        rows = spark.read.schema(fields).option("basePath", f"{path}/data").parquet(*[f"{path}/data/batch_id={i}" for i in ids])
        rows = rows.select(*fields.names)
    return rows if late is None else rows.where(F.col("late") == late).drop("late")


def run_split_late(stream: DataFrame, ts: str = "ts", delay: str = schemas.WATERMARK_DELAY, size: str | None = None,
                   slide: str | None = None, opts: rt.StreamOptions | None = None, path: str | None = None) -> DataFrame:
    """Split what is there; all rows with their ``late`` tag."""
    q, path = start_split_late(stream, ts, delay, size, slide, opts, path)
    rt.wait(q)
    return read_split(stream.sparkSession, path, stream.schema)
