"""Duration text and event-time helpers shared by window operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000,
}


def duration_micros(text: str) -> int:
    """'5 minutes', '60 seconds', '1 day 2 hours' -> microseconds."""
    total = 0
    parts = re.findall(r"(\d+)\s*([a-zA-Z]+)", text)
    if not parts:
        raise ValueError(f"not a duration: {text!r}")
    for num, unit in parts:
        u = unit.lower().rstrip("s")
        if u not in _UNITS:
            raise ValueError(f"unknown unit {unit!r} in {text!r}")
        total += int(num) * _UNITS[u]
    return total


def is_ntz(df: DataFrame, ts: str) -> bool:
    return isinstance(df.schema[ts].dataType, T.TimestampNTZType)


def require_utc(spark) -> None:
    """Times without a zone are read as wall-clock UTC: that needs a UTC session."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in ("UTC", "ETC/UTC", "Z", "GMT", "+00:00", "UTC+0"):
        raise ValueError(f"spark.sql.session.timeZone is {zone}: event time without a zone needs UTC")


def to_micros(c: Column) -> Column:
    """Microseconds since the epoch (wall clock; the session zone is UTC)."""
    return F.unix_micros(c.cast("timestamp"))


def from_micros(c: Column, ntz: bool) -> Column:
    t = F.timestamp_micros(c)
    return t.cast("timestamp_ntz") if ntz else t


def with_event_time(df: DataFrame, ts: str = "ts", delay: str = "5 seconds") -> DataFrame:
    """Mark ``ts`` as event time with a bounded-lateness watermark.

    Spark's watermark needs a TIMESTAMP column; TIMESTAMP_NTZ input is cast
    (exact, the session zone is UTC) and window bounds are cast back later.
    Declare it at the source, before filters, as a table's WATERMARK clause
    does: the watermark then follows the newest row of the whole source.
    A column that already carries a watermark is left as it is.
    """
    if "spark.watermarkDelayMs" in df.schema[ts].metadata:
        return df
    if is_ntz(df, ts):
        require_utc(df.sparkSession)
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows out to ``partitions`` tasks before a step that multiplies them.

    The default changes nothing: large inputs arrive in many splits.  Give a
    number for an input that cannot be split (one row group, one multi-line
    CSV file).  The plan depends on the argument alone.  Streams pass through
    (their parallelism is set by the source).
    """
    if partitions is None or df.isStreaming:
        return df
    return df.repartition(partitions)
