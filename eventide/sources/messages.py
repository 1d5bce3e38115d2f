"""JSON message sources (Kafka topics, or files standing in for them).

``decode_json`` is the tolerant decoder every message source uses:

* a missing field gives NULL;
* a field whose value does not fit its type gives NULL, the row is kept;
* text that is not a JSON object (broken text, ``''``, NULL, arrays,
  strings, numbers, ``null``) drops the row.

It parses each message once: every field is first read as text (any JSON
value converts to text, nested objects become their JSON text), the row is
dropped only when the parser flags the whole record, and fields are then
converted with ``try_cast`` / ``try_to_timestamp``.  ``strict=True`` fails
the job on the first undecodable message instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions import schemas

_CORRUPT = "_corrupt_record"


def _as_struct(schema) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T._parse_datatype_string(schema)


def _convert(field: T.StructField, raw: Column, ts_format: str) -> Column:
    dt = field.dataType
    if isinstance(dt, T.StringType):
        return raw
    if isinstance(dt, T.TimestampNTZType):
        # Parse the wall-clock text; the session zone is UTC so the cast is exact.
        return F.try_to_timestamp(raw, F.lit(ts_format)).cast("timestamp_ntz")
    if isinstance(dt, T.TimestampType):
        return F.try_to_timestamp(raw, F.lit(ts_format))
    return raw.try_cast(dt)


def decode_json(df: DataFrame, schema=schemas.USER_ACTION, value_col: str = "value",
                ts_format: str = schemas.MESSAGE_TS_FORMAT + "[.SSS]", strict: bool = False,
                keep: list[str] | None = None) -> DataFrame:
    """Decode JSON text in ``value_col`` into typed columns (batch or stream)."""
    st = _as_struct(schema)
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in st.fields]
                               + [T.StructField(_CORRUPT, T.StringType())])
    opts = {"mode": "FAILFAST" if strict else "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = df.select(*(keep or []), F.from_json(F.col(value_col), text_schema, opts).alias("_j"))
    ok = parsed.where(F.col("_j").isNotNull() & F.col(f"_j.{_CORRUPT}").isNull())
    return ok.select(*(keep or []),
                     *[_convert(f, F.col(f"_j.{f.name}"), ts_format).alias(f.name) for f in st.fields])


def json_value_files(spark: SparkSession, path: str, stream: bool = False,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files of one JSON message per line, read as a ``value`` column."""
    if not stream:
        return spark.read.text(path)
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(path)


def kafka_json(spark: SparkSession, servers: str, topic: str, group_id: str | None = None,
               starting_offsets: str = "earliest", stream: bool = True,
               max_offsets_per_trigger: int | None = None, min_partitions: int | None = None,
               **options) -> DataFrame:
    """Kafka topic as a ``value STRING`` DataFrame (needs the Kafka connector jar).

    ``starting_offsets='earliest'`` applies on the first start only; after
    that the stream resumes from its checkpoint.  ``max_offsets_per_trigger``
    bounds a micro-batch (catch-up after downtime stays within memory);
    ``min_partitions`` splits large topic partitions over more tasks.  Feed
    the result to ``decode_json``.
    """
    r = (spark.readStream if stream else spark.read).format("kafka")
    r = r.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    r = r.option("startingOffsets", starting_offsets)
    if group_id:
        r = r.option("kafka.group.id", group_id)
    if max_offsets_per_trigger and stream:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions:
        r = r.option("minPartitions", min_partitions)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"))
