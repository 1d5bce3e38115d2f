"""File and console sinks; JSON message encoding (the Kafka value format)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions import schemas


def csv_sink(df: DataFrame, path: str, mode: str = "overwrite", header: bool = False) -> None:
    """Write CSV; quotes inside cells are doubled and cells with line breaks are quoted,
    so ``csv_json_cells`` / ``csv_table`` read the files back unchanged."""
    (df.write.mode(mode).option("header", header).option("escape", '"').option("quote", '"')
     .csv(path))


def to_json_messages(df: DataFrame, ts_format: str = schemas.MESSAGE_TS_FORMAT,
                     key_col: str | None = None) -> DataFrame:
    """One JSON object per row in ``value`` (plus ``key`` if given), the Kafka sink format."""
    opts = {"timestampFormat": ts_format, "timestampNTZFormat": ts_format}
    cols = [F.to_json(F.struct(*df.columns), opts).alias("value")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


def write_json_messages(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON messages as text files, one message per line (stands in for a topic)."""
    to_json_messages(df).write.mode(mode).text(path)


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """Streaming Kafka sink of JSON messages (needs the Kafka connector jar)."""
    return (to_json_messages(df).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


def show(df: DataFrame, n: int = 20, truncate: bool = False) -> None:
    """The ``print`` sink for batch results (inspection only; pulls n rows)."""
    df.show(n, truncate)
