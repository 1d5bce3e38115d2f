"""File sources: CSV tables, CSV with multi-line JSON cells, parquet tables.

Each takes ``stream=True`` to return a Structured Streaming DataFrame over
the same files (new files are picked up per micro-batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.functions import schemas


def _reader(spark: SparkSession, stream: bool, max_files_per_trigger: int | None = None):
    if not stream:
        return spark.read
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r


def csv_table(spark: SparkSession, path: str, schema: str = schemas.WORDS, header: bool = False,
              stream: bool = False, **options) -> DataFrame:
    """Headerless CSV with a declared schema (no inference pass over the data)."""
    r = _reader(spark, stream).schema(schema).option("header", header).option("mode", "PERMISSIVE")
    for k, v in options.items():
        r = r.option(k, v)
    return r.csv(path)


def csv_json_cells(spark: SparkSession, path: str, schema: str = schemas.INPUT_TABLE,
                   stream: bool = False) -> DataFrame:
    """CSV whose cells hold quoted JSON spanning lines, quotes doubled inside.

    ``multiLine`` lets a quoted cell cross line breaks and ``escape='"'`` reads
    doubled quotes; a leading UTF-8 byte-order mark is dropped by the reader.
    An empty cell reads as NULL.  Multi-line CSV is not splittable, so input
    parallelism comes from the number of files.
    """
    return (_reader(spark, stream).schema(schema)
            .option("multiLine", True).option("escape", '"').option("quote", '"')
            .option("encoding", "UTF-8").csv(path))


def parquet_table(spark: SparkSession, sf_dir: str, name: str, stream: bool = False,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """One of the driver's tables, ``<sf_dir>/<name>.parquet``, as batch or stream."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if not stream:
        return spark.read.parquet(path)
    schema = spark.read.parquet(path).schema  # footer only
    r = _reader(spark, True, max_files_per_trigger).schema(schema)
    # A stream source needs a directory; a single-file table is selected by glob.
    return r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def parquet_dir(spark: SparkSession, path: str, schema=None, stream: bool = False,
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = _reader(spark, stream, max_files_per_trigger)
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)
