"""Row filters of the click jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _watermarked(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if "spark.watermarkDelayMs" in f.metadata]


def filter_rows(df: DataFrame, cond: Column) -> DataFrame:
    """``df.where(cond)``, keeping a stream's watermark on the whole source.

    Catalyst pushes a predicate below the watermark when it does not refer to
    the event-time column; the watermark would then follow only the rows that
    pass.  A table's WATERMARK clause covers every row of the source, so on a
    watermarked input the condition is folded into one predicate that reads
    the event time (rows without event time never enter a window anyway):
    ``CASE WHEN cond THEN ts END IS NOT NULL`` is true exactly when ``cond``
    holds and ``ts`` is set, and no rewrite splits it.
    """
    ev = _watermarked(df)
    if ev:
        cond = F.when(cond, F.col(ev[0])).isNotNull()
    return df.where(cond)


def live_clicks(df: DataFrame) -> DataFrame:
    """``action = 'click' AND is_delete = 0`` (NULL in either drops the row).

    On batch input it is a plain deterministic filter that Catalyst pushes
    into the scan or below the window expansion.
    """
    return filter_rows(df, (F.col("action") == "click") & (F.col("is_delete") == 0))
