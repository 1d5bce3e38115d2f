"""User functions from Python objects, and small built-in helpers.

``scalar_function`` turns an object with ``eval(*args)`` (state in its
attributes, any number of arguments) into a Spark UDF; ``vectorized=True``
builds the Arrow batch form instead (``eval`` then receives pandas Series).
Prefer native expressions: these run in a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: clock-time text of window bounds (24-hour clock).
CLOCK_FORMAT = "HH:mm:ss"


def scalar_function(obj, return_type, vectorized: bool = False, use_arrow: bool = True):
    if vectorized:
        return F.pandas_udf(lambda *cols: obj.eval(*cols), return_type)
    return F.udf(lambda *args: obj.eval(*args), return_type, useArrow=use_arrow)


def clock_text(c) -> Column:
    """Window bound as ``HH:mm:ss`` text (``hh`` would be the 12-hour clock)."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, CLOCK_FORMAT)
