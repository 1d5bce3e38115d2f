"""``hash(x) * factor`` over integer keys (scalar function of the udf job).

The reference multiplies Python's ``hash`` of an integer by a factor held by
the function object.  For integers Python's hash is deterministic:

    hash(i) = sign(i) * (|i| mod (2**61 - 1)),  except hash(-1) = -2

We offer the same value three ways:

* ``hash_code(col)``  - native Catalyst expression (default; stays in codegen),
* ``hash_code_udf``   - the row-at-a-time Python class with ``eval`` (API parity),
* ``hash_code_pandas``- the vectorised (Arrow) form.

The product is a BIGINT; like a JVM ``long`` multiply it wraps on overflow.
NULL in gives NULL out.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODULUS = (1 << 61) - 1  # Python's hash modulus on 64-bit builds
DEFAULT_FACTOR = 12


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def python_int_hash(c) -> Column:
    """Python's ``hash`` of a BIGINT, as a native expression (no overflow)."""
    x = _col(c).cast("bigint")
    pos = F.pmod(x, F.lit(MODULUS))
    # |x| mod M for negative x without negating Long.MinValue: |x| = -(x+1) + 1
    neg_abs = F.pmod(-(x + F.lit(1)), F.lit(MODULUS))
    neg = -F.pmod(neg_abs + F.lit(1), F.lit(MODULUS))
    h = F.when(x >= 0, pos).otherwise(neg)
    return F.when(h == -1, F.lit(-2)).otherwise(h)


def hash_code(c, factor: int = DEFAULT_FACTOR) -> Column:
    """``hash(c) * factor`` with JVM long wrap-around, fully native."""
    h = python_int_hash(c)
    if factor == DEFAULT_FACTOR:
        # |h| < 2**61 so 3*h fits; the shift then wraps exactly like a long multiply.
        return F.shiftleft(h * F.lit(3), 2)
    # generic factor: exact product in DECIMAL(38,0), then wrap into 64 bits
    prod = h.cast("decimal(38,0)") * F.lit(Decimal(factor)).cast("decimal(38,0)")
    two64 = F.lit(Decimal(1 << 64)).cast("decimal(38,0)")
    two63 = F.lit(Decimal(1 << 63)).cast("decimal(38,0)")
    return (F.pmod(prod + two63, two64) - two63).cast("bigint")


def _wrap64(v: int) -> int:
    return ((v + (1 << 63)) % (1 << 64)) - (1 << 63)


class HashCode:
    """Scalar function object with state (``factor``) and ``eval``."""

    def __init__(self, factor: int = DEFAULT_FACTOR):
        self.factor = factor

    def eval(self, s):
        if s is None:
            return None
        return _wrap64(hash(int(s)) * self.factor)

    __call__ = eval


def hash_code_udf(factor: int = DEFAULT_FACTOR, use_arrow: bool = True):
    """Row-at-a-time Python UDF (Arrow-batched transport by default)."""
    fn = HashCode(factor)
    return F.udf(lambda s: fn.eval(s), T.LongType(), useArrow=use_arrow)


def hash_code_pandas(factor: int = DEFAULT_FACTOR):
    """Vectorised form: one call per Arrow batch.  The column stays an Arrow array
    of 64-bit integers, so a NULL beside large values costs no digits."""

    @F.arrow_udf(T.LongType())
    def _hash_code(column: pa.Array) -> pa.Array:
        a = column.fill_null(0).to_numpy(zero_copy_only=False)
        # sign(i) * (|i| mod M) in int64 without overflow
        neg = a < 0
        absm = np.where(neg, (-(a + 1)) % MODULUS + 1, a) % MODULUS
        h = np.where(neg, -absm, absm)
        h = np.where(h == -1, -2, h)
        with np.errstate(over="ignore"):
            out = (h * np.int64(factor)).astype(np.int64)  # wraps like a JVM long
        return pa.array(out, pa.int64(), mask=column.is_null().to_numpy(zero_copy_only=False))

    return _hash_code


def register_sql_functions(spark: SparkSession, factor: int = DEFAULT_FACTOR) -> None:
    """Make the functions callable from SQL.

    ``hash_code2`` is a SQL function (inlined into the plan, no Python worker);
    ``hash_code_py`` is the Python UDF for parity with the row-at-a-time form.
    """
    m = MODULUS
    hh = (f"(CASE WHEN x >= 0 THEN pmod(x, {m}) "
          f"ELSE -pmod(pmod(-(x + 1), {m}) + 1, {m}) END)")
    h = f"(CASE WHEN {hh} = -1 THEN -2 ELSE {hh} END)"
    if factor == DEFAULT_FACTOR:
        product = f"shiftleft({h} * 3, 2)"
    else:
        product = (f"CAST(pmod(CAST({h} AS DECIMAL(38,0)) * {factor} + {1 << 63}, {1 << 64})"
                   f" - {1 << 63} AS BIGINT)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION hash_code2(x BIGINT) RETURNS BIGINT "
              f"RETURN {product}")
    spark.udf.register("hash_code_py", hash_code_udf(factor))
