"""eventide: table and stream analytics jobs expressed as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame`` (or a writer that takes
one); where Spark allows it the same function runs on batch and on Structured
Streaming input.
"""

import sys as _sys

from eventide.session import get_session, shared_path

# Python functions defined here (UDFs, the UDTF, foreachBatch steps) are
# shipped to Python workers by value, so executors need no copy of this
# package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # older cloudpickle: ship the package with SparkContext.addPyFile instead
    pass

__all__ = ["get_session", "shared_path"]
__version__ = "0.1.0"
