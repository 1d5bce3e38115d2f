import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventide.functions import clock_text, scalar_function
from eventide.operators import word_count


def test_variadic_scalar_function(spark):
    class Joiner:  # defined here so that it is shipped to the Python workers by value
        """Variadic function object with state."""

        def __init__(self, sep):
            self.sep = sep

        def eval(self, *args):
            if isinstance(args[0], pd.Series):
                out = args[0].astype(str)
                for a in args[1:]:
                    out = out + self.sep + a.astype(str)
                return out
            return self.sep.join(str(a) for a in args)

    df = spark.createDataFrame([(1, "a", 2.5)], "x int, y string, z double")
    row = df.select(scalar_function(Joiner("-"), "string")("x", "y", "z").alias("r"),
                    scalar_function(Joiner("+"), "string", vectorized=True)("x", "y").alias("v")).first()
    assert row["r"] == "1-a-2.5" and row["v"] == "1+a"


def test_clock_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 13, 5, 9),)], "t timestamp_ntz")
    assert df.select(clock_text("t").alias("c")).first()["c"] == "13:05:09"


def test_update_stream_refused_by_append_sink(spark, tmp_path):
    (tmp_path / "w.csv").write_text("1,a\n")
    words = spark.readStream.schema("id BIGINT, word STRING").csv(str(tmp_path))
    with pytest.raises(Exception, match="(?i)append|watermark"):
        (word_count(words).writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").start())


def test_package_functions_ship_to_workers_by_value(tmp_path):
    """Python workers need no copy of the package: run from a folder where it is not importable."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {repo!r})\n"
            "from eventide import get_session\n"
            "from eventide.functions import hash_code_udf\n"
            "from pyspark.sql import functions as F\n"
            "s = get_session('local[2]', 2); s.sparkContext.setLogLevel('ERROR')\n"
            "print('OUT', s.range(3).select(hash_code_udf()(F.col('id')).alias('h')).collect())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env, capture_output=True, text=True,
                         timeout=300)
    assert "OUT [Row(h=0), Row(h=12), Row(h=24)]" in out.stdout, out.stderr[-2000:]
