"""Session construction and the shared work folder.

Jobs that must cut lineage or keep state (stream checkpoints, file sinks,
snapshot tables) write below the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (unit tests, a
laptop) do we pick a local folder and register it as the checkpoint dir.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Time windows align to the UTC epoch and
# TIMESTAMP(3)-without-zone columns are read as wall-clock UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "eventide", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # Session-level settings also apply to a session that already existed.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Read from the session (``spark.checkpoint.dir`` or the SparkContext's
    checkpoint dir).  If neither is set, a local master gets a local folder, as
    in tests; on a cluster that folder would be another one on every machine,
    so a missing setting is an error there.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all of {sc.master} shares")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="eventide-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder (never reused)."""
    return f"{checkpoint_root(spark)}/eventide/{name}-{uuid.uuid4().hex[:12]}"
