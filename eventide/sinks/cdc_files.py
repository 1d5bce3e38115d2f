"""Keyed snapshot of folded change records, as versioned key-hash buckets.

Layout below ``path``:

    data/v=<n>/bucket=<b>/   rows of bucket ``b`` as version ``n`` wrote them: every key with
                             pmod(xxhash64(key), buckets) = b once (``key, seq, deleted,
                             <values>``; deletes stay as tombstones)
    manifest/<n>.json        version ``n``: the bucket count, for each bucket the version that
                             holds it, and for each query the last batch it has folded

A batch of changes rewrites only the buckets it touches, into a folder of its
own, and is published by its manifest, written last and in one step.  Readers
and writers go by the newest manifest, so a crash at any point leaves the
version before it whole.  A replayed batch is recognised by (query, batch);
one that was not recorded folds again, which changes nothing, as the newest
``seq`` per key wins.  The bucket count is the table's: another one is refused
(``rebucket`` rewrites the table).

One writer at a time.  Choose ``buckets`` so that one bucket holds roughly what
a batch may rewrite (e.g. state size / 1 GB); the list of touched buckets (at
most ``buckets`` ints) goes through the driver.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators import cdc

DEFAULT_BUCKETS = 64
#: Published versions whose files are kept: readers of the one before last can finish.
RETAIN = 2


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _manifests(spark: SparkSession, path: str) -> list[int]:
    fs, p, _ = _fs(spark, f"{path}/manifest")
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def _load(spark: SparkSession, path: str, version: int) -> dict:
    return json.loads(spark.read.option("wholetext", True).text(f"{path}/manifest/{version}.json").first()[0])


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest published manifest, or None."""
    versions = _manifests(spark, path)
    return _load(spark, path, versions[-1]) if versions else None


def _publish(spark: SparkSession, path: str, m: dict) -> None:
    fs, final, jvm = _fs(spark, f"{path}/manifest/{m['version']}.json")
    part = jvm.org.apache.hadoop.fs.Path(f"{path}/manifest/{m['version']}.{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(m).encode()))
    out.close()
    if not fs.rename(part, final):
        raise RuntimeError(f"version {m['version']} of {path} was published by another writer")
    _drop_unused(spark, path)


def _drop_unused(spark: SparkSession, path: str) -> None:
    """Remove versions that none of the last ``RETAIN`` manifests names."""
    versions = _manifests(spark, path)
    keep = versions[-RETAIN:]
    used = {v for k in keep for v in _load(spark, path, k)["held"].values()} | {keep[-1]}
    fs, data, jvm = _fs(spark, f"{path}/data")
    if fs.exists(data):
        for st in fs.listStatus(data):
            v = int(st.getPath().getName()[2:])
            if v < keep[-1] and v not in used:
                fs.delete(st.getPath(), True)
    for v in versions[:-RETAIN]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/manifest/{v}.json"), False)


def _read(spark: SparkSession, path: str, m: dict, buckets: list[int] | None = None) -> DataFrame | None:
    """Rows of the given buckets (all if None) as manifest ``m`` names them."""
    at = [f"{path}/data/v={v}/bucket={b}" for b, v in m["held"].items() if buckets is None or int(b) in buckets]
    return spark.read.parquet(*at) if at else None


def _write(rows: DataFrame, path: str, version: int) -> None:
    # REBALANCE keeps a bucket's rows together (few files per bucket) while AQE
    # splits a bucket that is too large for one task and merges small ones.
    rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/v={version}")


def fold_into_buckets(changes: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS, key: str = "id",
                      value_cols: list[str] | None = None, batch: tuple[str, int] | None = None) -> int:
    """Fold a batch of change records into the snapshot at ``path``; returns the
    number of buckets rewritten.  ``batch`` is (query identity, batch id)."""
    spark = changes.sparkSession
    value_cols = value_cols or ["word"]
    now = manifest(spark, path) or {"version": 0, "buckets": buckets, "held": {}, "batches": {}}
    if now["buckets"] != buckets:
        raise ValueError(f"{path} has {now['buckets']} buckets, not {buckets}: use rebucket() to change that")
    if batch and now["batches"].get(batch[0], -1) >= batch[1]:
        return 0
    # The batch is folded once, into a table: both the list of its buckets and the merge read that.
    staged = f"{path}/staged-{uuid.uuid4().hex}"
    (cdc.fold_changes(changes, None, key, value_cols).withColumn("bucket", _bucket(key, buckets))
     .write.parquet(staged))
    try:
        folded = spark.read.parquet(staged)
        touched = sorted(r[0] for r in folded.select("bucket").distinct().collect())  # at most `buckets` ints
        if touched:
            old = _read(spark, path, now, touched)
            rows = folded
            if old is not None:
                columns = [c for c in folded.columns if c != "bucket"]
                rows = (cdc.fold_changes(old.select(*columns).unionByName(folded.select(*columns)), None, key,
                                         value_cols, normalized=True).withColumn("bucket", _bucket(key, buckets)))
            _write(rows, path, now["version"] + 1)
            version = now["version"] + 1
            _publish(spark, path, {"version": version, "buckets": buckets,
                                   "held": {**now["held"], **{str(b): version for b in touched}},
                                   "batches": {**now["batches"], **({batch[0]: batch[1]} if batch else {})}})
        return len(touched)
    finally:
        fs, p, _ = _fs(spark, staged)
        fs.delete(p, True)


def rebucket(spark: SparkSession, path: str, buckets: int, key: str = "id") -> None:
    """Rewrite the snapshot with another bucket count, as its next version."""
    now = manifest(spark, path)
    if now is None or now["buckets"] == buckets:
        return
    version = now["version"] + 1
    _write(_read(spark, path, now).withColumn("bucket", _bucket(key, buckets)), path, version)
    fs, p, _ = _fs(spark, f"{path}/data/v={version}")
    held = [st.getPath().getName() for st in fs.listStatus(p)]
    _publish(spark, path, {"version": version, "buckets": buckets, "batches": now["batches"],
                           "held": {n[7:]: version for n in held if n.startswith("bucket=")}})


def drop_tombstones(spark: SparkSession, path: str, before_seq: int) -> None:
    """Forget deleted keys whose last record is older than ``before_seq`` (off unless called).

    Changes with a ``seq`` below that must not arrive any more: they would revive the key.
    """
    now = manifest(spark, path)
    if now is None:
        return
    version = now["version"] + 1
    rows = _read(spark, path, now).where(~(F.col("deleted") & (F.col("seq") < before_seq)))
    key = rows.columns[0]
    _write(rows.withColumn("bucket", _bucket(key, now["buckets"])), path, version)
    fs, p, _ = _fs(spark, f"{path}/data/v={version}")
    held = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    _publish(spark, path, {**now, "version": version, "held": {n[7:]: version for n in held if n.startswith("bucket=")}})


def read_snapshot(spark: SparkSession, path: str, key: str = "id", value_cols: list[str] | None = None) -> DataFrame | None:
    """Live rows of the snapshot (each key is stored once: no shuffle); None before the first batch."""
    m = manifest(spark, path)
    rows = _read(spark, path, m) if m else None
    return None if rows is None else cdc.live_rows(rows, key, value_cols)
