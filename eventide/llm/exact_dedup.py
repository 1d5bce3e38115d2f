"""Exact deduplication as a stateful stream without expiry (SQL functions only).

Every arrival is one row of (digest, identifier, content locator).  A
Structured Streaming aggregate, kept in a RocksDB state store on disk and
never expired (no watermark), retains per digest the smallest identifier, the
locator of its content and how many rows arrived.  Texts never enter the
state.  A hit (a digest that more than one row carries) is settled on full
bytes: the text at the retained locator is fetched and compared, and rows that
share a digest but not the text form groups of their own.

Defined results
    null text            counts as the empty text
    null identifier      sorts after all others; it stays only in a group without any identifier
    repeated rows        the same identifier and text twice: one row stays, by locator
    ties                 by locator (file path, then position in the file)
    empty table          an empty result
    extra columns        kept out of the result of ``groups``; ``deduplicate`` returns the input's columns
    very long texts      hashed and compared whole; they move only when their digest is a hit
"""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import BLANKS, written, written_as
from eventide.session import shared_path
from eventide.streaming.runtime import rocksdb_conf

#: Bytes of arrivals (digest rows) per micro-batch.
BATCH_BYTES = 512 << 20
#: Native memory of all state stores of one executor, MB.
STATE_MEMORY_MB = 256


def normalised(text: str = "text") -> Column:
    """The compared form: each run of blanks is one space; null is empty."""
    c = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return F.regexp_replace(c, BLANKS, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def from_files(docs: DataFrame) -> DataFrame:
    """``docs`` itself if it reads files straight away, else written and read back:
    rows then have addresses that do not change."""
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
        return docs
    except AnalysisException:  # no file source right below
        return written(docs, "dedup-content")


def addressed(docs: DataFrame) -> DataFrame:
    """(row, loc) of a frame that reads files: each row as one struct, which
    clashes with no other name, and its address (file path, position)."""
    at = docs.metadataColumn("_metadata")
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                       F.struct(at["file_path"].alias("path"), at["row_index"].alias("row")).alias("loc"))


def retained(spark: SparkSession, arrivals: str, state: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Fold all arrivals under ``arrivals`` not yet folded into the state at
    ``state``; return (digest, first, seen) per digest.

    Call it again with the same ``state`` after new files have arrived: only
    those are read.  Each micro-batch writes the digests it changed; the
    newest version of a digest is its state.
    """
    schema = spark.read.parquet(arrivals).schema
    stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).parquet(arrivals)
    folded = (stream.groupBy("digest")
              .agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "loc")).alias("first"),
                   F.count(F.lit(1)).alias("seen")))

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state}/changes/batch={batch_id}")

    conf = rocksdb_conf() | {
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        # Many small stores: do not reserve disk ahead of use.
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
        "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": str(STATE_MEMORY_MB),
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        q = (folded.writeStream.outputMode("update").foreachBatch(keep)
             .option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    changes = f"{state}/changes"
    empty = T.StructType([*folded.schema.fields, T.StructField("batch", T.IntegerType())])
    try:
        versions = spark.read.schema(empty).option("basePath", changes).parquet(f"{changes}/batch=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # else: nothing has ever arrived
            raise
        return spark.createDataFrame([], empty).drop("batch")
    newest = versions.groupBy("digest").agg(F.max_by(F.struct("first", "seen"), "batch").alias("s"))
    # Written: a join of two plain exchanges is one that Spark splits where a digest is hot.
    return written(newest.select("digest", "s.first", "s.seen"), "dedup-newest")


def fetched(locs: DataFrame, text_col: str) -> DataFrame:
    """(digest, loc, body) of (digest, loc): the compared texts, read from the files that the locators name."""
    spark = locs.sparkSession
    paths = [r["path"] for r in locs.select("loc.path").distinct().collect()]
    if not paths:
        return locs.withColumn("body", F.lit(""))
    # Locators hold encoded paths, the reader takes patterns.
    plain = [re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(p)) for p in paths]
    rows = addressed(spark.read.parquet(*plain)).select("loc", normalised(f"row.{text_col}").alias("body"))
    return rows.join(locs, "loc").select("digest", "loc", "body")


def _continued(docs: DataFrame, light: DataFrame, arrivals: str, state: str, text_col: str) -> DataFrame:
    """``groups`` over a state with rows of earlier calls.

    Hits are compared with their owners, wherever these lie.  Digests that
    unequal texts share are kept beside the state, and their rows of all calls
    are regrouped by the texts themselves.
    """
    spark = docs.sparkSession
    hits = light.where("seen > 1 AND loc <> first.loc").select("digest", "loc")
    owners = written(light.join(hits, "digest", "left_semi").select("digest", F.col("first.loc").alias("loc")).distinct(),
                     "dedup-owners")
    content = fetched(owners, text_col).select("digest", F.col("body").alias("kept_body"))
    own = addressed(docs).select("loc", normalised(f"row.{text_col}").alias("body")).join(hits, "loc")
    own.join(content, "digest").where("body <> kept_body").select("digest").distinct().write.mode("append").parquet(
        f"{state}/shared")
    shared = spark.read.parquet(f"{state}/shared").distinct()
    every = written(spark.read.parquet(f"{state}/arrivals").join(shared, "digest"), "dedup-shared")
    bodies = written(fetched(every.select("digest", "loc"), text_col), "dedup-shared-bodies")
    regrouped = bodies.join(every.select("loc", "id"), "loc").groupBy("digest", "body").agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "loc")).alias("first2"),
        F.count(F.lit(1)).alias("seen2"))
    now = spark.read.parquet(arrivals).select("loc")
    moved = bodies.join(now, "loc", "left_semi").join(regrouped, ["digest", "body"]).select("loc", "first2", "seen2")
    out = light.join(moved, "loc", "left")
    first = F.coalesce("first2", "first")
    return out.select("id", first["id"].alias("keep_id"), F.coalesce("seen2", "seen").alias("group_size"),
                      (F.col("loc") == first["loc"]).alias("kept"), F.col("sha").alias("text_sha256"), "loc")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           digest: Callable[[Column], Column] = sha256, state: str | None = None,
           batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, locator.

    ``digest`` maps the normalised text to a string; equal texts must give
    equal digests, and unequal ones are told apart by their bytes.  With the
    ``state`` of earlier calls, rows are grouped with the rows of those, too;
    their files must still be there.
    """
    spark, docs = docs.sparkSession, from_files(docs)
    rows = addressed(docs).select(F.col(f"row.{id_col}").alias("id"), "loc",
                                  normalised(f"row.{text_col}").alias("body"))
    hashed = rows.select(digest(F.col("body")).alias("digest"), "id", "loc", sha256(F.col("body")).alias("sha"))
    arrivals = written_as(hashed, "dedup-arrivals")
    if state:
        spark.read.parquet(arrivals).write.mode("append").parquet(f"{state}/arrivals")
        kept = retained(spark, f"{state}/arrivals", state, batch_bytes)
        return _continued(docs, spark.read.parquet(arrivals).join(kept, "digest"), arrivals, state, text_col)
    kept = retained(spark, arrivals, shared_path(spark, "dedup-state"), batch_bytes)
    light = spark.read.parquet(arrivals).join(kept, "digest")

    # Hits: compare with the full bytes at the retained locator.  Which rows
    # those are is known from the arrivals, so texts are dealt out once, by locator.
    hits = light.where("seen > 1").select("loc", "digest", (F.col("loc") == F.col("first.loc")).alias("owner"))
    bodies = rows.select("loc", "body").join(hits, "loc")
    content = bodies.where("owner").select("digest", F.col("body").alias("kept_body"))
    clash = (bodies.where("NOT owner").join(content, "digest").where(F.col("body") != F.col("kept_body"))
             .select("digest", "loc", "body"))
    clash = written(clash, "dedup-clashes")
    if clash.isEmpty():
        return light.select("id", F.col("first.id").alias("keep_id"), F.col("seen").alias("group_size"),
                            (F.col("loc") == F.col("first.loc")).alias("kept"), F.col("sha").alias("text_sha256"),
                            "loc")
    # Unequal texts under one digest: regroup those rows by the text itself.
    own = clash.join(spark.read.parquet(arrivals).select("loc", "id"), "loc")
    regrouped = own.groupBy("digest", "body").agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "loc")).alias("first2"),
        F.count(F.lit(1)).alias("seen2"))
    moved = own.join(regrouped, ["digest", "body"]).select("loc", "first2", "seen2")
    lost = clash.groupBy("digest").agg(F.count(F.lit(1)).alias("lost"))
    out = light.join(moved, "loc", "left").join(lost, "digest", "left")
    first = F.coalesce("first2", "first")
    return out.select("id", first["id"].alias("keep_id"),
                      F.coalesce("seen2", F.col("seen") - F.coalesce("lost", F.lit(0))).alias("group_size"),
                      (F.col("loc") == first["loc"]).alias("kept"), F.col("sha").alias("text_sha256"), "loc")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    docs = from_files(docs)
    stay = groups(docs, id_col, text_col).where("kept").select("loc")
    return addressed(docs).join(stay, "loc", "left_semi").select("row.*")
