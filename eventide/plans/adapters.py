"""The reference jobs' tables, derived from the driver's ``events`` table.

``events(event_id, ts, user_id, event_type, value, props)`` stands in for
the click and metric messages: ``event_type`` for sex / cluster,
``user_id`` for the user name, ``value`` for the CPU reading.  The click
fields the table lacks are read from ``props`` (``{"k": <int 0..99>}``):
``action`` is 'scroll' for k >= 90 (about 10 %, as in the click producer)
and ``is_delete`` is 1 for k < 10.  Every adapter is a projection, so it
works on batch and streaming input and keeps the scan pruned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds on props.k that define action / is_delete.
SCROLL_FROM_K = 90
DELETED_BELOW_K = 10


def props_k(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").try_cast("int")


def words(events: DataFrame) -> DataFrame:
    """words(id BIGINT, word STRING)."""
    return events.select(F.col("event_id").alias("id"), F.col("event_type").alias("word"))


def user_actions(events: DataFrame) -> DataFrame:
    """user_action(name, sex, action, is_delete, ts)."""
    k = props_k()
    return events.select(
        F.col("user_id").cast("string").alias("name"),
        F.col("event_type").alias("sex"),
        F.when(k >= SCROLL_FROM_K, F.lit("scroll")).otherwise(F.lit("click")).alias("action"),
        F.when(k < DELETED_BELOW_K, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("is_delete"),
        F.col("ts"))


def cpu_usage(events: DataFrame) -> DataFrame:
    """cluster_cpu_usage(cluster_name, host_ip, cpu_usage, ts)."""
    return events.select(
        F.col("event_type").alias("cluster_name"),
        F.concat(F.lit("10.0."), (F.col("user_id") / 256).cast("int").cast("string"), F.lit("."),
                 F.pmod(F.col("user_id"), F.lit(256)).cast("string")).alias("host_ip"),
        F.col("value").alias("cpu_usage"),
        F.col("ts"))


def _item(name: Column, name_id: Column, b1_id: Column, b2_id: Column, b2: Column, b1: Column) -> Column:
    return F.struct(name.alias("bs3_name"), name_id.alias("bs3_name_id"), b1_id.alias("bs1_name_id"),
                    b2_id.alias("bs2_name_id"), b2.alias("bs2_name"), b1.alias("bs1_name"))


def input_table(events: DataFrame) -> DataFrame:
    """input_table(id, bs_info): a JSON array kept as (pretty, multi-line) text.

    click -> one object; view -> two objects (the second gives its first id as
    text); purchase -> '[]'; signup -> ''; error -> NULL.
    """
    uid, eid, k = F.col("user_id"), F.col("event_id"), props_k()
    first = _item(F.col("event_type"), uid, eid, k, F.concat(F.lit("u"), uid.cast("string")),
                  F.concat(F.lit("e"), eid.cast("string")))
    second = _item(F.lit("view2"), (uid + 1).cast("string"), eid + 1, k + 1,
                   F.concat(F.lit("v"), uid.cast("string")), F.lit("view"))
    pretty = {"pretty": "true"}
    bs = (F.when(F.col("event_type") == "click", F.to_json(F.array(first), pretty))
          .when(F.col("event_type") == "view", F.to_json(F.array(first, second), pretty))
          .when(F.col("event_type") == "purchase", F.lit("[]"))
          .when(F.col("event_type") == "signup", F.lit("")))
    return events.select(F.concat(F.lit("x"), eid.cast("string")).alias("id"), bs.alias("bs_info"))


def changes(events: DataFrame) -> DataFrame:
    """Change records keyed by user: ``error`` deletes the user, ``signup``
    inserts, other events update; ``view`` also moves the key (its before image
    carries user_id + 1000).  ``seq`` is the event id."""
    uid = F.col("user_id").cast("int")
    op = (F.when(F.col("event_type") == "error", F.lit("d"))
          .when(F.col("event_type") == "signup", F.lit("c")).otherwise(F.lit("u")))
    before_id = F.when(F.col("event_type") == "view", uid + 1000).otherwise(uid)
    row = lambda i, w: F.struct(i.alias("id"), w.alias("word"))
    return events.select(
        op.alias("op"), F.col("event_id").alias("seq"),
        F.when(op != "c", row(before_id, F.lit(None).cast("string"))).alias("before"),
        F.when(op != "d", row(uid, F.col("event_type"))).alias("after"))
