"""Tumbling, sliding (hop) and session windows on event time.

Each operator groups ``df`` by a time window and ``keys`` and returns
``start_time, end_time, <keys>, <aggregates>``.  Aggregates are given as
``Agg`` specs; all of them are mergeable (count, sum, min, max, avg), which
lets the pane and bucket plans below pre-aggregate before any window fan-out.

Plans
-----
* ``tumble_agg``: one hash aggregate (partial before the shuffle).
* ``hop_agg(strategy="direct")``: Spark's ``window(ts, size, slide)`` expands
  each row into size/slide copies before the partial aggregate.
  ``strategy="panes"`` first aggregates slide-wide panes per key (partial
  aggregate, one row per non-empty (pane, key)), then expands panes into
  windows: the fan-out applies to panes instead of rows.  Worth it only when
  many rows share a (pane, key) (dense streams, few keys); on sparse data it
  adds a shuffle and the expansion runs after it, in as many tasks as AQE
  leaves to the small pane table.  ``"auto"`` therefore means ``"direct"``;
  pass ``"panes"`` for dense input (batch or stream: on a stream the two
  aggregations are chained stateful operators linked by ``window_time``).
* ``session_agg(strategy="buckets")``: skew-safe sessions.  Two events closer
  than ``gap`` belong to one session, so all events of a key inside one
  gap-wide time bucket share a session: they are pre-aggregated to one row
  per (key, bucket) with a partial aggregate.  Buckets are cut into chunks of
  ``chunk`` consecutive buckets; inside a chunk a window (bounded: at most
  ``chunk`` rows) compares each bucket with the previous one (an empty
  bucket between always means a gap larger than ``gap``) and keeps a
  running max of session starts.  A per-chunk summary (a few rows per key)
  links chunks: does the first bucket start a session, and what is the last
  start of all earlier chunks.  One join back to that summary gives every
  bucket its session, so no task ever holds all rows of a hot key.
  ``strategy="native"`` uses Spark's ``session_window`` (one sorted run per
  key); streams use it (see ``eventide.streaming``).

Spark's session semantics hold in both: an event at ``t`` opens ``[t, t+gap)``
and sessions merge when they overlap or touch (events exactly ``gap`` apart
share a session); the end is the last event + gap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.operators.timeutil import duration_micros, from_micros, is_ntz, require_utc, spread, to_micros


@dataclass(frozen=True)
class Agg:
    kind: str            # count | sum | min | max | avg
    column: str | None   # None for count(*)
    alias: str


def count_(alias: str = "cnt", column: str | None = None) -> Agg:
    return Agg("count", column, alias)


def sum_(column: str, alias: str) -> Agg:
    return Agg("sum", column, alias)


def min_(column: str, alias: str) -> Agg:
    return Agg("min", column, alias)


def max_(column: str, alias: str) -> Agg:
    return Agg("max", column, alias)


def avg_(column: str, alias: str) -> Agg:
    return Agg("avg", column, alias)


def _direct(a: Agg) -> Column:
    c = F.col(a.column) if a.column else None
    if a.kind == "count":
        return (F.count(c) if c is not None else F.count(F.lit(1))).alias(a.alias)
    return {"sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}[a.kind](c).alias(a.alias)


def _partial(a: Agg) -> list[Column]:
    """Columns of the mergeable partial state of ``a``."""
    p = f"_p_{a.alias}"
    c = F.col(a.column) if a.column else None
    if a.kind == "count":
        return [(F.count(c) if c is not None else F.count(F.lit(1))).alias(p)]
    if a.kind == "avg":
        return [F.sum(c).alias(p + "_s"), F.count(c).alias(p + "_n")]
    return [{"sum": F.sum, "min": F.min, "max": F.max}[a.kind](c).alias(p)]


def _merge(a: Agg) -> Column:
    p = f"_p_{a.alias}"
    if a.kind == "count":
        return F.sum(p).cast("bigint").alias(a.alias)
    if a.kind == "avg":
        return (F.sum(p + "_s") / F.sum(p + "_n")).alias(a.alias)
    return {"sum": F.sum, "min": F.min, "max": F.max}[a.kind](p).alias(a.alias)


def _bounds(w: str, keys, aggs) -> list[Column]:
    return [F.col(f"{w}.start").alias("start_time"), F.col(f"{w}.end").alias("end_time"),
            *[F.col(k) for k in keys], *[F.col(a.alias) for a in aggs]]


def tumble_agg(df: DataFrame, ts: str, size: str, keys: list[str], aggs: list[Agg]) -> DataFrame:
    w = F.window(ts, size).alias("_w")
    return df.groupBy(w, *keys).agg(*[_direct(a) for a in aggs]).select(*_bounds("_w", keys, aggs))


def hop_agg(df: DataFrame, ts: str, size: str, slide: str, keys: list[str], aggs: list[Agg],
            strategy: str = "auto", spread_to: int | None = None) -> DataFrame:
    """``spread_to`` deals an input that cannot be split out to so many tasks before the fan-out."""
    size_us, slide_us = duration_micros(size), duration_micros(slide)
    if strategy == "auto":
        strategy = "direct"
    if size_us != slide_us:
        df = spread(df, spread_to)  # each row becomes size/slide window rows
    if strategy == "direct" or size_us == slide_us:
        w = F.window(ts, size, slide).alias("_w")
        return df.groupBy(w, *keys).agg(*[_direct(a) for a in aggs]).select(*_bounds("_w", keys, aggs))
    if strategy != "panes":
        raise ValueError(strategy)
    if size_us % slide_us:
        raise ValueError("panes need size to be a multiple of slide")
    partials = [c for a in aggs for c in _partial(a)]
    panes = df.groupBy(F.window(ts, slide).alias("_p"), *keys).agg(*partials)
    if not df.isStreaming:
        # Panes are few and small, and AQE merges them into a task or two; each is
        # about to become size/slide rows, so they are dealt out evenly again.
        panes = panes.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # A pane lies inside a window iff its last instant does; window_time() gives
    # that instant and keeps event-time semantics on streams.
    w = F.window(F.window_time("_p"), size, slide).alias("_w")
    return panes.groupBy(w, *keys).agg(*[_merge(a) for a in aggs]).select(*_bounds("_w", keys, aggs))


def session_agg(df: DataFrame, ts: str, gap: str, keys: list[str], aggs: list[Agg],
                strategy: str = "buckets", chunk: int = 1024) -> DataFrame:
    if df.isStreaming:
        strategy = "native"  # the bucket plan's joins and windows are batch-only
    if strategy == "native":
        w = F.session_window(ts, gap).alias("_w")
        return df.groupBy(*keys, w).agg(*[_direct(a) for a in aggs]).select(*_bounds("_w", keys, aggs))
    if strategy != "buckets":
        raise ValueError(strategy)
    g = duration_micros(gap)
    ntz = is_ntz(df, ts)
    if ntz:
        require_utc(df.sparkSession)
    t = to_micros(F.col(ts))
    # 1. exact pre-aggregation per (key, gap-wide bucket); buckets are grouped
    #    into chunks of `chunk` consecutive buckets
    parts = (df.where(F.col(ts).isNotNull())
             .groupBy(*keys, F.floor(t / F.lit(g)).alias("_b"))
             .agg(F.min(t).alias("_lo"), F.max(t).alias("_hi"),
                  *[c for a in aggs for c in _partial(a)])
             .withColumn("_c", F.floor(F.col("_b") / F.lit(chunk))))
    # Both branches below read the buckets: they are dealt out once, by (key, chunk),
    # and the exchange is reused, so that the input is read once.  That takes the same
    # columns in both, which is why the summary's last bucket is a maximum over all.
    parts = parts.repartition(*[F.col(k) for k in keys], F.col("_c"))
    pcols = [c for c in parts.columns if c.startswith("_p_")]
    # 2. inside a chunk (at most `chunk` rows): a bucket starts a session when the
    #    previous bucket is not adjacent (an empty bucket between means a gap
    #    over `gap`) or ends more than `gap` before it; running max of starts.
    w = Window.partitionBy(*keys, "_c").orderBy("_b")
    local = (parts
             .withColumn("_is_first", F.lag("_b").over(w).isNull())
             .withColumn("_start", F.when(~F.col("_is_first") & (
                 (F.lag("_b").over(w) != F.col("_b") - 1) | (F.col("_lo") - F.lag("_hi").over(w) > g)), F.col("_b")))
             .withColumn("_sid", F.max("_start").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    # 3. per chunk: its first and last bucket and last local start; across the
    #    chunks of a key (a few rows per key): whether the first bucket starts a
    #    session, and the last start of all earlier chunks.
    wc = Window.partitionBy(*keys).orderBy("_c")
    chunks = (local.groupBy(*keys, "_c").agg(
                  F.min("_b").alias("_fb"), F.min("_lo").alias("_flo"), F.max(F.struct("_b", *pcols))["_b"].alias("_lb"),
                  F.max("_hi").alias("_lhi"), F.max("_start").alias("_ls"))
              .withColumn("_first_start", F.lag("_lb").over(wc).isNull()
                          | (F.lag("_lb").over(wc) != F.col("_fb") - 1)
                          | (F.col("_flo") - F.lag("_lhi").over(wc) > g))
              .withColumn("_last_start", F.coalesce(
                  "_ls", F.when(F.col("_first_start"), F.col("_fb"))))
              .withColumn("_carry", F.max("_last_start").over(
                  wc.rowsBetween(Window.unboundedPreceding, -1)))
              .select(*keys, "_c", "_fb", "_first_start", "_carry"))
    lo, ch = local.alias("l"), chunks.alias("c")
    # (null-safe for the chunk, too: a not-null filter on one side only would split the exchange in two)
    cond = [F.col(f"l.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys] + [F.col("l._c").eqNullSafe(F.col("c._c"))]
    sessions = (lo.join(ch, cond, "inner")
                .select(*[F.col(f"l.{k}").alias(k) for k in keys], "l._lo", "l._hi",
                        *[F.col(f"l.{c}") for c in pcols],
                        F.coalesce(F.col("l._sid"), F.when(F.col("c._first_start"), F.col("c._fb")),
                                   F.col("c._carry")).alias("_session")))
    # 4. merge the bucket partials of each session
    out = sessions.groupBy(*keys, "_session").agg(
        F.min("_lo").alias("_s"), F.max("_hi").alias("_e"), *[_merge(a) for a in aggs])
    return out.select(from_micros(F.col("_s"), ntz).alias("start_time"),
                      from_micros(F.col("_e") + F.lit(g), ntz).alias("end_time"),
                      *[F.col(k) for k in keys], *[F.col(a.alias) for a in aggs])
