"""The stream jobs: event-time windows, window top-N, running top-N, CDC mirror.

Every job takes a streaming DataFrame shaped like the batch input (see
``eventide.plans.adapters``), marks event time with the 5 s watermark unless
the source already declares one (declare it at the source, before filters),
and runs to a table.  ``start_*`` starts a job and returns its query (several
jobs then run side by side under an interval trigger); ``run_*`` starts it,
waits for its end and returns the table.  A job's checkpoint lies at
``StreamOptions.checkpoint``, else below its ``path``; jobs of several queries
keep one sub-folder for each.  Windows are emitted in append mode once the watermark
passes their end, so at the end of input the windows with
``end_time <= max(ts) - 5 s`` are final and present.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions import schemas
from eventide.operators import cdc
from eventide.operators.timeutil import duration_micros, to_micros, with_event_time
from eventide.operators.topn import (hops_evenly, pane_of, pane_window_counts, rank_counts, start_and_end,
                                     topn_json_from_counts)
from eventide.operators.windows import Agg, count_, hop_agg, session_agg, tumble_agg
from eventide.session import shared_path
from eventide.streaming import runtime as rt


def window_agg_stream(stream: DataFrame, kind: str, keys: list[str], aggs: list[Agg], size: str,
                      slide: str | None = None, ts: str = "ts",
                      delay: str = schemas.WATERMARK_DELAY, strategy: str = "direct") -> DataFrame:
    """Streaming DataFrame of final window aggregates (append mode).

    ``strategy="panes"`` (hop only) pre-aggregates slide-wide panes in a first
    stateful aggregation: for dense streams the window fan-out then applies to
    panes, not rows.
    """
    ev = with_event_time(stream, ts, delay)
    if kind == "tumble":
        out = tumble_agg(ev, ts, size, keys, aggs)
    elif kind == "hop":
        out = hop_agg(ev, ts, size, slide, keys, aggs, strategy=strategy)
    elif kind == "session":
        out = session_agg(ev, ts, size, keys, aggs, strategy="native")
    else:
        raise ValueError(kind)
    return rt.ntz_bounds(out)


def _options(opts: rt.StreamOptions | None, checkpoint: str | None = None, **changes) -> rt.StreamOptions:
    """A copy of the caller's options with ``changes``; ``checkpoint`` where they name none."""
    opts = opts or rt.StreamOptions()
    return replace(opts, checkpoint=opts.checkpoint or checkpoint, **changes)


def start_window_agg(stream: DataFrame, kind: str, keys: list[str], aggs: list[Agg], size: str,
                     slide: str | None = None, opts: rt.StreamOptions | None = None,
                     path: str | None = None, strategy: str = "direct"):
    """(query, path, schema) of final window aggregates written to ``<path>/data``."""
    out = window_agg_stream(stream, kind, keys, aggs, size, slide, strategy=strategy)
    opts = _options(opts)
    if kind == "session":
        opts = replace(opts, conf={**rt.SESSION_LOCAL_MERGE, **opts.conf})
    q, path = rt.start_to_table(out, f"stream-{kind}", opts, path)
    return q, path, out.schema


def run_window_agg(stream: DataFrame, kind: str, keys: list[str], aggs: list[Agg], size: str,
                   slide: str | None = None, opts: rt.StreamOptions | None = None,
                   path: str | None = None, strategy: str = "direct") -> DataFrame:
    q, path, schema = start_window_agg(stream, kind, keys, aggs, size, slide, opts, path, strategy)
    rt.wait(q)
    return rt.read_table(stream.sparkSession, path, schema)


def _open_panes(spark: SparkSession, panes: str, batch_id: int) -> DataFrame:
    """Panes that windows after the last firing before ``batch_id`` need, as far as ``batch_id`` has them."""
    kept = [v for v in rt.committed_versions(spark, panes) if v < batch_id][-1:]
    later = [i for i in rt.committed(spark, panes, "batch_id") if (kept or [-1])[0] < i <= batch_id]
    return spark.read.parquet(*[f"{panes}/v={v}" for v in kept], *[f"{panes}/batch_id={i}" for i in later])


def _fire_windows(checkpoint: str, path: str, size: str, slide: str, group_cols: list[str], item_col: str, fold):
    """foreachBatch function: keeps the counts of panes that a micro-batch has changed, and publishes
    ``fold(counts)`` of the windows that its watermark closes as ``<path>/batch_id=<id>``.

    Panes lie beside the query's state, in its checkpoint: ``batch_id=<id>`` has those changed by a micro-batch,
    ``v=<id>`` all that windows still open after it need.  What a replay of the batch would read is kept.
    """
    size_us, slide_us, panes = duration_micros(size), duration_micros(slide), f"{checkpoint}/panes"
    keys = ["_p", *group_cols, item_col]

    def fire(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        passed, now = (rt.batch_watermark(spark, checkpoint, b) * 1000 // slide_us * slide_us for b in (batch_id - 1, batch_id))
        rt.publish(batch, panes, f"batch_id={batch_id}")
        held = _open_panes(spark, panes, batch_id)
        closing = held if now > passed else held.limit(0)
        # A count only grows, so of a pane's rows the largest is the newest.
        latest = closing.groupBy(*keys).agg(F.max("_n").alias("_n"))
        counts = pane_window_counts(latest, size, slide, group_cols, item_col, (passed + slide_us - size_us, now - size_us))
        rt.publish(fold(counts), path, f"batch_id={batch_id}")
        if now > passed:
            rt.publish(latest.where(F.col("_p") + size_us > now), panes, f"v={batch_id}")
            before = [v for v in rt.committed_versions(spark, panes) if v < batch_id][-1:]
            rt.drop_versions_before(spark, panes, (before or [0])[0])
            rt.drop_batches_upto(spark, panes, (before or [-1])[0])

    return fire


def _start_ranked(stream: DataFrame, name: str, size: str, slide: str, group_cols: list[str], item_col: str, rank,
                  columns: list[str], opts: rt.StreamOptions | None, path: str | None, strategy: str):
    """Final window counts, folded per micro-batch into ``<path>/data/batch_id=<id>``.

    ``rank(counts, group columns)`` ranks the counts of windows; ``columns`` is the result's order.  Overlapping windows share their panes: the
    query's state has a count per (pane, group, item), for as long as a window that holds the pane is open
    (``strategy="panes"``: as long as the pane is, as where panes are closed one by one).
    """
    spark = stream.sparkSession
    path = path or shared_path(spark, name)
    if not hops_evenly(size, slide):
        opts = _options(opts, f"{path}/_checkpoint")
        counts = window_agg_stream(stream, "hop", [*group_cols, item_col], [count_("cnt")], size, slide, strategy=strategy)
        fold = lambda b: rank(b, ["start_time", "end_time", *group_cols]).select(*columns)
        q = rt.start_foreach_batch(counts, rt.batch_partitioned_writer(f"{path}/data", fold), opts.checkpoint, opts)
        return q, path, fold(spark.createDataFrame([], counts.schema)).schema
    if strategy not in ("direct", "panes"):
        raise ValueError(strategy)
    ev = with_event_time(stream, "ts", schemas.WATERMARK_DELAY)
    pane = pane_of(to_micros(F.col("ts")), slide)
    if strategy == "panes":
        windows = ev.withColumn("_w", F.window("ts", slide))
    else:  # the last window that holds the row
        windows = ev.withColumn("_w", F.window("ts", size, slide)).where(to_micros(F.col("_w.start")) == pane)
    panes = (windows.groupBy("_w", pane.alias("_p"), *group_cols, item_col).agg(F.count(F.lit(1)).alias("_n"))
             .select("_p", *group_cols, item_col, "_n"))
    fold = lambda counts: start_and_end(rank(counts, ["_s", *group_cols]), size, True).select(*columns)
    opts = _options(opts, f"{path}/_checkpoint", output_mode="update")
    fire = _fire_windows(opts.checkpoint, f"{path}/data", size, slide, group_cols, item_col, fold)
    q = rt.start_foreach_batch(panes, fire, opts.checkpoint, opts)
    empty = spark.createDataFrame([], panes.schema)
    return q, path, fold(pane_window_counts(empty, size, slide, group_cols, item_col)).schema


def start_window_topn(stream: DataFrame, size: str, slide: str, group_cols: list[str], item_col: str,
                      n: int, opts: rt.StreamOptions | None = None, path: str | None = None,
                      strategy: str = "direct"):
    """(query, path, schema) of the top-n per (hop window, group).

    Stage 1 is a watermarked count per (slide-wide pane, group, item) in
    update mode.  Stage 2 adds up and ranks the windows that the micro-batch's
    watermark closes (``WindowGroupLimit``) in ``foreachBatch`` and overwrites
    ``batch_id=<id>``, so a replayed batch is written once.
    """
    rank = lambda counts, by: rank_counts(counts, by, item_col, n)
    return _start_ranked(stream, "stream-topn", size, slide, group_cols, item_col, rank,
                         ["start_time", "end_time", *group_cols, item_col, "cnt"], opts, path, strategy)


def run_window_topn(stream: DataFrame, size: str, slide: str, group_cols: list[str], item_col: str,
                    n: int, opts: rt.StreamOptions | None = None, path: str | None = None,
                    strategy: str = "direct") -> DataFrame:
    q, path, schema = start_window_topn(stream, size, slide, group_cols, item_col, n, opts, path, strategy)
    rt.wait(q)
    return rt.read_batches(stream.sparkSession, f"{path}/data", schema)


def running_topn_step(group_col: str, item_col: str, n: int):
    """Merge a micro-batch of updated counts into the previous top-n table.

    Counts only grow (append-only input), so an item outside the old top-n
    whose count did not change cannot enter it: the new top-n is the top-n of
    (old top-n + changed counts).  Both are small; the full count table stays
    distributed in the state store.
    """

    def step(prev: DataFrame | None, changed: DataFrame) -> DataFrame:
        rows = changed.select(group_col, item_col, "cnt")
        if prev is not None:
            rows = prev.select(group_col, item_col, "cnt").unionByName(rows)
        latest = rows.groupBy(group_col, item_col).agg(F.max("cnt").alias("cnt"))
        return rank_counts(latest, [group_col], item_col, n)

    return step


def topn_changes(prev: DataFrame | None, new: DataFrame, group_col: str, item_col: str) -> DataFrame:
    """Rows that left (``op='-'``) or entered/changed (``op='+'``) the top-n table,
    like an update stream printed as retractions and insertions."""
    cols = [group_col, item_col, "cnt"]
    added = new.select(*cols) if prev is None else new.select(*cols).exceptAll(prev.select(*cols))
    out = added.withColumn("op", F.lit("+"))
    if prev is not None:
        out = prev.select(*cols).exceptAll(new.select(*cols)).withColumn("op", F.lit("-")).unionByName(out)
    return out.select("op", *cols)


def start_running_topn(stream: DataFrame, group_col: str, item_col: str, n: int,
                       opts: rt.StreamOptions | None = None, path: str | None = None,
                       changelog: bool = False):
    """(query, path) of the unwindowed top-n per group, updated on every micro-batch (no watermark).

    With ``changelog=True`` each micro-batch also writes the rows that left or
    entered the top-n to ``<path>/changes/batch_id=<id>`` (``op`` '-' / '+').
    """
    path = path or shared_path(stream.sparkSession, "stream-running-topn")
    counts = stream.groupBy(group_col, item_col).agg(F.count(F.lit(1)).alias("cnt"))
    opts = _options(opts, f"{path}/_checkpoint", output_mode="update")
    step = running_topn_step(group_col, item_col, n)
    table = f"{path}/table"
    if changelog:
        def fold(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            prev = rt.read_version(spark, table, before=batch_id)
            rt.write_version(step(prev, batch), table, batch_id)
            new = rt.read_version(spark, table, before=batch_id + 1)  # the written copy, not a recomputation
            rt.publish(topn_changes(prev, new, group_col, item_col), f"{path}/changes", f"batch_id={batch_id}")
            vs = [v for v in rt.committed_versions(spark, table) if v <= batch_id]
            if len(vs) > 2:
                rt.drop_versions_before(spark, table, vs[-2])
    else:
        fold = rt.versioned_fold(table, step)
    return rt.start_foreach_batch(counts, fold, opts.checkpoint, opts), path


def run_running_topn(stream: DataFrame, group_col: str, item_col: str, n: int,
                     opts: rt.StreamOptions | None = None, path: str | None = None,
                     changelog: bool = False) -> DataFrame:
    spark = stream.sparkSession
    q, path = start_running_topn(stream, group_col, item_col, n, opts, path, changelog)
    rt.wait(q)
    out = rt.read_version(spark, f"{path}/table")
    if out is None:
        return spark.createDataFrame([], f"{group_col} string, {item_col} string, cnt bigint")
    return out


def start_cdc_snapshot(changes: DataFrame, opts: rt.StreamOptions | None = None,
                       path: str | None = None, buckets: int = 64):
    """(query, path) of a change-record stream folded into a keyed snapshot table.

    Each micro-batch rewrites only the key-hash buckets it touches
    (``sinks.cdc_files.fold_into_buckets``); tombstones are kept so records
    arriving out of ``seq`` order never revive a deleted key.  A batch that was
    published before, by this query, is recognised and left out.
    """
    from eventide.sinks.cdc_files import fold_into_buckets

    spark = changes.sparkSession
    path = path or shared_path(spark, "cdc")
    opts = _options(opts, f"{path}/_checkpoint")
    owner: list[str] = []

    def fold(batch: DataFrame, batch_id: int) -> None:
        owner[:] = owner or [rt.query_id(spark, opts.checkpoint)]
        fold_into_buckets(batch, f"{path}/table", buckets, batch=(owner[0], batch_id))

    return rt.start_foreach_batch(changes, fold, opts.checkpoint, opts), path


def run_cdc_snapshot(changes: DataFrame, opts: rt.StreamOptions | None = None,
                     path: str | None = None, buckets: int = 64) -> DataFrame:
    """Fold what is there; return the snapshot's live rows."""
    from eventide.sinks.cdc_files import read_snapshot

    spark = changes.sparkSession
    q, path = start_cdc_snapshot(changes, opts, path, buckets)
    rt.wait(q)
    out = read_snapshot(spark, f"{path}/table")
    return spark.createDataFrame([], schemas.WORDS_JDBC) if out is None else out


def run_jdbc_wordcount(words: DataFrame, url: str, table: str, properties: dict | None = None,
                       opts: rt.StreamOptions | None = None, checkpoint: str | None = None,
                       casts: dict | None = None, dialect=None):
    """Streaming word count upserted into a JDBC table keyed by word.

    Update mode: each micro-batch carries the new totals of the words it
    touched; ``jdbc_upsert`` merges them in one transaction together with the
    query's identity and the batch id, so a batch replayed after a restart is
    applied once, and a new query on the same table starts afresh.
    """
    from eventide.operators import word_count
    from eventide.sinks import jdbc_upsert

    spark = words.sparkSession
    opts = _options(opts, checkpoint or shared_path(spark, "jdbc-wordcount") + "/_checkpoint", output_mode="update")
    owner: list[str] = []

    def upsert(batch: DataFrame, batch_id: int) -> None:
        owner[:] = owner or [rt.query_id(spark, opts.checkpoint)]
        jdbc_upsert(batch, url, table, ["word"], properties, batch_id=batch_id, casts=casts, dialect=dialect,
                    query_id=owner[0])

    q = rt.start_foreach_batch(word_count(words), upsert, opts.checkpoint, opts)
    return rt.wait(q) if opts.trigger in ("availableNow", "once") else q


def run_cdc_jdbc(changes: DataFrame, url: str, table: str, properties: dict | None = None,
                 opts: rt.StreamOptions | None = None, checkpoint: str | None = None, dialect=None,
                 casts: dict | None = None):
    """Change-record stream mirrored into a JDBC table (``cdc_jdbc.apply_folded``).

    Each micro-batch is folded to one row per key, then applied with the
    ``seq`` guard; replays and out-of-order batches leave the same table.
    """
    from eventide.sinks.cdc_jdbc import apply_folded

    spark = changes.sparkSession
    opts = _options(opts, checkpoint or shared_path(spark, "cdc-jdbc") + "/_checkpoint")

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_folded(cdc.fold_changes(batch), url, table, properties, dialect=dialect, casts=casts)

    q = rt.start_foreach_batch(changes, apply, opts.checkpoint, opts)
    return rt.wait(q) if opts.trigger in ("availableNow", "once") else q


def start_click_rank(actions: DataFrame, path: str | None = None, n: int = 5, size: str = "60 seconds",
                     slide: str = "1 second", opts: rt.StreamOptions | None = None, strategy: str = "direct"):
    """The click-rank job: two sinks fed by one source (clicks per sex, and top-n
    names per sex, both per hop window).  Two streaming queries that run side by
    side, each with its own checkpoint; returns their (query, path, schema)."""
    from eventide.operators import live_clicks

    path = path or shared_path(actions.sparkSession, "click-rank")
    clicks = live_clicks(with_event_time(actions, "ts", schemas.WATERMARK_DELAY))
    own = lambda sink: replace(opts, checkpoint=f"{opts.checkpoint}/{sink}") if opts and opts.checkpoint else opts
    counts = start_window_agg(clicks, "hop", ["sex"], [count_("cnt")], size, slide, own("sex_count"),
                              f"{path}/sex_count", strategy)
    top = start_window_topn(clicks, size, slide, ["sex"], "name", n, own("sex_topn"), f"{path}/sex_topn", strategy)
    return counts, top


def run_click_rank(actions: DataFrame, path: str | None = None, n: int = 5,
                   size: str = "60 seconds", slide: str = "1 second", opts: rt.StreamOptions | None = None,
                   strategy: str = "direct"):
    """Both queries started, then awaited; returns the two result tables."""
    spark = actions.sparkSession
    counts, top = start_click_rank(actions, path, n, size, slide, opts, strategy)
    for q, _, _ in (counts, top):
        rt.wait(q)
    return (rt.read_table(spark, counts[1], counts[2]).select("sex", "cnt", "start_time", "end_time"),
            rt.read_batches(spark, f"{top[1]}/data", top[2]).select("start_time", "end_time", "sex", "name", "cnt"))


def start_window_topn_json(stream: DataFrame, size: str, slide: str, group_col: str, item_col: str,
                           n: int = 10, alias: str = "top10", opts: rt.StreamOptions | None = None,
                           path: str | None = None, strategy: str = "direct"):
    """(query, path, schema) of the top-n JSON text per (hop window, group): the aggregate-function job.

    Windows are counted once, when they close; each micro-batch folds its
    counts to ``{"item": cnt, ...}`` in ``foreachBatch``.
    """
    rank = lambda counts, by: topn_json_from_counts(counts, by, item_col, n, alias)
    return _start_ranked(stream, "stream-topn-json", size, slide, [group_col], item_col, rank,
                         [group_col, alias, "start_time", "end_time"], opts, path, strategy)


def run_window_topn_json(stream: DataFrame, size: str, slide: str, group_col: str, item_col: str,
                         n: int = 10, alias: str = "top10", opts: rt.StreamOptions | None = None,
                         path: str | None = None, strategy: str = "direct") -> DataFrame:
    q, path, schema = start_window_topn_json(stream, size, slide, group_col, item_col, n, alias, opts, path, strategy)
    rt.wait(q)
    return rt.read_batches(stream.sparkSession, f"{path}/data", schema)
