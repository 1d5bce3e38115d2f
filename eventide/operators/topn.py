"""Top-N rankings: per window, over a whole stream/table, and as JSON text.

Ties are ordered by ``cnt DESC, <item> ASC`` (the reference leaves them
open).  ``row_number() <= n`` is planned by Spark as ``WindowGroupLimit``,
which keeps at most ``n`` rows per group in every task *before* the shuffle,
so a hot group sends n rows per map task, never all of its rows.

Top-N over sliding windows shuffles rows, not their size/slide window copies:
rows are dealt out by group and stretch of time (a window belongs to the stretch
it starts in, a row to the two or three that hold its windows).  A pane of an
item adds to its count in the first window that holds it and takes that off
after the last one; a running sum gives the spans of windows over which the count
does not change.  These tasks expand spans into windows and pass on a window's
``n`` leading items only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.operators.timeutil import duration_micros, from_micros, is_ntz, require_utc, spread, to_micros
from eventide.operators.windows import count_, hop_agg

#: Windows per row that one task of ``spark.sql.shuffle.partitions`` is meant for: a larger
#: fan-out is dealt out to as many times more tasks.
FAN_OUT = 16


def top_n(df: DataFrame, partition_cols: list[str], order_cols: list[Column], n: int,
          rank_col: str | None = None) -> DataFrame:
    if df.isStreaming:
        raise ValueError("ranking a stream: use eventide.streaming.jobs.run_window_topn / run_running_topn "
                         "(they rank each micro-batch of final counts in foreachBatch)")
    w = Window.partitionBy(*partition_cols).orderBy(*order_cols)
    ranked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    if rank_col:
        return ranked.withColumnRenamed("_rn", rank_col)
    return ranked.drop("_rn")


def rank_counts(counts: DataFrame, group_cols: list[str], item_col: str, n: int,
                cnt_col: str = "cnt") -> DataFrame:
    return top_n(counts, group_cols, [F.col(cnt_col).desc(), F.col(item_col).asc()], n)


def window_counts(df: DataFrame, ts: str, size: str, slide: str, group_cols: list[str],
                  item_col: str, strategy: str = "auto", spread_to: int | None = None) -> DataFrame:
    """count(*) per (hop window, group, item)."""
    return hop_agg(df, ts, size, slide, [*group_cols, item_col], [count_("cnt")], strategy, spread_to)


def hops_evenly(size: str, slide: str) -> bool:
    """Whether the windows overlap and are made of whole panes, as ``pane_window_counts`` needs."""
    size_us, slide_us = duration_micros(size), duration_micros(slide)
    return size_us != slide_us and size_us % slide_us == 0


def pane_of(t: Column, slide: str) -> Column:
    """Start of the slide-wide pane that holds ``t`` (microseconds)."""
    return t - F.pmod(t, F.lit(duration_micros(slide)))


def pane_window_counts(panes: DataFrame, size: str, slide: str, group_cols: list[str], item_col: str,
                       starts: tuple[int, int] | None = None, tasks: int | None = None) -> DataFrame:
    """``_s``, groups, item, cnt: the count of each item in each hop window that starts at ``_s``.

    ``panes`` holds ``_p`` (a pane's start, in microseconds), the groups, the item and
    its count ``_n`` there; a pane may come in several rows.  ``starts`` gives the first and last start
    of the windows wanted.  A window and group's items lie in one task, so that their ranking
    (``WindowGroupLimit``) hands on ``n`` rows of them.
    """
    size_us, slide_us = duration_micros(size), duration_micros(slide)
    length = max(1, size_us // slide_us // 2) * slide_us
    if tasks is None:
        tasks = int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions")) * -(-size_us // slide_us // FAN_OUT)
    stretch = lambda t: t - F.pmod(t, F.lit(length))
    first, last = F.col("_p") - (size_us - slide_us), F.col("_p")
    if starts:
        first, last = F.greatest(first, F.lit(starts[0])), F.least(last, F.lit(starts[1]))
    own = panes.select("_p", "_n", *group_cols, item_col, first.alias("_from"), last.alias("_last")).where("_from <= _last")
    dealt = (own.withColumn("_c", F.explode(F.sequence(stretch(F.col("_from")), stretch(F.col("_last")), F.lit(length))))
             .repartition(tasks, "_c", *group_cols))
    edge = lambda s, n: F.struct(s.alias("s"), n.alias("n"))
    edges = F.array(edge(F.greatest("_from", "_c"), F.col("_n")),
                    edge(F.least(F.col("_last") + slide_us, F.col("_c") + length), -F.col("_n")))
    steps = dealt.select("_c", *group_cols, item_col, F.explode(edges).alias("_e"))
    w = Window.partitionBy("_c", *group_cols, item_col).orderBy("_e.s")
    spans = steps.select("_c", *group_cols, item_col, F.col("_e.s").alias("_s"), F.lead("_e.s").over(w).alias("_to"),
                         F.sum("_e.n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cnt"))
    # Of several edges at one time the last one has the whole sum; the others span nothing.
    return spans.where("cnt > 0 AND _to > _s").select(
        *group_cols, item_col, "cnt", F.explode(F.sequence(F.col("_s"), F.col("_to") - slide_us, F.lit(slide_us))).alias("_s"))


def start_and_end(ranked: DataFrame, size: str, ntz: bool) -> DataFrame:
    """``start_time, end_time`` in the place of ``_s``."""
    start, end = from_micros(F.col("_s"), ntz), from_micros(F.col("_s") + duration_micros(size), ntz)
    others = [F.col(c) for c in ranked.columns if c != "_s"]
    return ranked.select(start.alias("start_time"), end.alias("end_time"), *others)


def _dealt_counts(df: DataFrame, ts: str, size: str, slide: str, group_cols: list[str], item_col: str,
                  strategy: str, spread_to: int | None) -> DataFrame:
    """``pane_window_counts`` of a table; ``strategy="panes"`` counts panes before they are dealt out."""
    if strategy not in ("auto", "direct", "panes"):
        raise ValueError(strategy)
    if is_ntz(df, ts):
        require_utc(df.sparkSession)
    rows = spread(df, spread_to).where(F.col(ts).isNotNull()).select(
        pane_of(to_micros(F.col(ts)), slide).alias("_p"), *group_cols, item_col)
    if strategy == "panes":
        panes = rows.groupBy("_p", *group_cols, item_col).agg(F.count(F.lit(1)).alias("_n"))
    else:
        panes = rows.withColumn("_n", F.lit(1).cast("bigint"))
    return pane_window_counts(panes, size, slide, group_cols, item_col)


def window_topn(df: DataFrame, ts: str, size: str, slide: str, group_cols: list[str],
                item_col: str, n: int = 10, strategy: str = "auto", spread_to: int | None = None) -> DataFrame:
    """Top ``n`` items per (hop window, group): start_time, end_time, groups, item, cnt."""
    if not hops_evenly(size, slide):
        counts = window_counts(df, ts, size, slide, group_cols, item_col, strategy, spread_to)
        return rank_counts(counts, ["start_time", "end_time", *group_cols], item_col, n)
    counts = _dealt_counts(df, ts, size, slide, group_cols, item_col, strategy, spread_to)
    ranked = start_and_end(rank_counts(counts, ["_s", *group_cols], item_col, n), size, is_ntz(df, ts))
    return ranked.select("start_time", "end_time", *group_cols, item_col, "cnt")


def running_topn(df: DataFrame, group_col: str, item_col: str, n: int = 10) -> DataFrame:
    """Top ``n`` items per group over all rows: group, item, cnt."""
    counts = df.groupBy(group_col, item_col).agg(F.count(F.lit(1)).alias("cnt"))
    return rank_counts(counts, [group_col], item_col, n)


def topn_json_from_counts(counts: DataFrame, group_cols: list[str], item_col: str, n: int,
                          alias: str = "top10") -> DataFrame:
    """``{"item": cnt, ...}`` of the top ``n`` items per group, in rank order.

    Two window passes share one partitioning and sort (group, cnt DESC,
    item): ``row_number`` (planned as ``WindowGroupLimit``, n rows per group
    and task before the shuffle), then a whole-partition ``collect_list`` of
    the at most n surviving rows.  No aggregation buffer, no extra sort or
    shuffle.  A NULL item is written as the key ``"null"``; beside an item of
    that name the key stands twice, as the counts are two.
    """
    order = [F.col("cnt").desc(), F.col(item_col).asc()]
    w = Window.partitionBy(*group_cols).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    entry = F.struct(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("k"), F.col("cnt").alias("v"))
    ranked = counts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    listed = ranked.withColumn("_top", F.collect_list(entry).over(whole)).where(F.col("_rn") == 1)
    # A one-element array gives the item as a JSON string between brackets.
    key = lambda e: F.regexp_replace(F.to_json(F.array(e["k"])), r"^\[|\]$", "")
    pairs = F.transform("_top", lambda e: F.concat(key(e), F.lit(":"), e["v"].cast("string")))
    return listed.select(*group_cols, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")).alias(alias))


def topn_json(df: DataFrame, ts: str, size: str, slide: str, group_col: str, item_col: str,
              n: int = 10, alias: str = "top10", strategy: str = "auto", spread_to: int | None = None) -> DataFrame:
    """Aggregate function form of top-N: one JSON text per (window, group)."""
    if hops_evenly(size, slide):
        counts = _dealt_counts(df, ts, size, slide, [group_col], item_col, strategy, spread_to)
        out = start_and_end(topn_json_from_counts(counts, ["_s", group_col], item_col, n, alias), size, is_ntz(df, ts))
    else:
        counts = window_counts(df, ts, size, slide, [group_col], item_col, strategy, spread_to)
        out = topn_json_from_counts(counts, ["start_time", "end_time", group_col], item_col, n, alias)
    return out.select(group_col, alias, "start_time", "end_time")
