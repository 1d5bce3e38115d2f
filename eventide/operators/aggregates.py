"""User-defined aggregates that merge: plain Python objects, run in two phases.

An aggregate is any object with

    create_accumulator()            a new accumulator (any picklable value)
    accumulate(acc, *args)          take in one row's arguments
    merge(acc, others)              take in other accumulators
    get_value(acc)                  the result, for an aggregate function
    emit_value(acc)                 the result's rows as tuples, for a table aggregate
    retract(acc, others)            optional: take out accumulators that were merged before

``accumulate`` and ``merge`` change ``acc`` or return another one.  Prefer
built-in aggregates where they exist: these run in Python.

Plan: every task folds its rows into one accumulator per group and hands on
the pickled accumulators only, however many rows a group has (a task that
meets more than ``HELD_GROUPS`` groups hands them on in between).  They are
shuffled by group and a salt, merged in order of the group, one group at a
time and at most ``MERGED_AT_ONCE`` accumulators at once, and then merged
again without the salt: a hot group's accumulators, one a task, never meet in
one task unmerged.  Sliding windows merge the accumulators of slide-wide
panes, so a row is accumulated once, not once per window.
"""

from __future__ import annotations

import heapq
import json
import pickle
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from eventide.operators.timeutil import duration_micros

#: Groups whose accumulators one task holds.
HELD_GROUPS = 50_000
#: Accumulators of a group that are unpickled and merged together.
MERGED_AT_ONCE = 64
#: Salts of the first merge.
SALTS = 16
_ROWS = 10_000


class TopCounts:
    """The ``n`` most frequent items: ties by item, a missing item first and named "null" in JSON."""

    def __init__(self, n: int):
        self.n = n

    def create_accumulator(self) -> dict:
        return {}

    def accumulate(self, acc: dict, item) -> None:
        acc[item] = acc.get(item, 0) + 1

    def merge(self, acc: dict, others: Iterable[dict]) -> None:
        for other in others:
            for item, n in other.items():
                acc[item] = acc.get(item, 0) + n

    def retract(self, acc: dict, others: Iterable[dict]) -> None:
        for other in others:
            for item, n in other.items():
                acc[item] -= n
                if not acc[item]:
                    del acc[item]

    def emit_value(self, acc: dict) -> list[tuple]:
        return heapq.nsmallest(self.n, acc.items(), key=lambda e: (-e[1], e[0] is not None, e[0]))

    def leading(self, acc: dict) -> list:
        """Items that stay in the result unless others change: counts only grow."""
        return [item for item, _ in self.emit_value(acc)]

    def join_rows(self, rows: list[tuple]) -> list[tuple]:
        """The result over results for disjoint items."""
        return self.emit_value(dict(rows))

    def get_value(self, acc: dict) -> str:
        name = lambda x: json.dumps("null" if x is None else str(x), ensure_ascii=False)
        return "{" + ",".join(f"{name(item)}:{n}" for item, n in self.emit_value(acc)) + "}"


class Variance:
    """Population variance: (count, mean, sum of squared deviations), merged pairwise."""

    def create_accumulator(self) -> tuple:
        return 0, 0.0, 0.0

    def accumulate(self, acc: tuple, x: float | None) -> tuple:
        return acc if x is None else self._joined(acc, (1, x, 0.0))

    def merge(self, acc: tuple, others: Iterable[tuple]) -> tuple:
        for other in others:
            acc = self._joined(acc, other)
        return acc

    @staticmethod
    def _joined(a: tuple, b: tuple) -> tuple:
        n = a[0] + b[0]
        if not n:
            return a
        d = b[1] - a[1]
        return n, a[1] + d * b[0] / n, a[2] + b[2] + d * d * a[0] * b[0] / n

    def get_value(self, acc: tuple) -> float | None:
        return acc[2] / acc[0] if acc[0] else None


def accumulated(agg, acc, *args):
    """``acc`` after one row; the object may have changed it or returned another one."""
    new = agg.accumulate(acc, *args)
    return acc if new is None else new


def merged(agg, acc, others: list):
    new = agg.merge(acc, others)
    return acc if new is None else new


def retracted(agg, acc, others: list):
    new = agg.retract(acc, others)
    return acc if new is None else new


def _same(a: tuple, b: tuple) -> bool:
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def _key_schema(df: DataFrame, keys: list[str]) -> T.StructType:
    return T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys])


def partials(df: DataFrame, keys: list[str], args: list[str], agg, held: int | None = None) -> DataFrame:
    """(keys, ``_acc``): one pickled accumulator per group and task; works on streams, too."""
    schema = _key_schema(df, keys)

    def key(k: str) -> Column:
        kind = schema[k].dataType
        # -0.0 and 0.0 are one group
        return F.col(k) + F.lit(0.0).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(k)

    rows = df.select(*[key(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(a).alias(f"_a{i}") for i, a in enumerate(args)])
    held, n = held or HELD_GROUPS, len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict = {}
        types: list[pa.DataType] = []

        def flush() -> pa.RecordBatch:
            own = list(zip(*groups)) or [()] * n
            columns = [pa.array(list(c), t) for c, t in zip(own, types)]
            columns.append(pa.array([pickle.dumps(a) for a in groups.values()], pa.binary()))
            groups.clear()
            return pa.RecordBatch.from_arrays(columns, [*keys, "_acc"])

        for batch in batches:
            types = [c.type for c in batch.columns[:n]]
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns) if columns else [()] * batch.num_rows:
                at = row[:n]
                acc = groups[at] if at in groups else agg.create_accumulator()
                groups[at] = accumulated(agg, acc, *row[n:])
                if len(groups) >= held:
                    yield flush()
        if groups:
            yield flush()

    return rows.mapInArrow(run, T.StructType([*schema, T.StructField("_acc", T.BinaryType())]))


def merge_runs(parts: DataFrame, keys: list[str], agg, finish: Callable | None = None, result: T.DataType | None = None,
               alias: str = "_acc", salt: bool = False) -> DataFrame:
    """Accumulators of equal (sorted) keys merged as they stream by; ``finish`` gives their values."""
    by = [*keys, "_salt"] if salt else keys
    at_once, n = MERGED_AT_ONCE, len(keys)
    dealt = parts.repartition(*by) if by else parts.coalesce(1)  # without keys or salt: one accumulator a salt
    dealt = dealt.sortWithinPartitions(*keys) if keys else dealt
    result = result or T.BinaryType()
    schema, kind = T.StructType([*_key_schema(parts, keys), T.StructField(alias, result)]), to_arrow_type(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, types, last = [], [], None
        acc, waiting = None, []

        def take():
            return merged(agg, acc, [pickle.loads(w) for w in waiting]) if waiting else acc

        def rows() -> pa.RecordBatch:
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([r[n] for r in out], kind)], [*keys, alias])

        def close() -> None:
            value = take()
            out.append((*last, pickle.dumps(value) if finish is None else finish(value)))

        for batch in batches:
            types = [batch.column(k).type for k in keys]
            columns = [batch.column(k).to_pylist() for k in keys]
            for *at, part in zip(*columns, batch.column("_acc").to_pylist()):
                if last is None or not _same(tuple(at), last):
                    if last is not None:
                        close()
                    last, acc, waiting = tuple(at), agg.create_accumulator(), []
                waiting.append(part)
                if len(waiting) >= at_once:
                    acc, waiting = take(), []
                if len(out) >= _ROWS:
                    yield rows()
                    out.clear()
        if last is not None:
            close()
            yield rows()

    return dealt.mapInArrow(run, schema)


def _two_phases(parts: DataFrame, keys: list[str], agg, finish, result, alias: str, salts: int) -> DataFrame:
    if salts > 1:
        parts = merge_runs(parts.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts))), keys, agg, salt=True)
    return merge_runs(parts, keys, agg, finish, result, alias)


def _type(result: str | T.DataType) -> T.DataType:
    return T.DataType.fromDDL(result) if isinstance(result, str) else result


def user_agg(df: DataFrame, keys: list[str], args: list[str], agg, result: str | T.DataType, alias: str = "value",
             salts: int = SALTS) -> DataFrame:
    """keys, ``alias``: ``agg.get_value`` per group of ``keys`` (NULL is a group, NaN another)."""
    return _two_phases(partials(df, keys, args, agg), keys, agg, agg.get_value, _type(result), alias, salts)


def user_window_agg(df: DataFrame, ts: str, size: str, slide: str, keys: list[str], args: list[str], agg,
                    result: str | T.DataType, alias: str = "value", salts: int = SALTS) -> DataFrame:
    """start_time, end_time, keys, ``alias``: ``agg.get_value`` per hop window and group.

    Rows are accumulated per slide-wide pane; only the panes' accumulators take
    part in the windows that overlap them."""
    if df.isStreaming:
        raise ValueError("on a stream: eventide.streaming.stateful.stateful_windows")
    if duration_micros(size) % duration_micros(slide):
        raise ValueError("size must be a multiple of slide")
    panes = partials(df.withColumn("_pane", F.window(ts, slide)["start"]).where(F.col("_pane").isNotNull()),
                     ["_pane", *keys], args, agg)
    if size != slide:
        panes = _two_phases(panes, ["_pane", *keys], agg, None, None, "_acc", salts)
    w = F.window("_pane", size, slide)
    spread = panes.withColumn("_w", w).select(F.col("_w.start").alias("start_time"), F.col("_w.end").alias("end_time"), *keys, "_acc")
    return _two_phases(spread, ["start_time", "end_time", *keys], agg, agg.get_value, _type(result), alias, salts)
