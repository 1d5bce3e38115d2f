"""Stateful stream operators on keyed state, event-time timers and state expiry.

Both operators take the aggregate objects of ``eventide.operators.aggregates``
and return streaming DataFrames in append mode, so any sink can follow.  Rows
are folded into one accumulator per group and task before the shuffle.  State
lies in RocksDB (the default of ``StreamOptions``).

``stateful_windows`` keeps the accumulators of slide-wide panes in a list, to
which a micro-batch appends its own at once; a timer at the end of the next
window fires on the watermark, and the panes of every window that is due are
merged and emitted (an object with ``retract(acc, others)``, which takes
accumulators out again, adds and takes out what neighbouring windows differ in).  A window's state is shared by all windows
that overlap it, where a windowed count keeps one row per window and item.
State is keyed by group and by a stretch of time of ``CHUNK`` window sizes, so
that a hot group's history is worked on side by side.

``table_aggregate`` keeps an accumulator's entries in a map state, in ``BLOCKS``
blocks of items (one by one where they expire), and emits a group's rows again
when a micro-batch has changed them.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventide.functions import schemas
from eventide.operators.aggregates import merged, partials, retracted
from eventide.operators.timeutil import duration_micros, with_event_time
from eventide.streaming.runtime import rocksdb_conf

#: Window sizes that one state key spans.
CHUNK = 16
#: Blocks that the entries of one table aggregate's state key are dealt to: one access reads or writes a block.
BLOCKS = 1024
#: Settings of a query with expiring state: Spark takes a timer on processing time as a reason for
#: empty micro-batches without end.
EXPIRY_CONF = {**rocksdb_conf(), "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
_ROWS = 10_000


def _ddl(result: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(result) if isinstance(result, str) else result


def _frames(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= _ROWS:
            yield pd.DataFrame(held, columns=columns, dtype=object)
            held = []
    if held:
        yield pd.DataFrame(held, columns=columns, dtype=object)


def _plain_names(df: DataFrame, keys: list[str], **others: str) -> DataFrame:
    """Key columns as k0, k1, ... before the others: names that a processor's frames can hold and that do not clash."""
    return df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(n) for n, c in others.items()])


class _Windows(StatefulProcessor):
    """Panes of one (group, stretch of time); all times in milliseconds."""

    def __init__(self, agg, size: int, slide: int, columns: list[str], many: bool):
        self.agg, self.size, self.slide, self.stretch, self.columns, self.many = agg, size, slide, CHUNK * size, columns, many

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getListState("panes", "pane long, acc binary")  # a pane may come in several rows
        self.passed = handle.getValueState("passed", "watermark long, due long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        # What is due goes out first: a row does not count in windows that the watermark has passed.
        yield from _frames(self._fire(key, now), self.columns)
        new: dict[int, list[bytes]] = {}
        for frame in rows:
            for pane, acc in zip(frame["pane"], frame["acc"]):
                if self._starts(key, int(pane), now):
                    new.setdefault(int(pane), []).append(bytes(acc))
        if new:
            self.panes.appendList([(pane, parts[0] if len(parts) == 1 else pickle.dumps(self._merged(parts))) for pane, parts in new.items()])
            self._set_timer(key, now, new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from _frames(self._fire(key, timerValues.getCurrentWatermarkInMs()), self.columns)

    def close(self) -> None:
        pass

    def _starts(self, key, pane: int, passed: int) -> range:
        """Starts of this stretch's windows that hold the pane and end after ``passed``."""
        begin = key[-1] * self.stretch
        first = max(pane - self.size + self.slide, begin, passed // self.slide * self.slide + self.slide - self.size)
        return range(first, min(pane, begin + self.stretch - self.slide) + 1, self.slide)

    def _merged(self, parts: list[bytes]):
        return merged(self.agg, self.agg.create_accumulator(), [pickle.loads(p) for p in parts])

    def _set_timer(self, key, now: int, panes) -> None:
        """A timer at the end of the next window that is not empty, unless an earlier one is set."""
        ends = (self._starts(key, p, now) for p in panes)
        due = min((s[0] + self.size for s in ends if s), default=None)
        set_for = self.passed.get()[1] if self.passed.exists() else None
        if due is not None and (set_for is None or due < set_for):
            self.handle.registerTimer(due)
            set_for = due
        if set_for is not None:
            self.passed.update((now, set_for))

    def _fire(self, key, now: int) -> Iterator[tuple]:
        """The rows of every window that ends by ``now`` and was not emitted; panes that no later window needs go."""
        passed, due = self.passed.get() if self.passed.exists() else (0, None)
        if due is None or due > now:
            return
        held: dict[int, list[bytes]] = {}
        for pane, acc in self.panes.get():
            held.setdefault(int(pane), []).append(bytes(acc))
        panes = sorted(held)
        loaded: dict[int, object] = {}
        slides = hasattr(self.agg, "retract")
        low = high = 0
        known, acc, rows, last = (0, 0), self.agg.create_accumulator(), [], None
        for pane in panes:
            for start in self._starts(key, pane, passed):
                if start + self.size > now or (last is not None and start <= last):
                    continue
                last = start
                while panes[low] < start:
                    low += 1
                high = max(high, low)
                while high < len(panes) and panes[high] < start + self.size:
                    high += 1
                if known != (low, high):  # neighbouring windows often hold the same panes
                    for p in panes[max(low, known[1]):high]:
                        loaded[p] = self._merged(held[p])
                    out = [loaded.pop(p) for p in panes[known[0]:min(low, known[1])]]
                    if slides:
                        acc = merged(self.agg, acc, [loaded[p] for p in panes[max(low, known[1]):high]])
                        acc = retracted(self.agg, acc, out)
                    else:
                        acc = merged(self.agg, self.agg.create_accumulator(), [loaded[p] for p in panes[low:high]])
                    known = low, high
                    rows = [tuple(r) for r in self.agg.emit_value(acc)] if self.many else [(self.agg.get_value(acc),)]
                for row in rows:
                    yield (start, start + self.size, *key[:-1], *row)
        left = [p for p in panes if self._starts(key, p, now)]
        self.passed.clear()
        if left:
            self.panes.put([(p, part) for p in left for part in held[p]])
            self._set_timer(key, now, left)
        else:
            self.panes.clear()


def stateful_windows(stream: DataFrame, size: str, slide: str, keys: list[str], args: list[str], agg, result: str | T.StructType,
                     ts: str = "ts", delay: str = schemas.WATERMARK_DELAY) -> DataFrame:
    """start_time, end_time, keys, fields of ``result``: a user-defined aggregate per hop window and group.

    ``result`` with one field takes ``agg.get_value``, otherwise (or where there
    is no such method) the rows of ``agg.emit_value``.  A window is emitted once,
    when the watermark reaches its end.  A row counts in those of its windows
    that the watermark in force has not reached; a row of which all windows are
    over is late and dropped (``streaming.late`` keeps such rows).
    """
    size_us, slide_us = duration_micros(size), duration_micros(slide)
    if size_us % slide_us or slide_us % 1000:
        raise ValueError("size must be a multiple of slide, slide of a millisecond")
    size_ms, slide_ms, fields = size_us // 1000, slide_us // 1000, _ddl(result)
    many = len(fields) > 1 or not hasattr(agg, "get_value")
    ntz = isinstance(stream.schema[ts].dataType, T.TimestampNTZType) or "spark.watermarkDelayMs" in stream.schema[ts].metadata
    ev = with_event_time(stream, ts, delay)
    pane = (F.floor(F.unix_micros(ts) / slide_us) * slide_ms).cast("long")
    parts = partials(ev.withColumn("_pane", pane).where(F.col(ts).isNotNull()), ["_pane", *keys], args, agg)
    # A pane belongs to the stretch of its first window and to that of its last one.
    stretch = lambda p: F.floor(p / (CHUNK * size_ms)).cast("long")
    both = F.array_distinct(F.array(stretch(F.col("_pane") - size_ms + slide_ms), stretch(F.col("_pane"))))
    own = _plain_names(parts.withColumn("_stretch", F.explode(both)), [*keys, "_stretch"], pane="_pane", acc="_acc")
    schema = T.StructType([T.StructField("_s", T.LongType()), T.StructField("_e", T.LongType()),
                           *(parts.schema[k] for k in keys), *fields])
    out = own.groupBy(*own.columns[:len(keys) + 1]).transformWithStateInPandas(
        _Windows(agg, size_ms, slide_ms, schema.names, many), schema, "Append", "EventTime")
    at = lambda c: F.timestamp_millis(c).cast("timestamp_ntz") if ntz else F.timestamp_millis(c)
    return out.select(at(F.col("_s")).alias("start_time"), at(F.col("_e")).alias("end_time"), *keys, *fields.names)


class _Table(StatefulProcessor):
    """The entries of one group's accumulator, in blocks (one state row each where they expire), and the rows last emitted."""

    def __init__(self, agg, columns: list[str], width: int, ttl_ms: int | None):
        self.agg, self.columns, self.width, self.ttl_ms = agg, columns, width, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # "item" is a block's number, or with a time to live an item
        self.entries = handle.getMapState("entries", "item binary", "value binary", self.ttl_ms)
        self.shown = handle.getValueState("shown", "version long, rows binary, leading binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        agg, new, acc = self.agg, self.agg.create_accumulator(), {}
        for frame in rows:
            new = merged(agg, new, [pickle.loads(bytes(a)) for a in frame["acc"]])
        for block, items in self._blocks(new).items():
            held, old, own = self._held(block), agg.create_accumulator(), agg.create_accumulator()
            for item in items:
                own[item] = new[item]
                if item in held:
                    old[item] = held[item]
            changed = merged(agg, old, [own])
            acc.update(changed)
            self._put(block, held, changed)
        if self.ttl_ms is not None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms + 1)
        yield from self._emit(key, acc)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._emit(key, {})

    def close(self) -> None:
        pass

    def _blocks(self, items) -> dict[bytes, list]:
        """The items by state row."""
        out: dict[bytes, list] = {}
        for item in items:
            name = pickle.dumps(item)
            # (the low part of the checksum has dealt the items to parts)
            row = name if self.ttl_ms is not None else pickle.dumps((crc32(name) >> 16) % BLOCKS)
            out.setdefault(row, []).append(item)
        return out

    def _held(self, block: bytes) -> dict:
        value = self.entries.getValue((block,))
        if value is None:
            return {}
        held = pickle.loads(value[0])
        return held if self.ttl_ms is None else {pickle.loads(block): held}

    def _put(self, block: bytes, held: dict, changed: dict) -> None:
        if self.ttl_ms is None:
            self.entries.updateValue((block,), (pickle.dumps({**held, **changed}),))
        else:
            for item, value in changed.items():
                self.entries.updateValue((pickle.dumps(item),), (pickle.dumps(value),))

    def _read(self, items) -> dict:
        return {item: held[item] for block, own in self._blocks(items).items() for held in [self._held(block)] for item in own if item in held}

    def _all(self) -> dict:
        if self.ttl_ms is None:
            return {k: v for _, block in self.entries.iterator() for k, v in pickle.loads(block[0]).items()}
        return {pickle.loads(k[0]): pickle.loads(v[0]) for k, v in self.entries.iterator()}

    def _emit(self, key, changed: dict) -> Iterator[pd.DataFrame]:
        version, before, leading = self.shown.get() if self.shown.exists() else (0, pickle.dumps([]), pickle.dumps([]))
        if self.ttl_ms is None and hasattr(self.agg, "leading"):
            acc = self._read(x for x in pickle.loads(leading) if x not in changed) | changed
        else:  # the whole accumulator, as far as it has not expired
            acc = self._all()
        rows = [tuple(r) for r in self.agg.emit_value(acc)]
        if rows == pickle.loads(before):
            return
        leads = list(self.agg.leading(acc)) if hasattr(self.agg, "leading") else []
        self.shown.update((version + 1, pickle.dumps(rows), pickle.dumps(leads)))
        # An emptied group is one row at position 0.
        out = [(*key, version + 1, i, *row) for i, row in enumerate(rows, 1)] or [(*key, version + 1, 0, *[None] * self.width)]
        yield from _frames(iter(out), self.columns)


def table_aggregate(stream: DataFrame, keys: list[str], args: list[str], agg, result: str | T.StructType,
                    ttl: str | None = None, parts: int = 1) -> DataFrame:
    """keys, ``_part``, ``version``, ``position``, fields of ``result``: a group's rows after every micro-batch that changed them.

    The accumulator is a dict whose entries merge one by one; a state row holds a
    block of them, and a micro-batch reads and writes those of the items it names.  To
    emit, the entries of the items that ``agg.leading(acc)`` has named last time
    and of the changed ones do, where the object has that method (items that did
    not change can't come in); else all of the group's.  ``ttl`` lets entries
    expire so long after their last change (processing time), and emits what is
    left then, in the next micro-batch; start such a query with ``EXPIRY_CONF``,
    or an ``availableNow`` run never ends.  ``parts`` deals a group's items to so many states: a hot group
    is then worked on side by side, and ``latest`` joins its parts.
    """
    fields = _ddl(result)
    accs = partials(stream, keys, args, agg)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, part, accs = [], [], []
            for i, acc in enumerate(batch.column("_acc").to_pylist()):
                own: dict[int, dict] = {}
                for item, value in pickle.loads(acc).items():
                    own.setdefault(crc32(pickle.dumps(item)) % parts, {})[item] = value
                at += [i] * len(own)
                part += own
                accs += map(pickle.dumps, own.values())
            columns = [batch.column(k).take(pa.array(at, pa.int64())) for k in keys]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(accs, pa.binary()), pa.array(part, pa.int32())],
                                             [*keys, "_acc", "_part"])

    dealt = accs.mapInArrow(deal, T.StructType([*accs.schema, T.StructField("_part", T.IntegerType())]))
    schema = T.StructType([*(accs.schema[k] for k in keys), T.StructField("_part", T.IntegerType()),
                           T.StructField("version", T.LongType()), T.StructField("position", T.IntegerType()), *fields])
    processor = _Table(agg, schema.names, len(fields), duration_micros(ttl) // 1000 if ttl else None)
    own = _plain_names(dealt, [*keys, "_part"], acc="_acc")
    return own.groupBy(*own.columns[:len(keys) + 1]).transformWithStateInPandas(
        processor, schema, "Append", "ProcessingTime" if ttl else "None")


def latest(emitted: DataFrame, keys: list[str], agg, result: str | T.StructType) -> DataFrame:
    """keys, fields of ``result``: the rows last emitted per group, as a table.

    The parts of a group are joined by ``agg.join_rows(rows)`` where it has
    several: a few rows per part."""
    fields = _ddl(result)
    newest = emitted.groupBy(*keys, "_part").agg(F.max("version").alias("version"))
    same = [emitted[k].eqNullSafe(newest[k]) for k in [*keys, "_part", "version"]]
    rows = emitted.join(newest, same, "left_semi").where("position > 0")
    one = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_part", "position", *fields.names))).alias("rows"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = fields.names
        for batch in batches:
            at, out = [], []
            for i, own in enumerate(batch.column("rows").to_pylist()):
                listed = [tuple(r[f] for f in names) for r in own]
                listed = agg.join_rows(listed) if len({r["_part"] for r in own}) > 1 else listed
                at += [i] * len(listed)
                out += listed
            columns = [batch.column(k).take(pa.array(at, pa.int64())) for k in keys]
            values = [pa.array([r[j] for r in out], to_arrow_type(f.dataType)) for j, f in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([*columns, *values], [*keys, *names])

    return one.mapInArrow(join, T.StructType([*(emitted.schema[k] for k in keys), *fields]))
