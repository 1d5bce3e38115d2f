"""Accesses to state, each a call to the state server: by block and list, not by item and pane."""

import pickle

import pandas as pd

from eventide.operators.aggregates import TopCounts
from eventide.streaming.stateful import BLOCKS, _Table, _Windows


class State:
    def __init__(self, calls):
        self.calls, self.one, self.many, self.map = calls, None, [], {}

    def __getattribute__(self, name):
        if name in ("get", "update", "exists", "getValue", "updateValue", "containsKey", "keys", "iterator", "appendList", "put", "removeKey"):
            self.calls.append(name)
        return object.__getattribute__(self, name)

    def exists(self):
        return self.one is not None

    def get(self):
        return self.one if self.one is not None else iter(self.many)

    def update(self, row):
        self.one = row

    def clear(self):
        self.one, self.many = None, []

    def appendList(self, rows):
        self.many += rows

    def put(self, rows):
        self.many = list(rows)

    def getValue(self, key):
        return self.map.get(key)

    def updateValue(self, key, value):
        self.map[key] = value

    def containsKey(self, key):
        return key in self.map

    def keys(self):
        return iter(list(self.map))

    def iterator(self):
        return iter(list(self.map.items()))


class Handle:
    def __init__(self):
        self.calls, self.timers = [], []

    def state(self, *_):
        return State(self.calls)

    getMapState = getListState = getValueState = state

    def registerTimer(self, at):
        self.timers.append(at)


class Times:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now


def test_a_table_aggregate_reads_and_writes_blocks():
    table, handle = _Table(TopCounts(3), ["sex", "_part", "version", "position", "name", "cnt"], 2, None), Handle()
    table.init(handle)
    n = 20 * BLOCKS
    add = lambda names: [r for f in table.handleInputRows(("m", 0), [pd.DataFrame({"acc": [pickle.dumps(names)]})], None)
                         for r in f.itertuples(index=False, name=None)]
    add({f"n{i}": 1 for i in range(n)})
    assert len(handle.calls) <= 2 * BLOCKS + 10
    handle.calls.clear()
    got = add({f"n{n - 1}": 2, "new": 3})
    assert got == [("m", 0, 2, 1, f"n{n - 1}", 3), ("m", 0, 2, 2, "new", 3), ("m", 0, 2, 3, "n0", 1)]
    assert len(handle.calls) <= 4 + 10


def test_windows_read_and_write_their_panes_at_once():
    windows, handle = _Windows(TopCounts(1), 60_000, 1_000, ["s", "e", "sex", "name", "cnt"], True), Handle()
    windows.init(handle)
    key, panes = ("m", 0), [1_000 * i for i in range(500)]
    frame = pd.DataFrame({"pane": panes, "acc": [pickle.dumps({"a": 1, f"n{i}": 2}) for i in range(500)]})
    assert not list(windows.handleInputRows(key, [frame, frame], Times(0)))
    assert handle.timers == [60_000]
    got = [r for f in windows.handleExpiredTimer(key, Times(400_000), None) for r in f.itertuples(index=False, name=None)]
    assert [r[0] for r in got] == [1_000 * i for i in range(341)]
    assert {r[3:] for r in got} == {("a", 120)}
    assert handle.timers[-1] == 401_000 and len(handle.calls) <= 20
