import random

from hypothesis import given, settings, strategies as st

from eventide.operators import fold_changes, live_rows
from eventide.functions import schemas
from tests.conftest import rows


def rec(op, seq, bid, aid, word):
    before = None if op in ("r", "c") else (bid, None)
    after = None if op == "d" else (aid, word)
    return (op, seq, before, after)


def _df(spark, recs):
    return spark.createDataFrame(recs, schemas.CHANGE_RECORD)


def _apply_in_order(recs):
    table = {}
    for op, seq, before, after in sorted(recs, key=lambda r: r[1]):
        if op == "d":
            table.pop(before[0], None)
        else:
            if op == "u" and before is not None and before[0] != after[0]:
                table.pop(before[0], None)
            table[after[0]] = after[1]
    return sorted(table.items(), key=repr)


def _fold_batches(spark, batches):
    state = None
    for b in batches:
        state = fold_changes(_df(spark, b), state)
        state = spark.createDataFrame(state.collect(), state.schema)  # small test state, cut lineage
    return rows(live_rows(state), "id", "word")


def test_cases(spark):
    snap = [rec("r", 1, None, 1, "a"), rec("r", 2, None, 2, "b"), rec("r", 3, None, 3, None)]
    b1 = [rec("u", 4, 1, 1, "a2"), rec("d", 5, 2, None, None), rec("c", 6, None, 2, "b2"),  # delete then insert
          rec("u", 7, 3, 30, "moved")]                                                     # PK change
    b2 = [rec("d", 8, 1, None, None)]
    assert _fold_batches(spark, [snap, b1, b2]) == [(2, "b2"), (30, "moved")]
    # out of order across batches and a replayed batch
    assert _fold_batches(spark, [b2, b1, snap, b1]) == [(2, "b2"), (30, "moved")]
    # delete arriving before an older update must not revive the key
    assert _fold_batches(spark, [[rec("d", 9, 5, None, None)], [rec("c", 2, None, 5, "old")]]) == []


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10_000))
def test_fold_equals_replay_in_order(spark, seed):
    r = random.Random(seed)
    recs, live = [], set()
    for seq in range(1, 61):
        k = r.randrange(8)
        if k in live and r.random() < 0.3:
            recs.append(rec("d", seq, k, None, None)); live.discard(k)
        elif k in live:
            recs.append(rec("u", seq, k, k, f"w{seq}"))
        else:
            recs.append(rec("c", seq, None, k, r.choice([None, f"w{seq}"]))); live.add(k)
    r.shuffle(recs)
    batches = [recs[i::4] for i in range(4)]
    batches.append(batches[1])  # replay
    assert _fold_batches(spark, batches) == _apply_in_order(recs)


def test_bucketed_snapshot_rewrites_touched_buckets_only(spark):
    import glob
    import tempfile

    from eventide.sinks.cdc_files import fold_into_buckets, read_snapshot

    path = tempfile.mkdtemp(prefix="eventide-cdcb-") + "/table"
    snap = [rec("r", i, None, i, f"w{i}") for i in range(1, 41)]
    assert fold_into_buckets(_df(spark, snap), path, buckets=8) == 8
    # a bucket is rewritten in a version folder of its own
    files_before = {b: sorted(glob.glob(f"{path}/data/v=*/bucket={b}/*.parquet")) for b in range(8)}
    b2 = [rec("u", 100, 7, 7, "seven"), rec("d", 101, 9, None, None)]
    touched = fold_into_buckets(_df(spark, b2), path, buckets=8)
    assert touched <= 2
    changed = [b for b in range(8) if sorted(glob.glob(f"{path}/data/v=*/bucket={b}/*.parquet")) != files_before[b]]
    assert len(changed) == touched
    # out of order + replay
    fold_into_buckets(_df(spark, [rec("u", 50, 7, 7, "older")]), path, buckets=8)
    fold_into_buckets(_df(spark, b2), path, buckets=8)
    got = dict(rows(read_snapshot(spark, path), "id", "word"))
    assert got[7] == "seven" and 9 not in got and len(got) == 39


def test_snapshot_survives_a_write_cut_short_and_replays(spark, tmp_path):
    import os

    import pytest

    from eventide.sinks import cdc_files as cf

    path = f"{tmp_path}/table"
    live = lambda: rows(cf.read_snapshot(spark, path), "id", "word")
    assert cf.read_snapshot(spark, path) is None
    cf.fold_into_buckets(_df(spark, [rec("r", i, None, i, f"w{i}") for i in range(1, 9)]), path, 4, batch=("q", 0))
    before = live()
    # the data of the next version is written, its manifest is not
    cut = _df(spark, [rec("u", 50, 1, 1, "new")])
    publish, cf._publish = cf._publish, lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError, match="lost"):
            cf.fold_into_buckets(cut, path, 4, batch=("q", 1))
    finally:
        cf._publish = publish
    assert live() == before and not [f for f in os.listdir(path) if f.startswith("staged")]
    assert cf.fold_into_buckets(cut, path, 4, batch=("q", 1)) == 1 and dict(live())[1] == "new"
    # a batch that was published is recognised, another query's batch of that number is not
    assert cf.fold_into_buckets(_df(spark, [rec("u", 60, 2, 2, "again")]), path, 4, batch=("q", 1)) == 0
    assert cf.fold_into_buckets(_df(spark, [rec("u", 60, 2, 2, "other")]), path, 4, batch=("q2", 0)) == 1
    assert dict(live())[2] == "other"
    # another bucket count is refused; re-bucketing keeps every key once
    with pytest.raises(ValueError, match="4 buckets"):
        cf.fold_into_buckets(cut, path, 8)
    want = live()
    cf.rebucket(spark, path, 8)
    assert live() == want and cf.manifest(spark, path)["buckets"] == 8
    cf.fold_into_buckets(_df(spark, [rec("d", 70, 3, None, None)]), path, 8)
    cf.drop_tombstones(spark, path, 71)
    assert live() == [r for r in want if r[0] != 3]
    assert len(os.listdir(f"{path}/manifest")) <= 2 * cf.RETAIN + 2  # old versions are dropped
