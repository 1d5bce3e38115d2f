import hashlib
import re

from pyspark.sql import functions as F

from eventide.llm import exact_dedup as ed

from llm_cases import TEXTS


def _brute(texts):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in texts]
    out = []
    for i, body in norm:
        same = [j for j, b in norm if b == body]
        keep = min((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


def _got(df):
    return sorted(((r["id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in df.collect()), key=repr)


def test_groups_match_brute_force(edge):
    out = ed.groups(edge)
    assert _got(out) == _brute(TEXTS)
    kept = out.where("kept").groupBy("text_sha256").count()
    assert kept.where("count <> 1").count() == 0
    assert kept.count() == out.select("text_sha256").distinct().count()


def test_colliding_digests_are_told_apart_by_bytes(edge):
    weak = ed.groups(edge, digest=lambda c: F.substring(F.sha2(c, 256), 1, 1))
    assert _got(weak) == _brute(TEXTS)
    assert weak.where("kept").count() == len({h for *_, h in _brute(TEXTS)})


def test_state_continues_with_later_arrivals(spark, tmp_path):
    rows, state = f"{tmp_path}/rows", f"{tmp_path}/state"
    for i, keys in enumerate((["a", "b", "a"], ["b", "c"])):
        part = [(k, 10 * i + j, {"path": "f", "row": 10 * i + j}) for j, k in enumerate(keys)]
        spark.createDataFrame(part, "digest string, id long, loc struct<path: string, row: long>").write.mode("append").parquet(rows)
        out = {r["digest"]: (r["first"]["id"], r["seen"]) for r in ed.retained(spark, rows, state).collect()}
    assert out == {"a": (0, 2), "b": (1, 2), "c": (11, 1)}


def test_deduplicate_keeps_columns_and_empty_tables(edge, nothing):
    out = ed.deduplicate(edge)
    assert out.columns == edge.columns
    assert out.count() == len({h for *_, h in _brute(TEXTS)})
    assert {r["loc"] for r in out.collect()} == {"mine"}
    assert ed.groups(nothing).count() == 0 and ed.deduplicate(nothing).count() == 0


def test_main_path_has_no_python(edge, spark):
    plan = ed.groups(edge)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
