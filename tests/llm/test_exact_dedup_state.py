from pyspark.sql import functions as F

from eventide.llm import exact_dedup as ed


def test_later_calls_are_compared_with_earlier_content(spark, tmp_path):
    """Three calls on one state, with a digest that all texts share."""
    state, seen = f"{tmp_path}/state", []
    calls = [[(1, "a"), (2, "b"), (3, "a")], [(11, "b"), (12, "c"), (13, "a")], [(21, "c"), (22, "a")], [(31, "b"), (0, "a")]]
    for k, rows in enumerate(calls):
        path = f"{tmp_path}/docs {k}"  # encoded in a locator
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
        docs = spark.read.parquet(path)
        seen += rows
        out = {r["id"]: r for r in ed.groups(docs, digest=lambda c: F.lit("same").cast("string"), state=state).collect()}
        assert set(out) == {i for i, _ in rows}
        for i, t in rows:
            same = [j for j, u in seen if u == t]
            assert (out[i]["keep_id"], out[i]["group_size"], out[i]["kept"]) == (min(same), len(same), min(same) == i), (i, t)
