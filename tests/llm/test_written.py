"""Written tables and their shuffle files."""

import os
import time

from pyspark.sql import functions as F

import corpus_pipeline
from eventide.llm import jaccard_join, suffix_dedup
from eventide.llm.common import CLEAN_SHUFFLES, removed, written
from eventide.session import checkpoint_root


def tables(spark):
    """Files of the written tables, by table."""
    root = checkpoint_root(spark).removeprefix("file:") + "/eventide"
    return {d: os.listdir(f"{root}/{d}") for d in os.listdir(root)} if os.path.isdir(root) else {}


def left(spark, before):
    """Names of the tables written since."""
    return {d.rsplit("-", 1)[0] for d in tables(spark).keys() - before.keys()}


def near_copies(spark):
    """Texts of 300 words; of each, a copy with another last word, and one paragraph that all share."""
    shared = " ".join(f"shared{j}" for j in range(70))
    texts = [" ".join([*(f"w{i}x{j}" for j in range(230)), shared, end]) for i in range(6) for end in ("one", "two")]
    return written(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "cases")


def test_written_tables_leave_no_shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for d in manager.localDirs() for _, _, fs in os.walk(d.toString()) for f in fs if f.startswith("shuffle_")}

    before, setting = files(), spark.conf.get(CLEAN_SHUFFLES, None)
    out = written(spark.range(1000).repartition(5, F.col("id") % 7), "costs")
    for _ in range(50):  # they are removed in the background
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before
    assert out.count() == 1000 and spark.conf.get(CLEAN_SHUFFLES, None) == setting


def test_a_removed_table_is_gone(spark):
    out = written(spark.range(10), "costs")
    before = tables(spark)
    removed(out)
    assert len(before) - len(tables(spark)) == 1


def test_near_copies_leave_only_the_tables_of_their_result(spark):
    docs = near_copies(spark)
    before = tables(spark)
    out = jaccard_join.deduplicate(docs)
    assert left(spark, before) <= {"jaccard-sets", "jaccard-first", "components"}
    for _ in range(2):  # the result can be run again
        assert sorted(r["doc_id"] for r in out.collect()) == [0, 2, 4, 6, 8, 10]


def test_repeated_strings_leave_only_their_ranges(spark):
    docs = near_copies(spark)
    for hot in (suffix_dedup.HOT, 1):  # with 1, every anchor is cut twice
        before = tables(spark)
        out = suffix_dedup.deduplicate(docs.where("doc_id % 2 = 0").select("doc_id", "text"), hot=hot)
        assert left(spark, before) <= {"suffix-covered", "dedup-content"}
        for _ in range(2):
            got = {r["doc_id"]: r["text"] for r in out.collect()}
            assert len(got) == 6 and all(f"w{i // 2}x0 " in t and "shared30" not in t for i, t in got.items())


def test_the_pipeline_keeps_the_table_of_its_last_stage_only(spark, tmp_path):
    docs = near_copies(spark).selectExpr("doc_id", "text", "'en' AS lang", "'web' AS source", "length(text) AS n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    before = tables(spark)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert {n for n in left(spark, before) if n.startswith("pipeline-")} == {"pipeline-repeated-strings"}
