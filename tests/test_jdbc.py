import uuid

from pyspark.sql import functions as F

from eventide.functions import schemas
from eventide.operators import fold_changes
from eventide.sinks import jdbc_execute, jdbc_upsert, jdbc_write
from eventide.sinks.cdc_jdbc import apply_folded, create_cdc_tables
from eventide.sources import jdbc_table
from tests.conftest import rows

URL = "jdbc:derby:memory:eventide_tests;create=true"
PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _name(p):
    return f"{p}_{uuid.uuid4().hex[:8]}"


def test_partitioned_read_and_upsert(spark):
    src, dst = _name("words"), _name("wordcount")
    words = spark.createDataFrame([(i, w) for i, w in enumerate(["a", "b", "a", "c", "a", None, "b"])], schemas.WORDS_JDBC)
    jdbc_write(words, URL, src, "overwrite", PROPS)
    r = jdbc_table(spark, URL, src, "id", properties=PROPS, num_partitions=3)
    assert r.rdd.getNumPartitions() == 3
    plan = r.where("id > 1")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,1)" in plan  # the filter reaches the database
    jdbc_execute(spark, URL, [f'CREATE TABLE {dst} ("word" VARCHAR(64) NOT NULL PRIMARY KEY, "cnt" BIGINT)'], PROPS)
    counts = r.where(F.col("word").isNotNull()).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    jdbc_upsert(counts, URL, dst, ["word"], PROPS, batch_id=1, casts={"word": "VARCHAR(64)"})
    assert rows(jdbc_table(spark, URL, dst, properties=PROPS)) == [("a", 3), ("b", 2), ("c", 1)]
    # new counts for the same keys; a replayed batch id is skipped
    more = spark.createDataFrame([("a", 10), ("d", 1)], "word string, cnt bigint")
    jdbc_upsert(more, URL, dst, ["word"], PROPS, batch_id=2, casts={"word": "VARCHAR(64)"})
    jdbc_upsert(spark.createDataFrame([("a", 99)], "word string, cnt bigint"), URL, dst, ["word"], PROPS,
                batch_id=2, casts={"word": "VARCHAR(64)"})
    assert rows(jdbc_table(spark, URL, dst, properties=PROPS)) == [("a", 10), ("b", 2), ("c", 1), ("d", 1)]


def test_cdc_apply_out_of_order(spark):
    t = _name("words_cdc")
    create_cdc_tables(spark, URL, t, PROPS)
    new = [("u", 5, (1, None), (1, "new")), ("d", 6, (2, None), None), ("c", 7, None, (3, None))]
    old = [("r", 1, None, (1, "old")), ("r", 2, None, (2, "two")), ("r", 3, None, (4, "four"))]
    for batch in (new, old, new):   # newest first, then older records, then a replay
        apply_folded(fold_changes(spark.createDataFrame(batch, schemas.CHANGE_RECORD)), URL, t, PROPS)
    assert rows(jdbc_table(spark, URL, t, properties=PROPS)) == [(1, "new"), (3, None), (4, "four")]


def test_upsert_sql_dialects():
    from eventide.sinks.jdbc import _merge_sql

    m = _merge_sql("wc", "stg", ["word"], ["word", "cnt"], "merge", {"word": "VARCHAR(64)"})
    assert m == ('MERGE INTO wc t USING stg s ON t."word" = CAST(s."word" AS VARCHAR(64)) '
                 'WHEN MATCHED THEN UPDATE SET "cnt" = s."cnt" '
                 'WHEN NOT MATCHED THEN INSERT ("word", "cnt") VALUES (CAST(s."word" AS VARCHAR(64)), s."cnt")')
    assert _merge_sql("wc", "stg", ["word"], ["word", "cnt"], "mysql") == (
        "INSERT INTO wc (`word`, `cnt`) SELECT `word`, `cnt` FROM stg ON DUPLICATE KEY UPDATE `cnt` = VALUES(`cnt`)")
    assert _merge_sql("wc", "stg", ["word"], ["word", "cnt"], "postgres") == (
        'INSERT INTO wc ("word", "cnt") SELECT "word", "cnt" FROM stg ON CONFLICT ("word") DO UPDATE SET '
        '"cnt" = EXCLUDED."cnt"')


def test_read_with_predicates(spark):
    t = _name("skewed")
    jdbc_write(spark.createDataFrame([(1, "hot")] * 5 + [(2, "a"), (3, "b")], schemas.WORDS_JDBC), URL, t,
               "overwrite", PROPS)
    r = jdbc_table(spark, URL, t, properties=PROPS,
                   predicates=['"id" = 1', '"id" = 2', '"id" > 2'])
    assert r.rdd.getNumPartitions() == 3 and r.count() == 7


def test_fresh_checkpoint_and_other_queries_start_afresh(spark):
    t = _name("wc")
    jdbc_execute(spark, URL, [f'CREATE TABLE {t} ("word" VARCHAR(64) NOT NULL PRIMARY KEY, "cnt" BIGINT)'], PROPS)
    put = lambda n, batch, query: jdbc_upsert(
        spark.createDataFrame([("a", n)], "word string, cnt bigint"), URL, t, ["word"], PROPS, batch_id=batch,
        casts={"word": "VARCHAR(64)"}, query_id=query)
    put(1, 0, "q1"), put(2, 1, "q1"), put(9, 1, "q1")
    assert rows(jdbc_table(spark, URL, t, properties=PROPS)) == [("a", 2)]
    put(5, 0, "q2")
    assert rows(jdbc_table(spark, URL, t, properties=PROPS)) == [("a", 5)]


def test_long_words_fail_loudly_and_leave_nothing(spark):
    import pytest

    t = _name("wc")
    jdbc_execute(spark, URL, [f'CREATE TABLE {t} ("word" VARCHAR(64) NOT NULL PRIMARY KEY, "cnt" BIGINT)'], PROPS)
    df = spark.createDataFrame([("x" * 2000, 1), ("b", 1)], "word string, cnt bigint")
    with pytest.raises(ValueError, match="longer than"):
        jdbc_upsert(df, URL, t, ["word"], PROPS, casts={"word": "VARCHAR(64)"})
    assert jdbc_table(spark, URL, t, properties=PROPS).count() == 0
    c = _name("words_cdc")
    create_cdc_tables(spark, URL, c, PROPS)
    change = spark.createDataFrame([("c", 1, None, (1, "y" * 2000))], schemas.CHANGE_RECORD)
    with pytest.raises(ValueError, match="longer than"):
        apply_folded(fold_changes(change), URL, c, PROPS)
    left = spark.read.format("jdbc").option("url", URL).options(**PROPS).option(
        "query", f"SELECT COUNT(*) AS n FROM SYS.SYSTABLES WHERE TABLENAME LIKE '{t.upper()}_%' "
                 f"OR TABLENAME LIKE '{c.upper()}_CHG%'").load().first()[0]
    assert left == 0  # staging tables are gone


def test_a_failed_statement_rolls_back(spark):
    import pytest

    t = _name("tx")
    jdbc_execute(spark, URL, [f"CREATE TABLE {t} (a INT PRIMARY KEY)"], PROPS)
    with pytest.raises(Exception, match="(?i)duplicate"):
        jdbc_execute(spark, URL, [f"INSERT INTO {t} VALUES (1)", f"INSERT INTO {t} VALUES (1)"], PROPS)
    assert jdbc_table(spark, URL, t, properties=PROPS).count() == 0


def test_dialect_statements():
    from eventide.sinks.cdc_jdbc import apply_statements, cdc_ddl
    from eventide.sinks.dialects import MERGE, MYSQL, POSTGRES, dialect_for

    assert dialect_for("jdbc:mysql://h/db") is MYSQL and dialect_for("jdbc:postgresql://h/db") is POSTGRES
    assert dialect_for("jdbc:derby:memory:x") is MERGE and dialect_for("jdbc:derby:x", "mysql") is MYSQL
    assert MYSQL.bounds("w", "id") == "SELECT MIN(`id`) AS lo, MAX(`id`) AS hi FROM w"
    assert MYSQL.quote("a`b") == "`a``b`" and POSTGRES.quote('a"b') == '"a""b"'
    assert MYSQL.upsert("st", "stg", ["k"], ["k", "seq", "deleted"], newer="seq") == (
        "INSERT INTO st (`k`, `seq`, `deleted`) SELECT `k`, `seq`, `deleted` FROM stg ON DUPLICATE KEY UPDATE "
        "`deleted` = IF(VALUES(`seq`) > `seq`, VALUES(`deleted`), `deleted`), "
        "`seq` = IF(VALUES(`seq`) > `seq`, VALUES(`seq`), `seq`)")
    assert POSTGRES.upsert("st", "stg", ["k"], ["k", "seq"], {"k": "VARCHAR(9)"}, newer="seq") == (
        'INSERT INTO st ("k", "seq") SELECT CAST("k" AS VARCHAR(9)), "seq" FROM stg ON CONFLICT ("k") DO UPDATE SET '
        '"seq" = EXCLUDED."seq" WHERE EXCLUDED."seq" > st."seq"')
    for d in (MERGE, MYSQL, POSTGRES):
        state, delete, insert = apply_statements("m", "stg", d, "key", ["a", "b"])
        q = d.quote
        assert delete.startswith("DELETE FROM m WHERE EXISTS") and f"m.{q('key')}" in delete
        assert insert.startswith(f"INSERT INTO m ({q('key')}, {q('a')}, {q('b')}) SELECT s.{q('key')}, s.{q('a')}, s.{q('b')}")
        assert cdc_ddl("m", d, {"key": "BIGINT", "a": "INT"}, "key")[0] == (
            f"CREATE TABLE m ({q('key')} BIGINT NOT NULL PRIMARY KEY, {q('a')} INT)")
