import os
import tempfile

import pytest
from pyspark.sql import functions as F

from eventide.operators import explode_json, register_split_dict
from eventide.sources import csv_json_cells
from tests.conftest import rows

# Invented rows in the shape of the table-function job's input: BOM, quoted
# multi-line JSON with doubled quotes, an empty cell.
CSV = ('﻿k1,"[\n  {\n    ""bs3_name"": ""alpha"",\n    ""bs3_name_id"": 11,\n    ""bs1_name_id"": 12,\n'
       '    ""bs2_name_id"": 13,\n    ""bs2_name"": ""beta"",\n    ""bs1_name"": ""gamma""\n  }\n]"\n'
       'k2,"[\n  {""bs3_name"": ""delta"", ""bs3_name_id"": 21, ""bs1_name_id"": 22, ""bs2_name_id"": 23,\n'
       '   ""bs2_name"": ""eps"", ""bs1_name"": ""zeta""},\n  {""bs3_name"": ""eta"", ""bs3_name_id"": ""31"",'
       ' ""bs1_name_id"": 32, ""bs2_name_id"": 33, ""bs2_name"": ""theta"", ""bs1_name"": ""iota""}\n]"\n'
       'k3,\n')


@pytest.fixture(scope="module")
def input_table(spark):
    d = tempfile.mkdtemp(prefix="eventide-lateral-")
    with open(os.path.join(d, "input.csv"), "w", encoding="utf-8") as f:
        f.write(CSV)
    return csv_json_cells(spark, d)


def test_csv_reads_three_records(input_table):
    got = rows(input_table, "id")
    assert got == [("k1",), ("k2",), ("k3",)]
    assert input_table.where("id = 'k3'").first()["bs_info"] is None


def test_inner_and_left(input_table):
    inner = explode_json(input_table, "bs_info")
    left = explode_json(input_table, "bs_info", outer=True)
    assert inner.count() == 3 and left.count() == 4
    r = {x["bs3_name"]: x for x in inner.collect()}
    assert r["alpha"]["bs3_name_id"] == 11 and r["eta"]["bs3_name_id"] == 31   # number as text converts
    assert left.where("id = 'k3'").first()["bs3_name"] is None


def test_edge_cells(spark):
    df = spark.createDataFrame([("a", "[]"), ("b", None), ("c", "[{broken"), ("d", '[{"bs3_name": "x"}]')],
                               "id string, bs_info string")
    assert rows(explode_json(df, "bs_info"), "id", "bs3_name", "bs1_name_id") == [("d", "x", None)]
    assert explode_json(df, "bs_info", outer=True).count() == 4
    with pytest.raises(Exception):
        explode_json(df, "bs_info", strict=True).collect()


def test_udtf_matches_native(spark, input_table):
    register_split_dict(spark)
    sql = spark.sql("SELECT t.id, s.* FROM {t} t, LATERAL split_dict(t.bs_info) s", t=input_table)
    assert rows(sql) == rows(explode_json(input_table, "bs_info"))


def test_udtf_left_lateral(spark, input_table):
    from eventide.operators import lateral_split_dict
    assert rows(lateral_split_dict(input_table, outer=True)) == rows(explode_json(input_table, "bs_info", outer=True))


def test_number_rule_is_the_same_in_both_forms(spark):
    cells = ['[{"bs3_name_id": 1.0, "bs1_name_id": 2.7, "bs2_name_id": -2.7}]',
             '[{"bs3_name_id": "31", "bs1_name_id": " 7 ", "bs2_name_id": "2.5"}]',
             '[{"bs3_name_id": true, "bs1_name_id": "x", "bs2_name_id": 99999999999}]', '[{"bs3_name": 5}]', "{}", "[1]"]
    df = spark.createDataFrame([(str(i), c) for i, c in enumerate(cells)], "id string, bs_info string")
    register_split_dict(spark)
    sql = rows(spark.sql("SELECT t.id, s.* FROM {t} t, LATERAL split_dict(t.bs_info) s WHERE t.id < '4'", t=df))
    native = rows(explode_json(df.where("id < '4'"), "bs_info"))
    assert sql == native
    ids = {r[0]: r[2:5] for r in native}
    assert ids["0"] == (1, 2, -2) and ids["1"] == (31, 7, 2) and ids["2"] == (None, None, None)
    assert spark.sql("SELECT t.id, s.* FROM {t} t, LATERAL split_dict(t.bs_info) s WHERE t.id >= '4'", t=df).count() == 0
