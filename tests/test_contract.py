import os
import sys

import pytest

import __spark_entry__ as se
from eventide.plans import catalog

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import oracle_check  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")
def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.columns == ["start_time", "end_time", "sex", "name", "cnt"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries())
    assert set(catalog.queries()) <= set(se.queries()) and set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")
def test_queries_match_oracle(spark):
    res = oracle_check.check(spark, list(catalog.queries()), SF)
    bad = {k: v for k, v in res.items() if v.get("match") is not True}
    assert not bad, bad
