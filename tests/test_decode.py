import datetime as dt

import pytest
from pyspark.sql.utils import AnalysisException  # noqa: F401

from eventide.functions import schemas
from eventide.sources import decode_json
from eventide.sinks import to_json_messages


TEXTS = [
    ('{"name":"ann","sex":"女","action":"click","is_delete":0,"ts":"2024-03-01 10:00:01"}', True),
    ('   {"name":"bo","is_delete":"oops","ts":"2024-03-01 10:00:02"}', True),   # bad field -> NULL
    ('{"name":"cy"}', True),                                                   # missing fields
    ('{"name":"dee","ts":"2024-03-01T10:00:03Z"}', True),                       # ISO text -> ts NULL
    ('{"name": {"nested": 1}}', True),                                          # object under STRING
    ('{"name":"ed"', False), ('', False), (None, False), ('[]', False), ('[{"name":"x"}]', False),
    ('"text"', False), ('42', False), ('null', False),
]


def test_tolerant_decode(spark):
    df = spark.createDataFrame([(t,) for t, _ in TEXTS], "value string")
    out = decode_json(df, schemas.USER_ACTION).collect()
    assert len(out) == sum(keep for _, keep in TEXTS)
    by = {r["name"]: r for r in out}
    assert by["ann"]["is_delete"] == 0 and by["ann"]["ts"] == dt.datetime(2024, 3, 1, 10, 0, 1)
    assert by["ann"]["sex"] == "女"
    assert by["bo"]["is_delete"] is None and by["bo"]["ts"] == dt.datetime(2024, 3, 1, 10, 0, 2)
    assert by["cy"]["ts"] is None and by["cy"]["action"] is None
    assert by["dee"]["ts"] is None
    assert by['{"nested":1}']["is_delete"] is None


def test_strict_decode_fails(spark):
    df = spark.createDataFrame([('{"name":"a"}',), ('{"name":',)], "value string")
    with pytest.raises(Exception):
        decode_json(df, schemas.USER_ACTION, strict=True).collect()


def test_message_roundtrip(spark):
    src = spark.createDataFrame(
        [("ann", "男", "click", 0, dt.datetime(2024, 3, 1, 10, 0, 1, 250000))], schemas.USER_ACTION)
    msg = to_json_messages(src)
    text = msg.first()["value"]
    assert '"ts":"2024-03-01 10:00:01"' in text and '"is_delete":0' in text
    back = decode_json(msg, schemas.USER_ACTION).first()
    assert back["ts"] == dt.datetime(2024, 3, 1, 10, 0, 1) and back["sex"] == "男"


def test_kafka_source_needs_connector(spark):
    from eventide.sources import kafka_json
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_json(spark, "localhost:9092", "user_action", "g1")
