import datetime as dt
import json

from compare import sorted_rows
from conftest import FIELDS
from kerbstone.operators import bronze as ops
from kerbstone.operators.routing import quarantine_reason

AT = dt.datetime(2024, 1, 1)


def _bronze(spark, *texts):
    rows = [(None if t is None else bytearray(t.encode()), AT) for t in texts]
    return ops.to_bronze(spark.createDataFrame(rows, "value binary, timestamp timestamp"))


def test_columns(spark):
    df = _bronze(spark, "{}")
    assert df.columns == ["raw_json", "kafka_timestamp", *FIELDS] and len(FIELDS) == 57
    kinds = dict(df.dtypes)
    assert sum(kinds[f] == "string" for f in FIELDS) == 50
    assert sum(kinds[f] == "boolean" for f in FIELDS) == 7


def test_numbers_keep_their_text_and_booleans_are_strict(spark):
    texts = [
        '{"event_id":"a","speed_kmh":40,"is_speeding":true}',
        '{"event_id":"a","speed_kmh":40.0,"is_speeding":"true"}',
        '{"event_id":"a","speed_kmh":1e2,"is_speeding":1}',
    ]
    got = [tuple(r) for r in _bronze(spark, *texts).select("event_id", "speed_kmh", "is_speeding").collect()]
    assert got == [("a", "40", True), ("a", "40.0", None), ("a", "100.0", None)]


def test_nested_unknown_and_upper_case_fields(spark):
    texts = ['{"event_id":"a","road_id":{"k":1},"new":2}', '{"EVENT_ID":"up"}', '{"event_id":null,"new":1}']
    got = [tuple(r) for r in _bronze(spark, *texts).select("event_id", "road_id").collect()]
    assert got == [("a", '{"k":1}'), (None, None), (None, None)]


def test_unreadable_text_is_kept_and_counts_as_missing_id(spark):
    texts = ["###CORRUPTED###", '{"event_id":"a","speed', "null", "[1]", '"###CORRUPTED_EVENT###"', "", None]
    df = _bronze(spark, *texts)
    assert [r.raw_json for r in df.collect()] == texts
    assert all(r[f] is None for r in df.collect() for f in FIELDS)
    assert {r.q for r in df.select(quarantine_reason().alias("q")).collect()} == {"NULL_EVENT_ID"}


def test_envelope_of_a_corrupt_event(spark):
    df = _bronze(spark, json.dumps({"raw": "###CORRUPTED_EVENT###", "schema_version": "2.1.0"}))
    assert df.select(quarantine_reason().alias("q")).first().q == "CORRUPT_JSON"


def test_json_round_trip_equals_the_rows_computed_directly(messages, bronze):
    assert sorted_rows(ops.to_bronze(messages)) == sorted_rows(bronze)
