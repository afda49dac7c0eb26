import hashlib

from kerbstone.functions import keys


def _md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_known_digests(spark):
    df = spark.createDataFrame([("R1", None, "NORTH", "5")], "road_id string, lane_type string, direction string, vehicle_id string")
    row = df.selectExpr(keys.key("road_key") + " as r", keys.key("vehicle_key") + " as v").first()
    assert row.r == _md5("R1|UNKNOWN|NORTH")
    assert row.v == "e4da3b7fbbce2345d7772b0674a318d5"


def test_numbers_are_not_padded_and_null_is_the_word_unknown(spark):
    schema = "event_year int, event_month int, event_day int, event_hour_clean int"
    df = spark.createDataFrame([(2024, 1, 2, 3), (None,) * 4], schema)
    got = [r.k for r in df.selectExpr(keys.key("time_key") + " as k").collect()]
    assert got == [_md5("2024|1|2|3"), _md5("UNKNOWN|UNKNOWN|UNKNOWN|UNKNOWN")]


def test_collisions_are_part_of_the_contract(spark):
    rows = [("a|b", "c", "d"), ("a", "b|c", "d"), (None, "x", "y"), ("UNKNOWN", "x", "y")]
    df = spark.createDataFrame(rows, "road_id string, lane_type string, direction string")
    a, b, c, d = (r.k for r in df.selectExpr(keys.key("road_key") + " as k").collect())
    assert a == b and c == d


def test_incident_key_is_taken_over_as_it_is(spark):
    df = spark.createDataFrame([("I1",), (None,)], "incident_id string")
    assert [r.k for r in df.selectExpr(keys.key("incident_key") + " as k").collect()] == ["I1", None]


def test_grouping_text_is_the_digested_text(spark):
    df = spark.createDataFrame([("RED", 5), ("RED", None), (None, 5)], "signal_phase string, signal_time_elapsed_s int")
    got = df.selectExpr(keys.key("signal_key") + " as k", f"md5({keys.key_text('signal_key')}) as t").collect()
    assert all(r.k == r.t for r in got)
