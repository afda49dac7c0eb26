import datetime as dt

from pyspark.sql import functions as F

from kerbstone.functions import enrichment


def test_speed_band_bounds(spark):
    table = {None: "UNKNOWN", 0.0: "VERY_SLOW", 19.99: "VERY_SLOW", 20.0: "SLOW", 49.9: "SLOW", 50.0: "MODERATE",
             79.9: "MODERATE", 80.0: "FAST", 109.9: "FAST", 110.0: "VERY_FAST", 250.0: "VERY_FAST"}
    df = spark.createDataFrame([(v,) for v in table], "x double")
    assert [r.y for r in df.select(enrichment.speed_band(F.col("x")).alias("y")).collect()] == list(table.values())


def test_speed_excess(spark):
    rows = [(60.0, 50), (40.0, 50), (50.0, 50), (None, 50), (60.0, None), (60.125, 50), (60.124, 50)]
    df = spark.createDataFrame(rows, "s double, l int")
    got = df.select(enrichment.speed_excess(F.col("s"), F.col("l")).alias("y"))
    assert got.dtypes == [("y", "double")]
    assert [r.y for r in got.collect()] == [10.0, 0.0, 0.0, None, None, 10.13, 10.12]


def test_safety_score(spark):
    rows = [(False, False), (True, False), (False, True), (True, True), (None, None), (True, None), (None, True)]
    df = spark.createDataFrame(rows, "near_miss_event boolean, brake_event boolean")
    flags = {c: F.col(c) for c in df.columns}
    assert [r.y for r in df.select(enrichment.safety_score(flags).alias("y")).collect()] == [10.0, 7.0, 9.0, 6.0, 10.0, 7.0, 9.0]


def test_weather_severity(spark):
    table = {"CLEAR": "LOW", "WINDY": "LOW", "RAIN": "MEDIUM", "FOG": "MEDIUM", "STORM": "HIGH", "SNOW": "HIGH",
             "HAIL": "HIGH", "MUD": "UNKNOWN", None: "UNKNOWN"}
    df = spark.createDataFrame([(v,) for v in table], "x string")
    assert [r.y for r in df.select(enrichment.weather_severity(F.col("x")).alias("y")).collect()] == list(table.values())


def test_time_parts(spark):
    df = spark.createDataFrame([("2024-01-01 08:30:00",), ("2024-01-07 12:00:00",), (None,)], "t string")
    parts = enrichment.time_parts(F.to_timestamp("t"))
    got = [tuple(r) for r in df.select(*(c.alias(n) for n, c in parts.items())).collect()]
    monday, sunday = dt.date(2024, 1, 1), dt.date(2024, 1, 7)
    assert (monday.isoweekday(), sunday.isoweekday()) == (1, 7)
    assert got == [(2024, 1, 1, 8, 2, True), (2024, 1, 7, 12, 1, False), (None,) * 6]
