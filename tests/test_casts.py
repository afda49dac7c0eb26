import math
import random

import pytest
from pyspark.sql import functions as F

from kerbstone.functions import casts


def _apply(spark, cast, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in df.select("i", cast("x").alias("y")).orderBy("i").collect()]


INTS = {
    "42": 42, " 42 ": 42, "-7": -7, "+7": 7, "12.5": 12, "-3.9": -3, "12.": 12, ".5": 0, "-.5": 0,
    ".": 0, "-": None, "": None, "  ": None, "5.5.5": None, "12.5x": None, "12.5e1": None,
    "1_000": None, "1e2": None, "\t7.5": 7, "7\n": 7, "2147483647.9": 2147483647, "-0.9": 0,
    "0012.0": 12, "99999999999": None, "99999999999.5": None, "FAST": None, "HIGH": None, None: None,
}
DOUBLES = {
    "42": 42.0, " 42 ": 42.0, "12.5": 12.5, "1e2": 100.0, "50d": 50.0, "50f": 50.0, "FAST": None,
    "": None, "Infinity": math.inf, "-Infinity": -math.inf, None: None,
}
BOOLEANS = {"true": True, "t": True, "yes": True, "1": True, "FALSE": False, "no": False, "2": None,
            "": None, None: None}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_hand_rows_in_both_ansi_modes(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for cast, table in ((casts.to_int, INTS), (casts.to_double, DOUBLES), (casts.to_boolean, BOOLEANS)):
            assert dict(zip(table, _apply(spark, cast, table))) == table
        assert math.isnan(_apply(spark, casts.to_double, ["NaN"])[0])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_equal_to_casts_without_ansi_on_random_text(spark):
    rng = random.Random(7)
    alphabet = "0123456789..+- \t\n\x01\x7fexXdf "
    values = ["".join(rng.choices(alphabet, k=rng.randint(0, 7))) for _ in range(20_000)]
    values += [sign + str(n) + tail for sign in ("", "-", "+")
               for n in (0, 7, 2147483647, 2147483648, 2147483649)
               for tail in ("", ".", ".0", ".9", " ", ".x")]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for cast, kind in ((casts.to_int, "int"), (casts.to_double, "double"), (casts.to_boolean, "boolean")):
            differs = df.filter(~cast("x").eqNullSafe(F.col("x").cast(kind)))
            assert differs.limit(5).collect() == []
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_timestamps(spark):
    values = ["2026-06-10T12:00:00+03:00", "2024-01-01T00:09:58.778549+00:00", "soon", "", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = df.select("i", casts.to_timestamp("x").cast("string").alias("y")).orderBy("i").collect()
    assert [r.y for r in got] == ["2026-06-10 09:00:00", "2024-01-01 00:09:58.778549", None, None, None]
