import math

from pyspark.sql import functions as F

from kerbstone import rules
from kerbstone.functions import cleaning


def test_standardise_strips_blanks_only(spark):
    df = spark.createDataFrame([("  \tcar ",), (" rain ",), ("",), (None,)], "x string")
    assert [r.y for r in df.select(cleaning.standardise("x").alias("y")).collect()] == ["\tCAR", "RAIN", "", None]


def test_clip_keeps_null_and_type_and_moves_nan_up(spark):
    values = [None, -1.0, 0.0, 12.5, 250.0, 250.1, math.nan, math.inf, -math.inf]
    df = spark.createDataFrame([(v,) for v in values], "x double").select(cleaning.clip("x", 0.0, 250.0).alias("y"))
    assert [r.y for r in df.collect()] == [None, 0.0, 0.0, 12.5, 250.0, 250.0, 250.0, 250.0, 0.0]
    ints = spark.createDataFrame([(v,) for v in (None, -1, 1, 3, 5, 99)], "x int").select(cleaning.clip("x", 1, 5).alias("y"))
    assert ints.dtypes == [("y", "int")]
    assert [r.y for r in ints.collect()] == [None, 1, 1, 3, 5, 5]


def test_every_allow_list_keeps_its_members_and_nothing_else(spark):
    for column, allowed in rules.ALLOWED.items():
        kind = "int" if isinstance(allowed[0], int) else "string"
        strangers = [45, 0] if kind == "int" else ["HOVERCRAFT", "", f" {allowed[0]}", allowed[0].lower()]
        df = spark.createDataFrame([(v,) for v in [*allowed, *strangers, None]], f"{column} {kind}")
        kept = df.select(F.col(column).alias("x"), cleaning.keep_allowed(column, allowed).alias("y")).collect()
        assert [r.y for r in kept] == [*allowed] + [None] * (len(strangers) + 1), column
