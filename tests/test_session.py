"""Registered queries run with methods the JVM compiles, in whatever session."""

from __future__ import annotations

from datetime import datetime

import __spark_entry__ as entry
from kerbstone import session

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def _query(spark, folder: str):
    rows = [(i, datetime(2024, 1, 1, i), i % 3, "view", 1.5, '{"n": 7}') for i in range(1, 20)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/events.parquet")
    return entry.queries()["silver_full"](spark, folder)


def test_queries_are_read_with_jit_sized_methods(spark, tmp_path):
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, 65535)  # Spark's default
    try:
        rows = _query(spark, str(tmp_path))
        assert int(spark.conf.get(LIMIT)) == session.JIT_METHOD_LIMIT  # when the caller reads them
        assert rows.count() > 0
    finally:
        spark.conf.set(LIMIT, before)


def test_a_smaller_limit_stays(spark):
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, 4000)
    try:
        session.use_jit_sized_methods(spark)
        assert int(spark.conf.get(LIMIT)) == 4000
    finally:
        spark.conf.set(LIMIT, before)
