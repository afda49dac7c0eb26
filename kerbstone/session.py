"""Spark session with the settings the pipeline's results depend on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# HotSpot leaves methods above this many bytes of bytecode uncompiled.
JIT_METHOD_LIMIT = 8000
_METHOD_LIMIT_SETTING = "spark.sql.codegen.hugeMethodLimit"


def builder(app_name: str, fmt: str = "parquet", hive: bool = False) -> SparkSession.Builder:
    """A session builder; add ``.master(...)`` or more ``.config(...)`` as needed.

    The time zone is pinned because hours, weekdays and time keys depend on it; the
    method limit is explained at :func:`jit_sized_methods`.
    """
    b = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config(_METHOD_LIMIT_SETTING, JIT_METHOD_LIMIT)
    )
    if fmt == "delta":
        b = b.config(
            "spark.sql.extensions", "io.delta.sql.DeltaSparkSessionExtension"
        ).config(
            "spark.sql.catalog.spark_catalog", "org.apache.spark.sql.delta.catalog.DeltaCatalog"
        )
    return b.enableHiveSupport() if hive else b


@contextmanager
def jit_sized_methods(spark: SparkSession) -> Iterator[None]:
    """Run an action over a very wide projection with generated code that gets compiled.

    Whole-stage code for all silver columns is one method far above what the JVM
    compiles, so every row would be interpreted. With this limit Spark generates
    several smaller methods for such a stage (measured: 30 s against 10 s for three
    million rows). Sessions that were not built here get the setting for the action only.
    """
    before = spark.conf.get(_METHOD_LIMIT_SETTING)
    use_jit_sized_methods(spark)
    try:
        yield
    finally:
        spark.conf.set(_METHOD_LIMIT_SETTING, before)


def use_jit_sized_methods(spark: SparkSession) -> None:
    """The same for all that the session runs: the limit is read when a plan runs, not when it is made."""
    if int(spark.conf.get(_METHOD_LIMIT_SETTING)) > JIT_METHOD_LIMIT:
        spark.conf.set(_METHOD_LIMIT_SETTING, JIT_METHOD_LIMIT)
