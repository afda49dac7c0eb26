"""SQL access: the gold tables as external tables of one database."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql.types import StructField

from kerbstone import rules
from kerbstone.sinks.lakehouse import Lakehouse


def register_tables(
    spark: SparkSession,
    tables: Lakehouse,
    database: str = "Traffic",
    database_location: str | None = None,
    names: tuple[str, ...] = (*rules.DIMENSIONS, *rules.FACTS),
) -> list[str]:
    """Create and use the database, and register the gold tables by their locations.

    Existing objects stay, and evolving tables gain the columns that batches have brought
    since: register again to see them. Bronze, silver and quarantine stay unregistered.
    Batch folders are read recursively, so new batches need no partition repair: a
    running session sees them after ``REFRESH TABLE``.
    """
    at = f" LOCATION '{database_location}'" if database_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
    spark.catalog.setCurrentDatabase(database)
    options = "" if tables.fmt == "delta" else "OPTIONS (recursiveFileLookup 'true') "
    for name in names:
        schema = None if tables.is_delta else tables.schema(spark, tables.gold(name))
        columns = f"({_ddl(schema)}) " if schema else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} {columns}USING {tables.fmt} "
            f"{options}LOCATION '{tables.gold(name)}'"
        )
        there = set(spark.table(f"{database}.{name}").columns)
        added = [field for field in schema or () if field.name not in there]
        if added:
            spark.sql(f"ALTER TABLE {database}.{name} ADD COLUMNS ({_ddl(added)})")
        spark.catalog.refreshTable(f"{database}.{name}")  # no listing of files is kept
    return list(names)


def _ddl(fields: Iterable[StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
