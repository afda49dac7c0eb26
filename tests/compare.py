"""Order-insensitive comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import contextlib
import io
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_FAMILY = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean",
    "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def _key(row: tuple) -> tuple:
    return tuple((v is not None, isinstance(v, float) and math.isnan(v), str(v)) for v in row)


def difference(spark_df, relation) -> str | None:
    """None if schema and rows agree, else what differs first."""
    got_types = dict(spark_df.dtypes)
    want_types = {n: _FAMILY.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)}
    if got_types != want_types:
        wrong = {n: (got_types.get(n), want_types.get(n))
                 for n in got_types.keys() | want_types.keys()
                 if got_types.get(n) != want_types.get(n)}
        return f"schema (spark, oracle): {wrong}"
    names = sorted(got_types)
    got = sorted((tuple(r[n] for n in names) for r in spark_df.collect()), key=_key)
    want = sorted(relation.select(*names).fetchall(), key=_key)
    if len(got) != len(want):
        return f"rows: spark {len(got)}, oracle {len(want)}"
    for g, w in zip(got, want):
        if _key(g) != _key(w):
            return "first differing row: " + str({n: (a, b) for n, a, b in zip(names, g, w) if str(a) != str(b)})
    return None


def plan_text(df) -> str:
    """The physical plan as ``explain("formatted")`` prints it."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def sorted_rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=_key)
