"""Facts: projections of silver that compute their dimension keys themselves.

Because keys are digests of the row's own values, no dimension is looked up: facts
are map-only however large the dimensions grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from kerbstone import rules
from kerbstone.functions import keys

# Facts about a part of the rows only; the others hold every silver row.
_ROWS = {"fact_incident": f"incident_type is not null and incident_type <> '{rules.NO_INCIDENT}'"}


def _column(name: str) -> str:
    if keys.is_key(name):
        return f"{keys.key(name)} as {name}"
    if name in rules.FACT_FLAGS:
        return f"cast({name} as int) as {name}"
    return name


def build_fact(silver: DataFrame, name: str) -> DataFrame:
    rows = silver.filter(_ROWS[name]) if name in _ROWS else silver
    return rows.selectExpr(*(_column(c) for c in rules.FACTS[name]))
