"""Split bronze rows into valid and quarantined ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbstone import rules


def faults() -> dict[str, Column]:
    """Reason -> predicate, in order of precedence. No predicate is ever NULL."""
    missing = {f"NULL_{name.upper()}": F.col(name).isNull() for name in rules.MANDATORY}
    return {rules.CORRUPT_REASON: F.col(rules.CORRUPT_FIELD).isNotNull(), **missing}


def is_faulty() -> Column:
    return reduce(lambda a, b: a | b, faults().values())


def quarantine_reason() -> Column:
    """The first fault that applies; NULL for a valid row."""
    return F.coalesce(*(F.when(fault, reason) for reason, fault in faults().items()))


def valid_rows(bronze: DataFrame) -> DataFrame:
    """Rows with every mandatory field: plain null tests, so they reach the scan."""
    return bronze.filter(~is_faulty())


def quarantine_rows(bronze: DataFrame, at: Column | None = None, more: dict[str, str] | None = None) -> DataFrame:
    """The exact complement of :func:`valid_rows`, whole rows with reason and time.

    ``at`` and ``more`` as for silver.
    """
    rows = bronze.filter(is_faulty()).withColumns(
        {"quarantine_reason": quarantine_reason(), "quarantined_at": F.current_timestamp() if at is None else at}
    )
    return rows.withColumns({name: F.expr(sql) for name, sql in (more or {}).items()})
