"""Standardising, clipping and validating single columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _literal(value: str | int | float) -> str:
    return f"'{value}'" if isinstance(value, str) else f"{value}D" if isinstance(value, float) else str(value)


def standardise(name: str) -> Column:
    """Upper case without surrounding blanks (blanks only: tabs stay)."""
    return F.expr(f"upper(trim({name}))")


def clip(name: str, low: float, high: float) -> Column:
    """Move values outside [low, high] to the nearest limit.

    NULL fails both comparisons and stays NULL. NaN sorts above every number in
    Spark, so it moves to ``high``. ``least``/``greatest`` would not do: they skip NULL.
    """
    low_sql, high_sql = _literal(low), _literal(high)
    return F.expr(
        f"case when {name} < {low_sql} then {low_sql} "
        f"when {name} > {high_sql} then {high_sql} else {name} end"
    )


def keep_allowed(name: str, allowed: Sequence) -> Column:
    """The value if it is a member of ``allowed``, else NULL."""
    return F.expr(f"if({name} in ({', '.join(map(_literal, allowed))}), {name}, null)")
