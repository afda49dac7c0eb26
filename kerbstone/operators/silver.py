"""Valid bronze rows to silver rows, in three projections.

The order is part of the contract: text is standardised before it is validated,
measures are clipped before bands are read off them, and the speed limit is
validated before the excess is taken. Inside one projection all columns are
independent, so each stage is a single ``withColumns``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbstone import rules
from kerbstone.functions import casts, cleaning, enrichment


def typed_columns() -> dict[str, Column]:
    """Casts (NULL on failure) and standard text."""
    return {
        **{new: casts.to_timestamp(c) for new, c in rules.TIMESTAMPS.items()},
        **{c: casts.to_double(c) for c in rules.DOUBLES},
        **{c: casts.to_int(c) for c in rules.INTEGERS},
        **{c: casts.to_boolean(c) for c in rules.BOOLEANS},
        **{c: cleaning.standardise(c) for c in rules.STANDARD_TEXT},
    }


def validated_columns() -> dict[str, Column]:
    """Limits and allowed values."""
    return {
        **{c: cleaning.clip(c, low, high) for c, (low, high) in rules.LIMITS.items()},
        **{c: cleaning.keep_allowed(c, allowed) for c, allowed in rules.ALLOWED.items()},
    }


def derived_columns() -> dict[str, Column]:
    return {
        "speed_band": enrichment.speed_band(F.col("speed_kmh")),
        "speed_excess_kmh": enrichment.speed_excess(F.col("speed_kmh"), F.col("speed_limit")),
        "safety_score_clean": enrichment.safety_score(
            {name: F.col(name) for name in rules.SAFETY_PENALTIES}
        ),
        **enrichment.time_parts(F.col("event_time_ts")),
        "weather_severity": enrichment.weather_severity(F.col("weather")),
    }


def typed(valid: DataFrame) -> DataFrame:
    return valid.withColumns(typed_columns())


def validated(typed_rows: DataFrame) -> DataFrame:
    return typed_rows.withColumns(validated_columns())


def enriched(validated_rows: DataFrame) -> DataFrame:
    return validated_rows.withColumns(derived_columns())


def to_silver(valid: DataFrame, at: Column | None = None, more: dict[str, str] | None = None) -> DataFrame:
    """Silver rows, processed ``at`` that time, by default when they are read.

    ``more``: further columns behind the contract's, as SQL over bronze and silver columns.
    """
    rows = valid.transform(typed).transform(validated).transform(enriched)
    rows = rows.withColumn("silver_processed_at", F.current_timestamp() if at is None else at)
    return rows.select(*rules.SILVER_COLUMNS, *(F.expr(sql).alias(name) for name, sql in (more or {}).items()))
