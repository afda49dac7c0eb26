"""Derived measures and categories over cleaned columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbstone import rules


def speed_band(speed: Column) -> Column:
    top = next(band for band, bound in rules.SPEED_BANDS.items() if bound is None)
    banded = F.when(speed.isNull(), rules.UNKNOWN)
    for band, bound in rules.SPEED_BANDS.items():
        if bound is not None:
            banded = banded.when(speed < bound, band)
    return banded.otherwise(top)


def speed_excess(speed: Column, limit: Column) -> Column:
    """How far the speed is above the limit, 0 if below, NULL if either is unknown."""
    over = speed - limit
    return F.when(over.isNotNull(), F.round(F.greatest(over, F.lit(0.0)), 2))


def safety_score(flags: dict[str, Column]) -> Column:
    """Start value less the penalty of every raised flag; an unknown flag costs nothing.

    Start and penalties are whole numbers, so the score needs no rounding.
    """
    penalties = (
        F.when(flags[name], F.lit(penalty)).otherwise(F.lit(0.0))
        for name, penalty in rules.SAFETY_PENALTIES.items()
    )
    return reduce(lambda score, penalty: score - penalty, penalties, F.lit(rules.SAFETY_START))


def weather_severity(weather: Column) -> Column:
    levels = (F.when(weather.isin(*kinds), level) for level, kinds in rules.WEATHER_SEVERITY.items())
    return F.coalesce(*levels, F.lit(rules.UNKNOWN))


def time_parts(at: Column) -> dict[str, Column]:
    """Calendar parts in the session time zone; Sunday is day 1 of the week."""
    hour = F.hour(at)
    return {
        "event_year": F.year(at),
        "event_month": F.month(at),
        "event_day": F.dayofmonth(at),
        "event_hour_clean": hour,
        "event_dow": F.dayofweek(at),
        "is_peak_hour": hour.isin(*rules.PEAK_HOURS),
    }
