"""Text columns to typed ones; text that does not fit becomes NULL in every ANSI mode.

With ANSI mode on (the default since Spark 4) a plain cast fails the job on the
first dirty row, so every conversion here uses a ``try_`` form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a cast strips from both ends of a text: blanks and ASCII control characters.
_PAD = r"[\x00-\x20\x7f]*"
_FRACTION_ONLY = rf"^{_PAD}[+-]?[.][0-9]*{_PAD}$"
_WITH_FRACTION = rf"^{_PAD}([+-]?[0-9]+)[.][0-9]*{_PAD}$"


def to_timestamp(name: str) -> Column:
    return F.expr(f"try_to_timestamp({name})")


def to_double(name: str) -> Column:
    return F.expr(f"try_cast({name} as double)")


def to_boolean(name: str) -> Column:
    return F.expr(f"try_cast({name} as boolean)")


def to_int(name: str) -> Column:
    """Cast that cuts off a decimal fraction: ``'12.5'`` is 12 and ``'.5'`` is 0.

    ``try_cast`` alone gives NULL for both. Whole numbers, by far the most common
    case, never reach the regular expressions.
    """
    return F.expr(
        f"""coalesce(
            try_cast({name} as int),
            case when not contains({name}, '.') then null
                 when {name} rlike r'{_FRACTION_ONLY}' then 0
                 else try_cast(regexp_replace({name}, r'{_WITH_FRACTION}', '$1') as int)
            end)"""
    )
