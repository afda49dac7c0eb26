"""Dimensions: one row per key.

A key does not determine all attributes (a road key covers many coordinates), so
one source row must be picked per key. The pick is the earliest event and, among
events of the same instant, the smallest attributes in their order, NULLs first.
An event without a time comes after all that have one.
Being a minimum, it does not depend on row order, partitioning or retries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstone import rules
from kerbstone.functions import keys

_EARLIEST = "event_time_ts"


def build_dimension(silver: DataFrame, name: str, more: tuple[str, ...] = ()) -> DataFrame:
    """Keyed pick as a partial minimum, one exchange, final minimum.

    ``more``: silver columns that are attributes behind the contract's. Every task sends at most one row per key it saw, so a key that holds a third of
    all rows (such as the NULL incident key) costs the exchange no more than others.
    """
    key, attributes = rules.DIMENSIONS[name].key, (*rules.DIMENSIONS[name].attributes, *more)
    ranked = (f"{_EARLIEST} is null", _EARLIEST, *(a for a in attributes if a != _EARLIEST))
    picked = silver.groupBy(F.expr(keys.key_text(key)).alias("key_text")).agg(
        F.expr(f"min(struct({', '.join(ranked)}))").alias("row")
    )
    return picked.selectExpr(
        f"{keys.digest(key, 'key_text')} as {key}", *(f"row.{a}" for a in attributes)
    )
