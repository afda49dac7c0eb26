"""Keep only dimension rows whose key a table does not hold yet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def only_new_keys(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """``rows`` without the keys found in ``stored``; a NULL key counts as a key.

    Two joins instead of one anti-join: an anti-join can only broadcast its right side,
    the table that grows for ever. The semi-join has the batch on its right, so stored
    keys are filtered where they are read if the planner estimates the batch to be small
    enough to broadcast, and what reaches the anti-join is bounded by the batch. Beyond that
    both run as shuffled joins. ``rows`` is read twice: give stored rows, not a plan that
    computes them, and of ``stored`` only the buckets that the batch has.
    """
    batch_keys = rows.select(rows[key].alias("batch_key"))
    stored_keys = stored.select(stored[key].alias("stored_key"))
    known = stored_keys.join(
        batch_keys, stored_keys.stored_key.eqNullSafe(batch_keys.batch_key), "left_semi"
    )
    return rows.join(known, rows[key].eqNullSafe(known.stored_key), "left_anti")
