"""Mixing sources to target weights: hash-random order, prefix sums, exact budgets.

The documents of a source are ordered by a hash. Words before a document in that order are
counted by distributed prefix sums: over 256 ranges of the hash, over 256 ranges in each of
those, and row by row only within one of these 65,536 ranges, so a source of any size is
spread over all tasks. A source's budget buys whole passes (epochs) over the source, and in
the last pass the documents up to the budget; the one on the edge is cut to the exact word.

Defined results: NULL text has size 0; NULL source is a source of its own, sorted last;
repeated rows are documents of their own; an empty table gives an empty result; a source
without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
MOST_EPOCHS = 3


def _size() -> Column:
    return F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")


def targets(totals: DataFrame) -> DataFrame:
    """Adds ``target`` to (source_key, source_size): one row a source, so one task is enough.

    Weights 1, 2, 3 repeat over the sources in code point order. The common level rises until
    all sizes are shared out; sources full at three times their size stop rising before.
    """
    cap, weight = F.col("cap"), F.col("weight")
    ranked = totals.withColumn(
        "weight", (F.row_number().over(Window.orderBy("source_key")) - 1) % 3 + 1
    ).withColumn("cap", F.col("source_size") * MOST_EPOCHS)
    everything = Window.partitionBy()
    rising = Window.orderBy(cap / weight, "source_key")
    before, onward = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(
        0, Window.unboundedFollowing
    )
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    ) / F.sum(weight).over(onward)
    levels = ranked.withColumn("level", level.cast("double"))
    full = cap / weight <= F.col("level")
    return (
        levels.withColumn("common", F.max(F.when(~full, F.col("level"))).over(everything))
        .withColumn("target", F.when(full, cap.cast("double")).otherwise(weight * F.col("common")))
        .select("source_key", "source_size", "target")
    )


def mix(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target, taken: a row for each row of ``docs``."""
    order = F.md5(
        F.concat(
            F.lit(f"{seed}:"),
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            F.lit(":"),
            F.md5(text_or_empty()),
        )
    )
    sized = settle(
        docs.select(
            "doc_id",
            "source",
            F.when(F.col("source").isNull(), "1")
            .otherwise(F.concat(F.lit("0"), F.col("source")))
            .alias("source_key"),
            _size().alias("size"),
            order.alias("order_key"),
        )
    ).withColumns(
        {"outer": F.substring("order_key", 1, 2), "inner": F.substring("order_key", 3, 2)}
    )
    inner = sized.groupBy("source_key", "outer", "inner").agg(F.sum("size").alias("words"))
    outer = inner.groupBy("source_key", "outer").agg(F.sum("words").alias("words"))
    goals = targets(outer.groupBy("source_key").agg(F.sum("words").alias("source_size")))

    def earlier(window: Window) -> Column:
        return F.coalesce(
            F.sum("words").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )

    outer = outer.withColumn(
        "before_outer", earlier(Window.partitionBy("source_key").orderBy("outer"))
    ).drop("words")
    inner = (
        inner.withColumn(
            "before_inner", earlier(Window.partitionBy("source_key", "outer").orderBy("inner"))
        )
        .drop("words")
        .join(outer.join(goals, "source_key"), ["source_key", "outer"])
    )
    within = Window.partitionBy("source_key", "outer", "inner").orderBy("order_key", "doc_id")
    words_before = F.col("before_outer") + F.col("before_inner") + F.col("within")
    epochs = F.coalesce(
        F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)
    ).cast("long")
    rest = F.floor("target") - epochs * F.col("source_size")
    return (
        sized.withColumn(
            "within",
            F.coalesce(
                F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .join(inner, ["source_key", "outer", "inner"])
        .withColumn("last_pass", F.greatest(F.lit(0), rest - words_before))
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (epochs * F.col("size") + F.least("size", "last_pass")).cast("long").alias("taken"),
        )
    )
