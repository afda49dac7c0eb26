"""Raw messages to bronze rows. Map-only: no shuffle in any step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstone import rules


def decode(messages: DataFrame) -> DataFrame:
    """Broker records (``value`` bytes, ``timestamp``) to text and arrival time."""
    return messages.select(
        F.col("value").cast("string").alias("raw_json"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def parse(decoded: DataFrame) -> DataFrame:
    """Add the event as a struct ``data``.

    Text that is not a JSON object gives a struct of NULLs rather than an error; the
    row keeps its text and is quarantined later. Unknown fields are ignored.
    """
    return decoded.withColumn("data", F.from_json("raw_json", rules.EVENT_SCHEMA))


def flatten(parsed: DataFrame) -> DataFrame:
    """One column per event field, next to the untouched text and arrival time."""
    return parsed.select("raw_json", "kafka_timestamp", "data.*")


def to_bronze(messages: DataFrame) -> DataFrame:
    return messages.transform(decode).transform(parse).transform(flatten)
