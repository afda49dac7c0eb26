"""Messages to the bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kerbstone.operators.bronze import to_bronze
from kerbstone.sinks.lakehouse import Lakehouse
from kerbstone.streaming.triggers import ASAP

JOB = "traffic_bronze"


def start_bronze(messages: DataFrame, tables: Lakehouse, trigger: dict = ASAP) -> StreamingQuery:
    """Append every message to bronze, by default as soon as the last batch is done.

    Map-only, one task per source partition. Exactly-once: the table's log and the
    checkpoint agree on which batches are in.
    """
    writer = (
        to_bronze(messages)
        .writeStream.format(tables.fmt)
        .outputMode("append")
        .queryName(JOB)
        .option("checkpointLocation", tables.checkpoint(JOB))
        .option("path", tables.bronze)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
