"""Streaming sources. Each returns a lazy streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbstone import rules

MESSAGE_SCHEMA = "value BINARY, timestamp TIMESTAMP"
# What one micro-batch takes of a backlog at most, unless an option sets another bound.
KAFKA_BOUND = {"maxOffsetsPerTrigger": "50000000"}
FILE_BOUND = {"maxBytesPerTrigger": str(64 << 30)}
_BOUNDING = {"maxoffsetspertrigger", "maxbytespertrigger", "maxfilespertrigger"}
BRONZE_SCHEMA = f"raw_json STRING, kafka_timestamp TIMESTAMP, {rules.EVENT_SCHEMA}"


def _bounded(options: dict[str, str], bound: dict[str, str]) -> dict[str, str]:
    return options if any(o.lower() in _BOUNDING for o in options) else bound | options


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str = "traffic-topic",
    starting_offsets: str = "latest",
    **options: str,
) -> DataFrame:
    """Messages of one topic, by default only those that arrive from now on.

    ``options`` go to the connector, e.g. ``maxOffsetsPerTrigger`` to bound a
    micro-batch or ``minPartitions`` to read with more tasks than the topic has partitions.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**_bounded(options, KAFKA_BOUND))
        .load()
    )


def file_messages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same two columns from Parquet files dropped into a folder."""
    return spark.readStream.schema(MESSAGE_SCHEMA).options(**_bounded(options, FILE_BOUND)).parquet(path)


def bronze_rows(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """The bronze table as a stream: the rows it holds, then those appended later.

    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bounds a micro-batch, which
    matters when a long backlog is read for the first time.
    """
    reader = spark.readStream.format(fmt).options(**_bounded(options, FILE_BOUND))
    if fmt != "delta":  # a Delta table brings its own schema
        reader = reader.schema(BRONZE_SCHEMA)
    return reader.load(path)
