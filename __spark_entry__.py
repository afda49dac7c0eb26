"""

Traffic columns are derived from the ``events`` table by ``event_feed``.
Rule and table queries run on the bronze rows of those events; ``bronze_*`` go through
the JSON text, and ``stream_*`` run the real jobs over files and read back the tables.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from kerbstone import rules
from kerbstone.functions import keys
from kerbstone.operators import bronze as bronze_ops
from kerbstone.operators.dimensions import build_dimension
from kerbstone.operators.facts import build_fact
from kerbstone.operators.routing import quarantine_rows, valid_rows
from kerbstone.operators.silver import enriched, to_silver, typed, validated
from kerbstone.sinks.catalog import register_tables
from kerbstone.sinks.lakehouse import BATCH, BatchId, Lakehouse
from kerbstone.session import use_jit_sized_methods
from kerbstone.sources import streams
from event_feed import bronze_rows, sensor_messages
from kerbstone.streaming.bronze_job import start_bronze
from kerbstone.streaming.progress import BatchLog
from kerbstone.streaming.silver_gold_job import GOLD, JOB, MoreColumns, SilverGoldJob
from kerbstone.streaming.triggers import BACKLOG_THEN_STOP
import oracle_queries

FLAGSHIP_DATA = "/root/testdata/sf0.001"
Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Raw messages to the traffic fact: parse, route, cast, clean, enrich, key."""
    return queries()["fact_traffic_event"](spark, FLAGSHIP_DATA)


# --- inputs -------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_messages(_events(spark, sf_dir))


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(_events(spark, sf_dir))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_rows(_bronze(spark, sf_dir))


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(_valid(spark, sf_dir))


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(_typed(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(_validated(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(_valid(spark, sf_dir))


# --- whole jobs ---------------------------------------------------------------------


def _scratch(spark: SparkSession) -> str:
    """A new folder in the shared place the cluster names; a local one only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared}/kerbstone-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="kerbstone-")


# Streams get their input in two deals, one after the other, by a column of the events: rows that
# are there when a stream starts, and rows that are appended between two runs on one checkpoint.
DEALS = 2


def _deal(spark: SparkSession, sf_dir: str, deal: int) -> DataFrame:
    return _events(spark, sf_dir).where(F.col("event_id") % DEALS == deal)


def _stream_bronze(spark: SparkSession, sf_dir: str) -> Iterator[Lakehouse]:
    """Land the messages as files and stream them into bronze, deal by deal."""
    base = _scratch(spark)
    landing, tables = f"{base}/landing", Lakehouse(f"{base}/lake")
    for deal in range(DEALS):
        sensor_messages(_deal(spark, sf_dir, deal)).write.mode("append").parquet(landing)
        start_bronze(streams.file_messages(spark, landing), tables, BACKLOG_THEN_STOP).awaitTermination()
        yield tables


def _append_bronze(spark: SparkSession, sf_dir: str) -> Iterator[Lakehouse]:
    """A bronze table that grows by plain appends, deal by deal."""
    tables = Lakehouse(f"{_scratch(spark)}/lake")
    for deal in range(DEALS):
        bronze_rows(_deal(spark, sf_dir, deal)).write.mode("append").parquet(tables.bronze)
        yield tables


def _run(spark: SparkSession, tables: Lakehouse, **settings) -> None:
    """Work off what bronze holds by now and stop."""
    job = SilverGoldJob(spark, tables, **settings)
    job.start(streams.bronze_rows(spark, tables.bronze), BACKLOG_THEN_STOP).awaitTermination()


def _stream_all(spark: SparkSession, sf_dir: str, **settings) -> Lakehouse:
    """Both jobs, bronze and silver-gold, by turns."""
    for tables in _stream_bronze(spark, sf_dir):
        _run(spark, tables, **settings)
    return tables


def _stream_refined(spark: SparkSession, sf_dir: str, **settings) -> Lakehouse:
    """The silver-gold job alone over a growing bronze table."""
    for tables in _append_bronze(spark, sf_dir):
        _run(spark, tables, **settings)
    return tables


def _streamed(table: Callable[[Lakehouse], str], *gold: str, drop: str = "") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = _stream_refined(spark, sf_dir, gold=gold)
        return tables.read(spark, table(tables)).drop(drop)

    return query


def _whole_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _stream_all(spark, sf_dir)
    return tables.read(spark, tables.gold("fact_traffic_event"))


def _bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    *_, tables = _stream_bronze(spark, sf_dir)
    return spark.read.schema(streams.BRONZE_SCHEMA).parquet(tables.bronze)


def _appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which batch brought a silver row: the rows that were there first, then the appended ones."""
    tables = _stream_refined(spark, sf_dir, gold=())
    return tables.read(spark, tables.silver, with_batch=True).select("event_id", F.col(BATCH).alias("batch"))


def _dimension_rows(spark: SparkSession, tables: Lakehouse) -> DataFrame:
    """All stored dimension rows, with all attributes and the number of their batch."""
    whole: DataFrame | None = None
    for name, dimension in rules.DIMENSIONS.items():
        rows = tables.read(spark, tables.gold(name), with_batch=True).select(
            F.lit(name).alias("table_name"), F.col(BATCH).alias("batch"), F.col(dimension.key).alias("key"), *dimension.attributes
        )
        whole = whole.unionByName(rows, allowMissingColumns=True) if whole else rows
    return whole


def _dimension_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which keys each dimension table holds, once per stored row, when each is stored once."""
    tables = _stream_refined(spark, sf_dir, gold=tuple(rules.DIMENSIONS), only_new_dimension_rows=True)
    return _dimension_rows(spark, tables).select("table_name", "key")


def _streamed_dimensions(only_new: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _dimension_rows(
            spark, _stream_refined(spark, sf_dir, gold=tuple(rules.DIMENSIONS), only_new_dimension_rows=only_new)
        )

    return query


# Columns that the second deal's job brings to tables that evolve.
_DAY_PART = "case when event_hour_clean between 6 and 21 then 'DAY' else 'NIGHT' end"
_MORE = MoreColumns(
    silver={"day_part": _DAY_PART},
    quarantine={"payload_chars": "length(raw_json)"},
    dimensions={"dim_time": ("day_part",)},
)


def _evolving(spark: SparkSession, sf_dir: str, before_second: Callable[[Lakehouse], None] | None = None) -> Lakehouse:
    """A stream that is stopped, and started again by a job with more columns."""
    for deal, tables in enumerate(_append_bronze(spark, sf_dir)):
        if deal and before_second:
            before_second(tables)
        _run(spark, tables, gold=("dim_time",), more=_MORE if deal else MoreColumns())
    return tables


def _evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all batches, read by path with the columns that the later ones brought."""
    tables = _evolving(spark, sf_dir)
    read = lambda path, key, column: tables.read(spark, path).select(
        F.lit(path.rsplit("/", 1)[1]).alias("table_name"), F.col(key).alias("key"), F.col(column).cast("string").alias("added")
    )
    return _union([
        read(tables.silver, "event_id", "day_part"),
        read(tables.quarantine, "raw_json", "payload_chars"),
        read(tables.gold("dim_time"), "time_key", "day_part"),
    ])


def _evolved_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table through the catalog: columns by name before and after registering again."""
    with _database(spark) as (database, location):
        seen: list[int] = []

        def register(tables: Lakehouse) -> None:
            register_tables(spark, tables, database, location, ("dim_time",))
            seen.append(len(spark.table(f"{database}.dim_time").columns))

        tables = _evolving(spark, sf_dir, before_second=register)
        spark.catalog.refreshTable(f"{database}.dim_time")
        seen.append(len(spark.table(f"{database}.dim_time").columns))
        register(tables)
        rows = spark.sql(f"SELECT time_key, event_hour_clean, day_part FROM {database}.dim_time")
    first, without_registering, again = seen
    return rows.select(
        "*", F.lit(without_registering - first).alias("new_before"), F.lit(again - first).alias("new_after")
    )


STOP_AFTER = 5  # tables of a batch


def _restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eleven tables' rows after a stream that was stopped in the middle of each batch."""
    stopped: dict[int, int] = {}

    def stop(table: str, batch: BatchId) -> None:
        stopped[batch.number] = stopped.get(batch.number, 0) + 1
        if stopped[batch.number] == STOP_AFTER:
            raise RuntimeError(f"stopped after {table}")

    for tables in _append_bronze(spark, sf_dir):
        try:
            _run(spark, tables, on_written=stop)
        except StreamingQueryException as e:
            if "stopped after" not in str(e):
                raise
        else:
            raise AssertionError("the stream was not stopped")
        _run(spark, tables)
    ids = {"traffic_silver": (tables.silver, "event_id"), "traffic_quarantine": (tables.quarantine, "raw_json")}
    ids |= {name: (tables.gold(name), d.key) for name, d in rules.DIMENSIONS.items()}
    ids |= {name: (tables.gold(name), "event_id") for name in rules.FACTS}
    return _union([
        tables.read(spark, path).groupBy(F.lit(name).alias("table_name"), F.col(key).alias("key")).agg(F.count("*").alias("n"))
        for name, (path, key) in ids.items()
    ])


def _batch_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an empty batch, one without and one with faulty rows counted and wrote, from the job's log."""
    tables = Lakehouse(f"{_scratch(spark)}/lake")
    batch_log = BatchLog(spark, tables, JOB)
    first, second = (bronze_rows(_deal(spark, sf_dir, deal)) for deal in range(DEALS))
    for rows in (first.limit(0), valid_rows(first), second):
        rows.write.mode("append").parquet(tables.bronze)
        _run(spark, tables, on_batch=batch_log.add)
    return batch_log.rows().select(
        F.col("batch").cast("int").alias("batch"), "rows", "quarantined", F.explode_outer("tables").alias("table_name")
    )


def _processing_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a batch's rows carry one time, whatever table they went to, from within its run."""
    runs: list[tuple[int, datetime, datetime]] = []
    for deal, tables in enumerate(_append_bronze(spark, sf_dir)):
        start = datetime.now(timezone.utc)
        _run(spark, tables, gold=())
        runs.append((deal, start, datetime.now(timezone.utc)))
    times = _union([
        tables.read(spark, path, with_batch=True).select(F.col(BATCH).alias("batch"), F.col(column).alias("at"))
        for path, column in ((tables.silver, "silver_processed_at"), (tables.quarantine, "quarantined_at"))
    ])
    ran = spark.createDataFrame(runs, "batch int, started timestamp, ended timestamp")
    each = times.groupBy("batch").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n"))
    return each.join(ran, "batch").select(
        "batch", "n", (F.col("first") == F.col("last")).alias("one_time"),
        ((F.col("started") <= F.col("first")) & (F.col("last") <= F.col("ended"))).alias("in_run"),
    )


@contextmanager
def _database(spark: SparkSession) -> Iterator[tuple[str, str]]:
    """Name and place of a database that is dropped afterwards; plans over its tables stay valid."""
    before, database = spark.catalog.currentDatabase(), f"traffic_{uuid.uuid4().hex}"
    try:
        yield database, f"{_scratch(spark)}/db"
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def _registered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the nine gold tables, read by name through the catalog."""
    tables = Lakehouse(f"{_scratch(spark)}/lake")
    # Settled once, as in the streaming job: gold reads the silver files.
    batch = BatchId("whole", 0)
    silver = _silver(spark, sf_dir)
    tables.write_batch(silver, tables.silver, batch)
    SilverGoldJob(spark, tables).write_gold(
        tables.read_batch(spark, tables.silver, batch, silver.schema), batch
    )
    with _database(spark) as (database, location):
        names = register_tables(spark, tables, database, location)
        return _union(
            [
                spark.table(f"{database}.{name}").agg(
                    F.lit(name).alias("table_name"), F.count("*").alias("n")
                )
                for name in names
            ]
        )


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


# --- queries ------------------------------------------------------------------------


def _parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = bronze_ops.parse(bronze_ops.decode(_messages(spark, sf_dir)))
    return parsed.select("raw_json", F.to_json("data").alias("parsed_json"))


def _select(rows: Query, *columns: str | Column) -> Query:
    return lambda spark, sf_dir: rows(spark, sf_dir).select(*columns)


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine_rows(_bronze(spark, sf_dir))


def _dimension(name: str) -> Query:
    return lambda spark, sf_dir: build_dimension(_silver(spark, sf_dir), name)


def _fact(name: str) -> Query:
    return lambda spark, sf_dir: build_fact(_silver(spark, sf_dir), name)


def _comparable(query: Query) -> Query:
    """Pin the time zone that results depend on, and show timestamps as UTC wall-clock times.

    The session runs with methods the JVM compiles from then on: rows are made when they are read.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_jit_sized_methods(spark)
        zone = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        try:
            rows = query(spark, sf_dir)
            zoned = [f.name for f in rows.schema.fields if isinstance(f.dataType, TimestampType)]
            return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})
        finally:  # a plan keeps the zone it was made with
            spark.conf.set("spark.sql.session.timeZone", zone)

    return run


def queries() -> dict[str, Query]:
    all_queries: dict[str, Query] = {
        "bronze_decode": lambda s, d: bronze_ops.decode(_messages(s, d)),
        "bronze_parse": _parse,
        "bronze_flatten": lambda s, d: bronze_ops.to_bronze(_messages(s, d)),
        "valid_rows": _valid,
        "quarantine_rows": lambda s, d: _quarantine(s, d).drop(
            "quarantine_reason", "quarantined_at"
        ),
        "quarantine_reason": _select(_quarantine, "raw_json", "quarantine_reason"),
        "silver_cast_ts": _select(_typed, "event_id", *rules.TIMESTAMPS),
        "silver_cast_double": _select(_typed, "event_id", *rules.DOUBLES),
        "silver_cast_int": _select(_typed, "event_id", *rules.INTEGERS),
        "silver_cast_bool": _select(_typed, "event_id", *rules.BOOLEANS),
        "silver_standardise": _select(_typed, "event_id", *rules.STANDARD_TEXT),
        "silver_clip": _select(_validated, "event_id", *rules.LIMITS),
        "silver_allow_list": _select(_validated, "event_id", *rules.ALLOWED),
        "silver_speed_band": _select(_enriched, "event_id", "speed_kmh", "speed_band"),
        "silver_speed_excess": _select(
            _enriched, "event_id", "speed_kmh", "speed_limit", "speed_excess_kmh"
        ),
        "silver_safety_score": _select(
            _enriched, "event_id", *rules.SAFETY_PENALTIES, "safety_score_clean"
        ),
        "silver_time_parts": _select(
            _enriched, "event_id", "event_year", "event_month", "event_day",
            "event_hour_clean", "event_dow", "is_peak_hour",
        ),
        "silver_weather_severity": _select(_enriched, "event_id", "weather", "weather_severity"),
        "silver_full": lambda s, d: _silver(s, d).drop("silver_processed_at"),
        "surrogate_keys": lambda s, d: _silver(s, d).selectExpr(
            "event_id",
            *(f"{keys.key(k)} as {k}" for k in (*rules.SURROGATE_KEYS, *rules.NATURAL_KEYS)),
        ),
        **{name: _dimension(name) for name in rules.DIMENSIONS},
        **{name: _fact(name) for name in rules.FACTS},
        "register_tables": _registered_counts,
        "stream_bronze": _bronze_table,
        "stream_quarantine": lambda s, d: _streamed(lambda t: t.quarantine)(s, d).select(
            "raw_json", "kafka_timestamp", "quarantine_reason"
        ),
        "stream_silver": _streamed(lambda t: t.silver, drop="silver_processed_at"),
        "stream_silver_gold": _whole_stream,
        "stream_fact_incident": _streamed(lambda t: t.gold("fact_incident"), "fact_incident"),
        "stream_dimensions": _dimension_keys,
        "stream_dimension_rows": _streamed_dimensions(only_new=False),
        "stream_new_dimension_rows": _streamed_dimensions(only_new=True),
        "stream_appended": _appended,
        "stream_evolved": _evolved,
        "register_evolved": _evolved_by_name,
        "stream_restarted": _restarted,
        "stream_batch_reports": _batch_reports,
        "stream_processing_times": _processing_times,
    }
    return {name: _comparable(q) for name, q in all_queries.items()} | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return oracle_queries.oracle_sql() | _training_data()[1]


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data operators; none where that subpackage can't be imported."""
    try:
        import corpus_pipeline
        from kerbstone.llm import queries as llm
    except ImportError:
        return {}, {}
    pipeline_sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return llm.QUERIES | {"pipeline": corpus_pipeline.run}, llm.ORACLE_SQL | pipeline_sql
