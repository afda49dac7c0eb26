"""Bronze table to silver, quarantine and the nine gold tables, batch by batch."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone
from threading import Event

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbstone import rules
from kerbstone.operators.new_keys import only_new_keys
from kerbstone.operators.routing import is_faulty, quarantine_rows, valid_rows
from kerbstone.operators.silver import to_silver
from kerbstone.plans.layers import dimensions, facts
from kerbstone.session import jit_sized_methods
from kerbstone.sinks.lakehouse import BUCKET, BatchId, Lakehouse, key_bucket
from kerbstone.streaming.progress import BatchReport
from kerbstone.streaming.triggers import EVERY_30_SECONDS

JOB = "traffic_silver_gold"
GOLD = (*rules.DIMENSIONS, *rules.FACTS)
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class MoreColumns:
    """Columns beyond the contract's, for the tables that may gain columns.

    ``silver`` and ``quarantine`` name SQL over the columns at hand; ``dimensions`` names the
    silver columns that a dimension also holds. Tables that exist get the columns with the
    first batch that has them; rows of earlier batches hold NULL there.
    """

    silver: dict[str, str] = field(default_factory=dict)
    quarantine: dict[str, str] = field(default_factory=dict)
    dimensions: dict[str, tuple[str, ...]] = field(default_factory=dict)


@dataclass(frozen=True)
class SilverGoldJob:
    """Settings of the job, and the work for one micro-batch.

    ``only_new_dimension_rows``: dimensions are unique per batch, so by default a key
    seen in several batches is stored several times. Set it to store each key once;
    readers can then join facts to dimensions without fan-out. Such tables are laid out by
    the key's hash, and a batch reads only the buckets of its own keys. A table keeps the
    layout it was begun with: one begun without buckets is read whole.

    ``gold``: the gold tables this job writes; several jobs can share the work.

    ``parallel_writes``: gold tables written at the same time. They depend on the silver
    batch only, and most are too small to keep a cluster busy one by one.

    ``on_written``: called with a table's name and the batch after each table written; what it
    raises fails the batch, which is replayed when the stream is started again.

    ``on_batch``: called with the batch's report when it is done.
    """

    spark: SparkSession
    tables: Lakehouse
    only_new_dimension_rows: bool = False
    parallel_writes: int = 4
    gold: tuple[str, ...] = GOLD
    more: MoreColumns = MoreColumns()
    on_written: Callable[[str, BatchId], None] | None = None
    on_batch: Callable[[BatchReport], None] | None = None

    def start(self, bronze: DataFrame, trigger: dict = EVERY_30_SECONDS) -> StreamingQuery:
        writer = (
            bronze.writeStream.foreachBatch(self._on_batch)
            .queryName(JOB)
            .option("checkpointLocation", self.tables.checkpoint(JOB))
        )
        query = (writer.trigger(**trigger) if trigger else writer).start()
        log.info("%s started, listening to bronze", JOB)
        return query

    def _on_batch(self, bronze: DataFrame, number: int) -> None:
        # Spark sets this property on the thread that runs a batch; the id survives restarts.
        stream = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:  # without it a fresh checkpoint would overwrite an earlier stream's batches
            raise RuntimeError("the streaming query's id is not set on this thread")
        self.process(bronze, BatchId(stream, number))

    def process(self, bronze: DataFrame, batch: BatchId) -> BatchReport:
        """Write one bronze batch to all tables it concerns. Safe to repeat."""
        # One time for the whole batch, whatever table a row goes to and when it is written.
        now = datetime.now(timezone.utc)
        written: list[str] = []
        if bronze.isEmpty():
            log.info("batch %s: empty, skipped", batch.number)
            return self._report(batch, 0, 0, now, written)
        log.info("batch %s: silver", batch.number)
        counted, counts = self._counted(bronze)
        with self._stored(to_silver(valid_rows(counted), F.lit(now), self.more.silver), batch) as stored:
            self._done("traffic_silver", batch, written)
            rows, quarantined = counts()
            if quarantined:
                faulty = quarantine_rows(bronze, F.lit(now), self.more.quarantine)
                self.tables.write_batch(faulty, self.tables.quarantine, batch, evolve=True)
                self._done("traffic_quarantine", batch, written)
            log.info("batch %s: gold", batch.number)
            self.write_gold(stored, batch, written)
        log.info("batch %s: done, %s rows, %s quarantined", batch.number, rows, quarantined)
        return self._report(batch, rows, quarantined, now, written)

    def _done(self, table: str, batch: BatchId, written: list[str]) -> None:
        written.append(table)
        if self.on_written:
            self.on_written(table, batch)

    def _report(self, batch: BatchId, rows: int, quarantined: int, now: datetime, written: list[str]) -> BatchReport:
        report = BatchReport(batch.stream, batch.number, rows, quarantined, now, tuple(written))
        if self.on_batch:
            self.on_batch(report)
        return report

    def _counted(self, bronze: DataFrame) -> tuple[DataFrame, Callable[[], tuple[int, int]]]:
        """The batch, and a way to get its number of rows and of faulty rows once it is read.

        Counted on the way while silver is written, which spares a probe of the quarantine.
        A Delta append that was done before is skipped without reading the batch, so there
        the counts take a pass of their own over the few columns they need.
        """
        metrics = (F.count("*").alias("rows"), F.count_if(is_faulty()).alias("quarantined"))
        if self.tables.is_delta:
            return bronze, lambda: tuple(bronze.agg(*metrics).first())
        observation = Observation()
        observed = bronze.observe(observation, *metrics)
        return observed, lambda: (observation.get["rows"], observation.get["quarantined"])

    @contextmanager
    def _stored(self, silver: DataFrame, batch: BatchId) -> Iterator[DataFrame]:
        """Write the silver batch and give gold a way to read it nine times.

        Gold reads the files just written: only the columns each table needs, no silver
        logic again, nothing lost with an executor and no cache to overflow. A Delta
        table does not tell its batches apart, so there the batch is also staged.
        """
        tables = self.tables
        if tables.is_delta:
            silver = self._staged(silver, "traffic_silver", batch)
        with jit_sized_methods(silver.sparkSession):
            tables.write_batch(silver, tables.silver, batch, evolve=True)
        yield silver if tables.is_delta else tables.read_batch(self.spark, tables.silver, batch, silver.schema)

    def _staged(self, rows: DataFrame, table: str, batch: BatchId) -> DataFrame:
        """``rows`` as files of the stream's staging folder, which the next batch overwrites."""
        path = self.tables.staging(table, batch.stream)
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def write_gold(self, silver: DataFrame, batch: BatchId, written: list[str] | None = None) -> None:
        """Write the job's gold tables from a stored silver batch."""
        written = [] if written is None else written
        # Dimensions may gain columns over time; facts have a fixed schema.
        writes = [(name, rows, True) for name, rows in dimensions(silver, self.more.dimensions).items()]
        writes += [(name, rows, False) for name, rows in facts(silver).items()]

        failed = Event()

        def write(name: str, rows: DataFrame, evolve: bool) -> None:
            path = self.tables.gold(name)
            if name in rules.DIMENSIONS:
                key = rules.DIMENSIONS[name].key
                if self.only_new_dimension_rows:
                    rows = self.new_rows(name, rows, batch)
                elif self.tables.is_by_key(self.spark, path, batch):
                    rows = rows.withColumn(BUCKET, key_bucket(key))
            self.tables.write_batch(rows, path, batch, evolve)
            self._done(name, batch, written)

        def attempt(*of: object) -> None:
            if failed.is_set():  # no table is begun once one has failed
                return
            try:
                write(*of)
            except BaseException:
                failed.set()
                raise

        with ThreadPoolExecutor(self.parallel_writes) as pool:
            # Each write gets its own copy of the streaming query's job properties, so
            # stopping the query cancels these jobs too.
            jobs = [
                pool.submit(inheritable_thread_target(self.spark)(attempt), *w) for w in writes if w[0] in self.gold
            ]
            for job in jobs:
                job.result()

    def new_rows(self, name: str, rows: DataFrame, batch: BatchId) -> DataFrame:
        """The batch's dimension rows whose keys are not stored yet, with their buckets.

        The rows are staged first: they are aggregated once, and their buckets, BUCKETS at most, are
        known when stored keys are read. A replay doesn't count what the failed attempt stored.
        """
        key = rules.DIMENSIONS[name].key
        staged = self._staged(rows.withColumn(BUCKET, key_bucket(key)), name, batch)
        stored = self.tables.read_without(self.spark, self.tables.gold(name), batch)
        if stored is None:
            return staged
        if BUCKET not in stored.columns:
            return only_new_keys(staged.drop(BUCKET), stored, key)
        mine = [r[0] for r in staged.select(BUCKET).distinct().collect()]
        return only_new_keys(staged, stored.where(F.col(BUCKET).isin(mine)), key)
