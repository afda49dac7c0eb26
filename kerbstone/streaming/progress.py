"""What the micro-batches did, as rows."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kerbstone.sinks.lakehouse import Lakehouse, exists

REPORT_SCHEMA = (
    "stream STRING, batch BIGINT, rows BIGINT, quarantined BIGINT, processed_at TIMESTAMP, tables ARRAY<STRING>"
)


@dataclass(frozen=True)
class BatchReport:
    """One micro-batch: how many rows it had, when it ran and which tables it wrote, in order.

    An empty batch is skipped: it has no rows and writes no table.
    """

    stream: str
    batch: int
    rows: int
    quarantined: int
    processed_at: datetime
    tables: tuple[str, ...]


@dataclass(frozen=True)
class BatchLog:
    """Keeps the reports beside the tables; give :meth:`add` to a job as ``on_batch``.

    A batch's report replaces that of its failed attempt, so there is one for each batch.
    """

    spark: SparkSession
    tables: Lakehouse
    job: str

    def add(self, report: BatchReport) -> None:
        row = self.spark.createDataFrame([tuple(asdict(report).values())], REPORT_SCHEMA)
        row.coalesce(1).write.mode("overwrite").json(f"{self._path}/{report.stream}-{report.batch}")

    def rows(self) -> DataFrame:
        """A row for each batch so far."""
        if not exists(self.spark, self._path):
            return self.spark.createDataFrame([], REPORT_SCHEMA)
        return self.spark.read.schema(REPORT_SCHEMA).option("recursiveFileLookup", True).json(self._path)

    @property
    def _path(self) -> str:
        return f"{self.tables.base}/progress/{self.job}"


def batch_starts(query: StreamingQuery) -> dict[int, datetime]:
    """When the batches that had rows were triggered, as the query's own progress records say."""
    return {
        p.batchId: datetime.strptime(p.timestamp, "%Y-%m-%dT%H:%M:%S.%fZ").replace(tzinfo=timezone.utc)
        for p in query.recentProgress
        if p.numInputRows
    }
