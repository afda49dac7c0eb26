"""Tables under one base folder, and batch writes that survive a replay."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

STREAM = "stream_id"
BATCH = "batch_id"
# Dimensions that hold each key once are laid out by a hash of the key. The number of buckets is
# part of that layout: a table keeps the one it was begun with.
BUCKET = "key_bucket"
BUCKETS = 64


def key_bucket(key: str) -> Column:
    """The bucket of a key; NULL has one, too."""
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS).cast("long")).cast("int")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, on whatever file system.

    Asked for rather than tried: Spark reports a read of a missing path to every listener of
    the session, those of a running stream included.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


@dataclass(frozen=True)
class BatchId:
    """Identity of one micro-batch: the same when it is replayed, never reused.

    ``stream`` is the id Spark keeps in the checkpoint. A stream started on a fresh
    checkpoint counts its batches from 0 again, but under another stream id.
    """

    stream: str
    number: int


@dataclass(frozen=True)
class Lakehouse:
    """Table locations and how one micro-batch is written to them.

    A failed micro-batch is run again under the same id. Its second run must not add
    its rows twice, for any of the tables it had already reached:

    * ``parquet`` (or another file format): each batch owns one folder of a table and
      overwrites it, so a replay replaces what the first attempt left.
    * ``delta``: stream and batch go into the table's transaction log, which skips a
      batch it has seen.
    """

    base: str
    fmt: str = "parquet"
    # What this writer knows of a table after its first batch, so that later batches list nothing:
    # the columns recorded, and whether the table is laid out by key.
    _recorded: dict[str, dict[str, DataType]] = field(default_factory=dict, compare=False, repr=False)
    _by_key: dict[str, bool] = field(default_factory=dict, compare=False, repr=False)

    # Folder names of the published layout.
    @property
    def bronze(self) -> str:
        return f"{self.base}/traffic_bronze"

    @property
    def silver(self) -> str:
        return f"{self.base}/traffic_silver"

    @property
    def quarantine(self) -> str:
        return f"{self.base}/traffic_quarantine"

    def gold(self, table: str) -> str:
        return f"{self.base}/traffic_gold/{table}"

    def checkpoint(self, job: str) -> str:
        return f"{self.base}/chk/{job}"

    @property
    def is_delta(self) -> bool:
        return self.fmt == "delta"

    def staging(self, table: str, stream: str) -> str:
        """Where a stream puts a batch's rows of a table before it is known which of them are new."""
        return f"{self.base}/staging/{stream}/{table}"

    def write_batch(self, rows: DataFrame, path: str, batch: BatchId, evolve: bool = False) -> None:
        """Append one micro-batch; ``evolve`` lets new columns widen the table.

        Rows with the column ``BUCKET`` are laid out by it.
        """
        by_key = BUCKET in rows.columns
        if evolve and not self.is_delta:
            self._record_schema(rows.drop(BUCKET), path, batch)
        writer = rows.write.format(self.fmt)
        if self.is_delta:
            writer = writer.mode("append").option("txnAppId", batch.stream).option("txnVersion", batch.number)
            if evolve:
                writer = writer.option("mergeSchema", "true")
        else:
            path, writer = self._folder(path, batch), writer.mode("overwrite")
        (writer.partitionBy(BUCKET) if by_key else writer).save(path)

    def read_batch(
        self, spark: SparkSession, path: str, batch: BatchId, schema: StructType
    ) -> DataFrame:
        """One batch just written, from its own files (not for Delta tables)."""
        return spark.read.format(self.fmt).schema(schema).load(self._folder(path, batch))

    def read(self, spark: SparkSession, path: str, with_batch: bool = False) -> DataFrame:
        """A whole table, with every column one of its batches had.

        ``with_batch`` adds the stream and number of the batch that brought a row (not for Delta).
        """
        reader = spark.read.format(self.fmt)
        if self.is_delta:
            return reader.load(path).drop(BUCKET)
        schema = self.schema(spark, path)
        rows = (reader.schema(schema) if schema else reader).load(path).drop(BUCKET)
        return rows if with_batch else rows.drop(STREAM, BATCH)

    def schema(self, spark: SparkSession, path: str) -> StructType | None:
        """The columns of an evolving file table; None if none are recorded.

        Every batch that widened the table recorded its schema in a folder of its own, so
        readers need no footers and a replay records nothing twice.
        """
        if not exists(spark, self._schemas(path)):
            return None
        records = spark.read.option("recursiveFileLookup", True).text(self._schemas(path)).collect()
        schemas = [StructType.fromJson(json.loads(r.value)) for r in records]
        columns: dict[str, StructField] = {}
        for schema in sorted(schemas, key=lambda s: (len(s), s.json())):
            for column in schema:
                columns.setdefault(column.name, column)
        return StructType(list(columns.values())) if columns else None

    def _record_schema(self, rows: DataFrame, path: str, batch: BatchId) -> None:
        spark = rows.sparkSession
        if path not in self._recorded:
            self._recorded[path] = {f.name: f.dataType for f in self.schema(spark, path) or ()}
        known = self._recorded[path]
        for column in rows.schema:
            if known.get(column.name, column.dataType) != column.dataType:
                raise ValueError(f"{path}: {column.name} is {known[column.name].simpleString()}, "
                                 f"a batch has {column.dataType.simpleString()}")
        if not known.keys() >= set(rows.columns):
            schema = StructType([StructField(f.name, f.dataType) for f in rows.schema])
            record = spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
            record.write.mode("overwrite").text(f"{self._schemas(path)}/{batch.stream}-{batch.number}")
            known |= {f.name: f.dataType for f in rows.schema}

    def _schemas(self, path: str) -> str:
        return f"{self.base}/schemas{path.removeprefix(self.base)}"

    def read_without(self, spark: SparkSession, path: str, batch: BatchId) -> DataFrame | None:
        """The table as it was before ``batch``, also when that batch is a replay.

        None if the table does not exist yet. The folder filter prunes partitions. Tables laid
        out by key have the column ``BUCKET``; a filter on it prunes, too.
        """
        if not exists(spark, path):
            return None
        reader = spark.read.format(self.fmt)
        if path in self._recorded and not self.is_delta:  # spares reading a file's footer
            reader = reader.schema(StructType([StructField(*c) for c in self._recorded[path].items()]))
        try:
            rows = reader.load(path)
        except AnalysisException as e:
            if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # folders without a file yet
                return None
            raise
        if self.is_delta:
            return rows
        own = (F.col(STREAM) == batch.stream) & (F.col(BATCH) == batch.number)
        return rows.filter(~own).drop(STREAM, BATCH)

    def is_by_key(self, spark: SparkSession, path: str, batch: BatchId) -> bool:
        """Whether the table's rows are laid out in buckets; not so if ``batch`` is its first."""
        if path not in self._by_key:
            stored = self.read_without(spark, path, batch)
            self._by_key[path] = stored is not None and BUCKET in stored.columns
        return self._by_key[path]

    @staticmethod
    def _folder(path: str, batch: BatchId) -> str:
        return f"{path}/{STREAM}={batch.stream}/{BATCH}={batch.number}"
