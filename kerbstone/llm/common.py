"""What the operators share: text pieces, keys of rows, tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see; a local one only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared}/llm-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="llm-")


def settle(rows: DataFrame, *keys: str) -> DataFrame:
    """Write ``rows`` as a table in the shared folder and read it back.

    It cuts the lineage, outlives lost executors, and gives the planner measured sizes.
    ``keys`` deal the rows out by hash before they are written.
    """
    path = f"{shared_folder(rows.sparkSession)}/table"
    (rows.repartition(*keys) if keys else rows).write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def text_or_empty(text: Column | str = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def held_out(modulus: int, doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id's text leaves remainder 2; never true for a NULL id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == 2, F.lit(False))


def with_row_key(docs: DataFrame) -> DataFrame:
    """Adds ``row_key``, a hash of the text: with doc_id it tells rows apart.

    Rows that repeat both are the same document, however often they occur.
    """
    return docs.withColumn("row_key", F.xxhash64(text_or_empty()))


def join_rows(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Joins on doc_id (NULL equals NULL) and row_key; the left's columns of these names stay."""
    keys = {"doc_id": "_right_id", "row_key": "_right_key"}
    same = (F.col("row_key") == F.col("_right_key")) & F.col("doc_id").eqNullSafe(
        F.col("_right_id")
    )
    return left.join(right.withColumnsRenamed(keys), same, how).drop(*keys.values())


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, made longer until no column of ``docs`` has them."""
    taken = {c.lower() for c in docs.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free


def join_whole(docs: DataFrame, found: DataFrame, how: str, key: Column | None = None, **values: str) -> DataFrame:
    """``docs`` with all their columns joined to ``found`` on doc_id (NULL equals NULL) and row_key.

    ``key`` is the row key made from the text, by default that of ``with_row_key``. ``values``:
    names that columns of ``found`` get; they and the keys must be unused in ``docs``.
    """
    own, of_id, of_key = unused(docs, "own_key", "found_id", "found_key")
    right = found.select(
        F.col("doc_id").alias(of_id), F.col("row_key").alias(of_key),
        *(F.col(old).alias(new) for old, new in values.items()),
    )
    keyed = docs.withColumn(own, F.xxhash64(text_or_empty()) if key is None else key)
    same = (F.col(own) == F.col(of_key)) & F.col("doc_id").eqNullSafe(F.col(of_id))
    return keyed.join(right, same, how).drop(own, of_id, of_key)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
