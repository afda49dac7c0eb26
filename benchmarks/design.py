"""Measures the design decisions against their alternatives.

    python benchmarks/design.py [SF_DIR] [COPIES]

* plan building: one projection per stage against one ``withColumn`` per column
* silver: with and without code sized for the JIT compiler
* micro-batch: gold from the stored silver files, from a cached silver, and from the
  silver plan run anew for every table; and how many tables are written at a time

COPIES repeats the events under new ids, for runs long enough to show throughput.
"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from kerbstone import rules  # noqa: E402
from kerbstone.operators import silver as silver_ops  # noqa: E402
from kerbstone.operators.routing import quarantine_rows, valid_rows  # noqa: E402
from kerbstone.operators.silver import to_silver  # noqa: E402
from kerbstone.session import builder, jit_sized_methods  # noqa: E402
from kerbstone.sinks.lakehouse import BatchId, Lakehouse  # noqa: E402
from event_feed import bronze_rows  # noqa: E402
from kerbstone.streaming.silver_gold_job import SilverGoldJob  # noqa: E402

RUNS = 3


def one_column_at_a_time(valid: DataFrame) -> DataFrame:
    rows = valid
    for stage in (silver_ops.typed_columns, silver_ops.validated_columns, silver_ops.derived_columns):
        for name, column in stage().items():
            rows = rows.withColumn(name, column)
    return rows.select(*rules.SILVER_COLUMNS)


def best(action) -> float:
    """Shortest of a few runs, in seconds; the first ones warm the JVM up."""
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 2)


def run(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def fresh() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def recomputed_batch(job: SilverGoldJob, bronze: DataFrame, cached: bool) -> None:
    """The batch without stored silver: every gold table starts from the silver plan."""
    batch = BatchId("b", 0)
    silver = to_silver(valid_rows(bronze))
    if cached:
        silver = silver.persist()
    job.tables.write_batch(silver, job.tables.silver, batch)
    quarantine = quarantine_rows(bronze)
    if not quarantine.isEmpty():
        job.tables.write_batch(quarantine, job.tables.quarantine, batch)
    job.write_gold(silver, batch)
    if cached:
        silver.unpersist()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 1
    spark = (
        builder("kerbstone-design").master("local[8]")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "20g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.codegen.hugeMethodLimit", "65535")  # Spark's default, varied below
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    repeated = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn(
        "event_id", F.col("event_id") + 1_000_000 * F.col("copy")
    )
    path = f"{fresh()}/bronze"
    with jit_sized_methods(spark):
        bronze_rows(repeated.repartition(16)).write.parquet(path)
    bronze = spark.read.parquet(path)
    print(f"rows: {bronze.count()}")

    print("plan building, staged:", best(lambda: to_silver(valid_rows(bronze))), "s")
    print("plan building, column by column:", best(lambda: one_column_at_a_time(valid_rows(bronze))), "s")

    print("silver, default code:", best(lambda: run(to_silver(valid_rows(bronze)))), "s")
    print("silver, column by column:", best(lambda: run(one_column_at_a_time(valid_rows(bronze)))), "s")
    with jit_sized_methods(spark):
        print("silver, JIT-sized code:", best(lambda: run(to_silver(valid_rows(bronze)))), "s")

    def micro_batch(parallel: int = 4) -> None:
        SilverGoldJob(spark, Lakehouse(fresh()), parallel_writes=parallel).process(bronze, BatchId("b", 0))

    for parallel in (1, 4, 9):
        print(f"micro-batch, stored silver, {parallel} at a time:", best(lambda: micro_batch(parallel)), "s")
    # The alternatives get the better code as well, and four writers.
    with jit_sized_methods(spark):
        for name, cached in (("cached silver", True), ("silver run anew", False)):
            job = lambda: SilverGoldJob(spark, Lakehouse(fresh()))
            print(f"micro-batch, {name}:", best(lambda: recomputed_batch(job(), bronze, cached)), "s")
    one = lambda: SilverGoldJob(spark, Lakehouse(fresh()), parallel_writes=1)
    print("micro-batch, silver run anew, default code, one at a time:",
          best(lambda: recomputed_batch(one(), bronze, False)), "s")
    spark.stop()


if __name__ == "__main__":
    main()
