"""The jobs for spark-submit.

    jobs.py --base DIR bronze --servers HOST:PORT [--topic T] [--from earliest]
    jobs.py --base DIR bronze --files DIR            messages from Parquet files
    jobs.py --base DIR silver-gold [--new-dimension-rows-only] [--interval "30 seconds"]
                       [--gold dim_road,fact_incident] [--silver-column NAME=SQL]
                       [--quarantine-column NAME=SQL] [--dimension-column TABLE=COLUMN]
    jobs.py --base DIR register [--database Traffic]

``--once`` works off what is there and stops; without it a stream runs until stopped.
"""

from __future__ import annotations

import argparse
import logging

from kerbstone import session
from kerbstone.sinks.catalog import register_tables
from kerbstone.sinks.lakehouse import Lakehouse
from kerbstone.sources import streams
from kerbstone.streaming.bronze_job import start_bronze
from kerbstone.streaming.progress import BatchLog
from kerbstone.streaming.silver_gold_job import GOLD, JOB, MoreColumns, SilverGoldJob
from kerbstone.streaming.triggers import ASAP, BACKLOG_THEN_STOP


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("--base", required=True, help="folder of all tables and checkpoints")
    parser.add_argument("--format", default="parquet", help="table format: parquet or delta")
    parser.add_argument("--hive", action="store_true", help="use the Hive metastore as catalog")
    parser.add_argument("--once", action="store_true", help="stop when the backlog is done")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                        help="source option, e.g. maxFilesPerTrigger=1000")
    jobs = parser.add_subparsers(dest="job", required=True)
    bronze = jobs.add_parser("bronze")
    source = bronze.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--files", help="folder of Parquet message files")
    bronze.add_argument("--topic", default="traffic-topic")
    bronze.add_argument("--from", dest="starting", default="latest")
    silver_gold = jobs.add_parser("silver-gold")
    silver_gold.add_argument("--interval", default="30 seconds")
    silver_gold.add_argument("--new-dimension-rows-only", action="store_true")
    silver_gold.add_argument("--gold", default=",".join(GOLD), help="the gold tables to write")
    for table in ("silver", "quarantine", "dimension"):
        silver_gold.add_argument(f"--{table}-column", action="append", default=[], metavar="NAME=VALUE",
                                 help=f"a further column of {table} tables")
    register = jobs.add_parser("register")
    register.add_argument("--database", default="Traffic")
    return parser.parse_args(argv)


def _more_columns(args: argparse.Namespace) -> MoreColumns:
    pairs = lambda given: [text.split("=", 1) for text in given]
    dimensions: dict[str, tuple[str, ...]] = {}
    for table, column in pairs(args.dimension_column):
        dimensions[table] = (*dimensions.get(table, ()), column)
    return MoreColumns(dict(pairs(args.silver_column)), dict(pairs(args.quarantine_column)), dimensions)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    logging.basicConfig(level=logging.INFO)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = session.builder(f"kerbstone-{args.job}", args.format, args.hive).getOrCreate()
    tables = Lakehouse(args.base, args.format)
    options = dict(option.split("=", 1) for option in args.option)
    if args.job == "register":
        register_tables(spark, tables, args.database)
    elif args.job == "bronze":
        messages = (
            streams.file_messages(spark, args.files, **options)
            if args.files
            else streams.kafka_messages(spark, args.servers, args.topic, args.starting, **options)
        )
        start_bronze(messages, tables, BACKLOG_THEN_STOP if args.once else ASAP)
        spark.streams.awaitAnyTermination()
    else:
        trigger = BACKLOG_THEN_STOP if args.once else {"processingTime": args.interval}
        bronze = streams.bronze_rows(spark, tables.bronze, tables.fmt, **options)
        job = SilverGoldJob(
            spark, tables, args.new_dimension_rows_only, gold=tuple(filter(None, args.gold.split(","))),
            more=_more_columns(args), on_batch=BatchLog(spark, tables, JOB).add,
        )
        job.start(bronze, trigger).awaitTermination()


if __name__ == "__main__":
    main()
