from unittest.mock import MagicMock, call

import pytest
from pyspark.errors import AnalysisException

import jobs
from kerbstone import session
from kerbstone.operators.routing import valid_rows
from kerbstone.sinks.lakehouse import BatchId, Lakehouse
from kerbstone.sources import streams


def test_the_three_jobs_in_order(spark, messages, bronze, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "lake")
    messages.write.parquet(landing)
    spark.streams.resetTerminated()  # earlier tests' streams must not count as this job's
    jobs.main(["--base", base, "--once", "bronze", "--files", landing])
    jobs.main(["--base", base, "--once", "--option", "maxFilesPerTrigger=100", "silver-gold"])
    before = spark.catalog.currentDatabase()
    try:
        jobs.main(["--base", base, "register", "--database", "jobs_test"])
        stored = spark.sql("SELECT count(*) FROM jobs_test.fact_traffic_event").first()[0]
        assert stored == valid_rows(bronze).count() > 0
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        streams.kafka_messages(spark, "localhost:9092", maxOffsetsPerTrigger="1000")


def test_delta_session_and_idempotent_append():
    """The Delta jar is not on the test classpath, so only the calls are checked."""
    configs = session.builder("x", "delta")._options
    assert configs["spark.sql.extensions"] == "io.delta.sql.DeltaSparkSessionExtension"
    assert configs["spark.sql.session.timeZone"] == "UTC"
    rows = MagicMock()
    writer = rows.write.format.return_value.mode.return_value.option.return_value.option.return_value
    Lakehouse("/b", "delta").write_batch(rows, "/b/t", BatchId("s", 3))
    rows.write.format.assert_called_once_with("delta")
    rows.write.format.return_value.mode.assert_called_once_with("append")
    assert rows.write.format.return_value.mode.return_value.option.call_args == call("txnAppId", "s")
    writer.save.assert_called_once_with("/b/t")
    writer.option.assert_not_called()
    Lakehouse("/b", "delta").write_batch(rows, "/b/t", BatchId("s", 3), evolve=True)
    writer.option.assert_called_once_with("mergeSchema", "true")


@pytest.mark.parametrize("options, bounded", [
    ({}, True), ({"maxFileAge": "7d"}, True), ({"maxCachedFiles": "5"}, True),
    ({"maxFilesPerTrigger": "3"}, False), ({"MAXBYTESPERTRIGGER": "1g"}, False), ({"maxOffsetsPerTrigger": "9"}, False),
])
def test_only_a_bound_replaces_the_default_bound(options, bounded):
    assert (streams._bounded(options, streams.FILE_BOUND).keys() >= streams.FILE_BOUND.keys()) is bounded


def test_more_columns_from_the_command_line():
    args = jobs._arguments([
        "--base", "b", "silver-gold", "--gold", "dim_road", "--silver-column", "fast=speed_kmh = 99",
        "--quarantine-column", "n=length(raw_json)", "--dimension-column", "dim_road=fast", "--dimension-column", "dim_road=n",
    ])
    more = jobs._more_columns(args)
    assert (more.silver, more.quarantine) == ({"fast": "speed_kmh = 99"}, {"n": "length(raw_json)"})
    assert more.dimensions == {"dim_road": ("fast", "n")} and args.gold == "dim_road"
