import pytest
from kerbstone import rules
from kerbstone.sinks.catalog import register_tables
from kerbstone.sinks.lakehouse import BatchId, Lakehouse
from kerbstone.streaming.silver_gold_job import SilverGoldJob


def test_gold_tables_by_name(spark, make_bronze, tmp_path):
    tables = Lakehouse(str(tmp_path))
    job = SilverGoldJob(spark, tables)
    job.process(make_bronze({}, {"event_id": "E2", "incident_type": "ACCIDENT"}), BatchId("s", 0))
    before = spark.catalog.currentDatabase()
    try:
        names = register_tables(spark, tables, "Traffic", str(tmp_path / "db"))
        assert sorted(names) == sorted([*rules.DIMENSIONS, *rules.FACTS]) and len(names) == 9
        assert spark.catalog.currentDatabase().lower() == "traffic"
        assert {t.name for t in spark.catalog.listTables()} >= set(names)
        # The contract's columns and no batch columns.
        assert tuple(spark.table("fact_incident").columns) == rules.FACTS["fact_incident"]
        assert spark.sql("SELECT count(*) FROM Traffic.fact_incident").first()[0] == 1
        # A new batch shows up without registering or repairing anything.
        job.process(make_bronze({}), BatchId("s", 1))
        spark.sql("REFRESH TABLE fact_traffic_event")
        assert spark.table("fact_traffic_event").count() == 3
        assert register_tables(spark, tables, "Traffic", str(tmp_path / "db")) == names
        # Facts join dimensions on the keys they computed.
        joined = spark.sql("""SELECT count(*) FROM fact_incident f
            JOIN dim_vehicle v ON v.vehicle_key = f.vehicle_key
            JOIN dim_time t ON t.time_key = f.time_key""")
        assert joined.first()[0] == 4  # the same keys came in two batches
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_columns_that_a_later_batch_brings_are_seen_by_path_and_by_name(spark, tmp_path):
    tables = Lakehouse(str(tmp_path / "lake"))
    for name in (*rules.DIMENSIONS, *rules.FACTS):
        tables.write_batch(spark.sql("select 1 as a"), tables.gold(name), BatchId("s", 0), evolve=name in rules.DIMENSIONS)
    before = spark.catalog.currentDatabase()
    try:
        register_tables(spark, tables, "evolving", str(tmp_path / "db"))
        path = tables.gold("dim_vehicle")
        for _ in range(2):  # the second time as a replay
            tables.write_batch(spark.sql("select 2 as a, 'x' as b"), path, BatchId("s", 1), evolve=True)
        register_tables(spark, tables, "evolving", str(tmp_path / "db"))
        spark.sql("refresh table evolving.dim_vehicle")
        expected = [(1, None), (2, "x")]
        assert sorted(map(tuple, tables.read(spark, path).collect())) == expected
        assert sorted(map(tuple, spark.table("evolving.dim_vehicle").collect())) == expected
        with pytest.raises(ValueError, match="a is int"):
            tables.write_batch(spark.sql("select 'text' as a"), path, BatchId("s", 2), evolve=True)
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("drop database if exists evolving cascade")
