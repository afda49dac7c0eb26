from pyspark.sql import functions as F

from compare import plan_text
from conftest import FIELDS
from kerbstone.operators.routing import quarantine_reason, quarantine_rows, valid_rows
from kerbstone.plans.layers import refine


def test_first_reason_wins(make_bronze):
    nothing = {"event_id": None, "event_time": None, "vehicle_id": None, "sensor_id": None}
    table = {
        "CORRUPT_JSON": {"raw": "x", **nothing},
        "NULL_EVENT_ID": nothing,
        "NULL_EVENT_TIME": {**nothing, "event_id": "E"},
        "NULL_VEHICLE_ID": {**nothing, "event_id": "E", "event_time": "t"},
        "NULL_SENSOR_ID": {"sensor_id": None},
    }
    got = quarantine_rows(make_bronze(*table.values())).collect()
    assert [r.quarantine_reason for r in got] == list(table)
    assert all(r.quarantined_at is not None for r in got)


def test_blank_ids_and_unparseable_times_pass(make_bronze):
    df = make_bronze({"event_id": ""}, {"event_time": "soon"}, {"vehicle_id": " "})
    assert valid_rows(df).count() == 3 and quarantine_rows(df).count() == 0


def test_every_row_takes_exactly_one_route(bronze):
    silver, quarantine = refine(bronze)
    assert silver.count() + quarantine.count() == bronze.count()
    assert quarantine.columns == ["raw_json", "kafka_timestamp", *FIELDS, "quarantine_reason", "quarantined_at"]
    assert valid_rows(bronze).filter(quarantine_reason().isNotNull()).isEmpty()
    assert quarantine.filter(F.col("quarantine_reason").isNull()).isEmpty()


def test_null_tests_reach_the_scan(spark, bronze, tmp_path):
    path = str(tmp_path / "bronze")
    bronze.write.parquet(path)
    plan = plan_text(valid_rows(spark.read.parquet(path)).select("event_id"))
    pushed = plan.split("PushedFilters: ")[-1].split("]")[0]
    assert "IsNull(raw)" in pushed
    for name in ("event_id", "event_time", "vehicle_id", "sensor_id"):
        assert f"IsNotNull({name})" in pushed
    read = plan.split("ReadSchema: ")[-1].split("\n")[0]
    assert "raw_json" not in read and "speed_kmh" not in read
