from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from kerbstone import rules, session  # noqa: E402
from kerbstone.sources import streams  # noqa: E402
from event_feed import bronze_rows, sensor_messages  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    spark = (
        session.builder("kerbstone-tests")
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .config("spark.checkpoint.dir", f"{shared}/checkpoints")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    session.use_jit_sized_methods(spark)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet")


@pytest.fixture(scope="session")
def bronze(events):
    return bronze_rows(events)


@pytest.fixture(scope="session")
def messages(events):
    return sensor_messages(events)


@pytest.fixture(scope="session")
def make_bronze(spark):
    """Bronze rows from dicts; fields not given hold a valid event's values."""
    clean = {
        "event_id": "E1", "event_time": "2024-01-01T08:30:00+00:00", "vehicle_id": "V1",
        "sensor_id": "S1", "incident_type": "NONE", "speed_kmh": "60", "speed_limit": "50",
        "congestion_level": "3", "weather": "RAIN",
    }

    def make(*rows: dict):
        schema = spark.createDataFrame([], streams.BRONZE_SCHEMA).schema
        full = [{**clean, **row} for row in rows]
        unknown = {name for row in full for name in row} - set(schema.names)
        assert not unknown, unknown
        return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in full], schema)

    return make


FIELDS = [part.split()[0] for part in rules.EVENT_SCHEMA.split(",")]
