import pytest
from pyspark.sql import functions as F

from compare import plan_text, sorted_rows
from kerbstone import rules
from kerbstone.operators.dimensions import build_dimension
from kerbstone.operators.facts import build_fact
from kerbstone.operators.new_keys import only_new_keys
from kerbstone.plans.layers import gold, refine

WIDTHS = {
    "dim_vehicle": 7, "dim_road": 11, "dim_weather": 9, "dim_time": 8, "dim_signal": 4, "dim_payment": 2,
    "dim_incidentdet": 4, "fact_traffic_event": 27, "fact_incident": 12,
}


@pytest.fixture(scope="module")
def silver(spark, bronze, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "t")
    refine(bronze).silver.write.parquet(path)
    return spark.read.parquet(path)


def test_tables_and_widths(silver):
    assert {name: len(df.columns) for name, df in gold(silver).items()} == WIDTHS


@pytest.mark.parametrize("name", rules.DIMENSIONS)
def test_dimension_rows_do_not_depend_on_row_order(silver, name):
    shuffled = silver.repartition(7).sortWithinPartitions(F.rand(3))
    assert sorted_rows(build_dimension(silver, name)) == sorted_rows(build_dimension(shuffled, name))


@pytest.mark.parametrize("name", rules.DIMENSIONS)
def test_dimension_keys_are_unique_and_rows_are_real(silver, name):
    rows = build_dimension(silver, name)
    key, attributes = rules.DIMENSIONS[name].key, rules.DIMENSIONS[name].attributes
    assert rows.groupBy(key).count().filter("count > 1").isEmpty()
    seen = {tuple(r) for r in silver.select(*attributes).distinct().collect()}
    assert {tuple(r) for r in rows.select(*attributes).collect()} <= seen


@pytest.mark.parametrize("name", rules.DIMENSIONS)
def test_dimension_plan_is_partial_minimum_and_one_exchange(silver, name):
    plan = plan_text(build_dimension(silver, name))
    tree = plan.split("\n\n\n")[0]
    assert tree.count("Exchange (") == 1
    assert "partial_min" in plan
    read = plan.split("ReadSchema: ")[1].split("\n")[0]
    unused = set(rules.SILVER_COLUMNS) - {"event_time_ts", "incident_id"} - set(rules.DIMENSIONS[name].attributes)
    unused -= set(rules.SURROGATE_KEYS.get(rules.DIMENSIONS[name].key, ()))
    assert not [c for c in unused if f"{c}:" in read.replace("<", ",").replace("struct,", ",").split(",")]


def test_facts_are_map_only(silver):
    for name in rules.FACTS:
        plan = plan_text(build_fact(silver, name))
        assert "Exchange" not in plan and "Python" not in plan
    assert "Not(EqualTo(incident_type,NONE))" in plan_text(build_fact(silver, "fact_incident"))


def test_every_fact_key_is_in_its_dimension(silver):
    tables = gold(silver)
    for fact in rules.FACTS:
        for name, dimension in rules.DIMENSIONS.items():
            if dimension.key in rules.FACTS[fact]:
                orphans = tables[fact].join(tables[name], dimension.key, "left_anti")
                assert orphans.isEmpty(), (fact, name)


def test_flags_are_numbers_and_unknown_flags_stay_unknown(make_bronze):
    df = make_bronze({"brake_event": True}, {"brake_event": False}, {"brake_event": None})
    fact = build_fact(refine(df).silver, "fact_traffic_event")
    assert dict(fact.dtypes)["brake_event"] == "int"
    assert [r.brake_event for r in fact.collect()] == [1, 0, None]


def test_incidents_are_filtered_after_validation(make_bronze):
    df = make_bronze(*({"incident_type": t} for t in ("none", " debris ", "ALIENS", None, "ACCIDENT")))
    assert build_fact(refine(df).silver, "fact_incident").count() == 2


def test_null_incidents_make_one_dimension_row(make_bronze):
    df = make_bronze({"incident_id": None}, {"incident_id": None}, {"incident_id": "I1"})
    rows = build_dimension(refine(df).silver, "dim_incidentdet")
    assert sorted_rows(rows.select("incident_key")) == [(None,), ("I1",)]


def test_earliest_event_is_picked(make_bronze):
    df = make_bronze(
        {"lane_number": "3", "event_time": "2024-01-02T00:00:00+00:00"},
        {"lane_number": "4", "event_time": "2024-01-01T00:00:00+00:00"},
        {"lane_number": "2", "event_time": "2024-01-01T00:00:00+00:00"},
    )
    assert [r.lane_number for r in build_dimension(refine(df).silver, "dim_road").collect()] == [2]


def test_a_hot_key_sends_one_row_per_task(spark, silver):
    """A third of all rows under one key: partial minima, not rows, cross the exchange."""
    hot = silver.withColumn("vehicle_id", F.when(F.rand(1) < 0.34, "V-HOT").otherwise(F.col("vehicle_id")))
    rows = build_dimension(hot.repartition(4), "dim_vehicle")
    assert rows.count() == hot.select("vehicle_id").distinct().count()


def test_only_new_keys(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    stored = spark.createDataFrame([("a", 9), ("z", 9), (None, 9)], "k string, v int")
    assert sorted_rows(only_new_keys(rows, stored, "k")) == [("b", 2)]
    assert only_new_keys(rows, stored.filter("k = 'z'"), "k").count() == 3
