import datetime as dt

import pytest

from kerbstone import rules
from kerbstone.plans.layers import refine


def _silver(df):
    return refine(df).silver


def test_columns_in_table_order(bronze):
    silver = _silver(bronze)
    assert silver.columns == rules.SILVER_COLUMNS and len(silver.columns) == 62
    kinds = dict(silver.dtypes)
    assert {kinds[c] for c in rules.DOUBLES if c in kinds} == {"double"}
    assert {kinds[c] for c in rules.INTEGERS} == {"int"}
    assert {kinds[c] for c in rules.BOOLEANS} == {"boolean"}
    assert kinds["silver_processed_at"] == "timestamp"


# Fault kind -> injected fields -> expected silver values.
FAULTS = {
    "null_speed": ({"speed_kmh": None}, {"speed_kmh": None, "speed_band": "UNKNOWN", "speed_excess_kmh": None}),
    "negative_speed": ({"speed_kmh": "-40"}, {"speed_kmh": 0.0, "speed_band": "VERY_SLOW", "speed_excess_kmh": 0.0}),
    "extreme_speed": ({"speed_kmh": "1500"}, {"speed_kmh": 250.0, "speed_band": "VERY_FAST", "speed_excess_kmh": 200.0}),
    "not_a_number_speed": ({"speed_kmh": "NaN"}, {"speed_kmh": 250.0, "speed_band": "VERY_FAST"}),
    "late_event": ({"event_time": "2024-01-01T06:30:00+00:00"}, {"event_hour_clean": 6, "is_peak_hour": False}),
    "future_event": ({"event_time": "2099-01-01T17:30:00+00:00"}, {"event_year": 2099, "is_peak_hour": True}),
    "unparseable_time": ({"event_time": "soon"}, {"event_time_ts": None, "event_year": None, "is_peak_hour": None}),
    "wrong_datatype": ({"speed_kmh": "FAST", "congestion_level": "HIGH"}, {"speed_kmh": None, "congestion_level": None}),
    "schema_drift": ({"schema_version": None}, {"event_id": "E1"}),
    "invalid_geo": ({"geo_lat": "9999.9", "geo_lon": "-9999.9"}, {"geo_lat": 90.0, "geo_lon": -180.0}),
    "congestion_low": ({"congestion_level": "-1"}, {"congestion_level": 1}),
    "congestion_high": ({"congestion_level": "99"}, {"congestion_level": 5}),
    "speed_limit_not_allowed": ({"speed_limit": "45"}, {"speed_limit": None, "speed_excess_kmh": None}),
    "padded_text": ({"weather": "  rain "}, {"weather": "RAIN", "weather_severity": "MEDIUM"}),
    "tab_padded_text": ({"weather": "\train"}, {"weather": None, "weather_severity": "UNKNOWN"}),
    "unknown_category": ({"vehicle_type": "hovercraft"}, {"vehicle_type": None}),
    "free_text_is_standardised_only": ({"vehicle_make": " Tesla "}, {"vehicle_make": "TESLA"}),
    "id_is_left_alone": ({"trip_id": " t1 "}, {"trip_id": " t1 "}),
    "fraction_in_whole_number": ({"visibility_m": "12.5"}, {"visibility_m": 12}),
    "given_score_is_ignored": ({"safety_score": "1.0", "brake_event": True}, {"safety_score_clean": 9.0}),
    "given_flag_is_kept": ({"speed_kmh": "10", "is_speeding": True}, {"is_speeding": True, "speed_excess_kmh": 0.0}),
}


@pytest.fixture(scope="module")
def repaired(make_bronze):
    rows = [{"trip_id": name, **injected} for name, (injected, _) in FAULTS.items()]
    found = _silver(make_bronze(*rows)).collect()
    return {r.trip_id: r for r in found}


@pytest.mark.parametrize("fault", FAULTS)
def test_fault_is_repaired(repaired, fault):
    injected, expected = FAULTS[fault]
    row = repaired[injected.get("trip_id", fault)]
    assert {c: row[c] for c in expected} == expected


def test_duplicates_are_kept(make_bronze):
    assert _silver(make_bronze({"event_id": "E1"}, {"event_id": "E1"})).count() == 2


def test_whole_row(make_bronze):
    row = _silver(make_bronze({})).first()
    assert row.event_time_ts == dt.datetime(2024, 1, 1, 8, 30)
    assert (row.event_dow, row.is_peak_hour, row.speed_band, row.speed_excess_kmh) == (2, True, "MODERATE", 10.0)


def test_clipped_and_validated_values_stay_inside_their_rules(bronze):
    silver = _silver(bronze)
    for column, (low, high) in rules.LIMITS.items():
        assert silver.filter(f"{column} < {low} or {column} > {high}").isEmpty(), column
    for column, allowed in rules.ALLOWED.items():
        assert silver.filter(~silver[column].isin(*allowed)).isEmpty(), column
