"""The pipeline's contract as plain data: no Spark objects, no logic.

Everything in this module is a fixed value. Names, orders, lists and limits must
equal those of the published feed and tables, or results would differ.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: wire schema of one sensor event, in field order -------------------
# Text first: a field that arrives with the wrong type is kept as text and judged
# later, so one bad field never costs the whole event.
EVENT_SCHEMA = """
    event_id STRING, vehicle_id STRING, sensor_id STRING, trip_id STRING, incident_id STRING,
    event_time STRING, event_date STRING, event_hour STRING,
    road_id STRING, city_zone STRING, direction STRING, road_surface STRING, lane_type STRING,
    lane_number STRING, speed_limit STRING, geo_lat STRING, geo_lon STRING,
    nearest_intersection STRING,
    vehicle_type STRING, fuel_type STRING, vehicle_make STRING, is_commercial BOOLEAN,
    weight_class STRING,
    weather STRING, temperature_c STRING, humidity_pct STRING, wind_speed_kmh STRING,
    visibility_m STRING, road_temp_c STRING, is_daylight BOOLEAN,
    signal_phase STRING, signal_time_elapsed_s STRING,
    incident_type STRING, incident_severity STRING,
    speed_kmh STRING, speed_variance STRING, is_speeding BOOLEAN, congestion_level STRING,
    occupancy_rate STRING, headway_secs STRING, flow_rate_per_hour STRING,
    queue_length_m STRING, travel_time_index STRING,
    brake_event BOOLEAN, horn_event BOOLEAN, near_miss_event BOOLEAN, safety_score STRING,
    co2_grams_per_km STRING, noise_db STRING, fuel_consumption_l100km STRING,
    toll_amount_usd STRING, payment_method STRING, toll_tag_present BOOLEAN,
    data_source STRING, schema_version STRING, ingested_at STRING,
    raw STRING
"""

# --- Fixed values: routing ----------------------------------------------------------
CORRUPT_FIELD = "raw"
CORRUPT_REASON = "CORRUPT_JSON"
# In order of precedence; the reason for a missing field is NULL_<FIELD>.
MANDATORY = ("event_id", "event_time", "vehicle_id", "sensor_id")

# --- Fixed values: target types -----------------------------------------------------
TIMESTAMPS = {"event_time_ts": "event_time", "ingested_at_ts": "ingested_at"}
DOUBLES = (
    "speed_kmh", "occupancy_rate", "headway_secs", "co2_grams_per_km", "noise_db",
    "toll_amount_usd", "fuel_consumption_l100km", "geo_lat", "geo_lon", "temperature_c",
    "road_temp_c", "travel_time_index", "speed_variance", "safety_score",
)
INTEGERS = (
    "congestion_level", "flow_rate_per_hour", "humidity_pct", "wind_speed_kmh",
    "visibility_m", "speed_limit", "lane_number", "signal_time_elapsed_s", "queue_length_m",
)
BOOLEANS = (
    "is_speeding", "brake_event", "horn_event", "near_miss_event", "is_commercial",
    "toll_tag_present", "is_daylight",
)
# Stored as upper-case text without surrounding blanks.
STANDARD_TEXT = (
    "vehicle_type", "fuel_type", "vehicle_make", "weight_class", "weather", "road_surface",
    "lane_type", "direction", "signal_phase", "incident_type", "incident_severity",
    "payment_method", "city_zone", "road_id",
)

# --- Fixed values: inclusive limits; outside values move to the nearest limit -------
LIMITS = {
    "speed_kmh": (0.0, 250.0),
    "congestion_level": (1, 5),
    "geo_lat": (-90.0, 90.0),
    "geo_lon": (-180.0, 180.0),
    "humidity_pct": (0, 100),
    "noise_db": (0.0, 200.0),
    "co2_grams_per_km": (0.0, 1000.0),
    "toll_amount_usd": (0.0, 500.0),
}

# --- Fixed values: allowed values; anything else becomes NULL ------------------------
ALLOWED = {
    "vehicle_type": ("CAR", "TRUCK", "MOTORCYCLE", "BUS", "BICYCLE", "SCOOTER", "EMERGENCY"),
    "fuel_type": ("PETROL", "DIESEL", "ELECTRIC", "HYBRID", "HYDROGEN"),
    "weather": ("CLEAR", "RAIN", "FOG", "STORM", "SNOW", "HAIL", "WINDY"),
    "road_surface": ("ASPHALT", "CONCRETE", "GRAVEL", "WET_ASPHALT"),
    "lane_type": ("MAIN", "EXPRESS", "BUS_LANE", "BIKE_LANE", "MERGE"),
    "direction": ("NORTH", "SOUTH", "EAST", "WEST"),
    "signal_phase": ("GREEN", "YELLOW", "RED", "FLASHING"),
    "payment_method": ("CASH", "TAG", "APP", "EXEMPT"),
    "incident_type": ("NONE", "ACCIDENT", "BREAKDOWN", "ROADWORK", "POLICE_CHECK", "DEBRIS"),
    "weight_class": ("LIGHT", "MEDIUM", "HEAVY"),
    "city_zone": ("CBD", "AIRPORT", "TECHPARK", "SUBURB", "TRAINSTATION", "HARBOR", "UNIVERSITY"),
    "speed_limit": (40, 50, 60, 80, 100, 110),
}

# --- Fixed values: derived columns --------------------------------------------------
UNKNOWN = "UNKNOWN"
# Each band holds the speeds below its bound; the last band has none.
SPEED_BANDS = {"VERY_SLOW": 20, "SLOW": 50, "MODERATE": 80, "FAST": 110, "VERY_FAST": None}
SAFETY_START = 10.0
SAFETY_PENALTIES = {"near_miss_event": 3.0, "brake_event": 1.0}
PEAK_HOURS = (7, 8, 17, 18)
WEATHER_SEVERITY = {
    "LOW": ("CLEAR", "WINDY"),
    "MEDIUM": ("RAIN", "FOG"),
    "HIGH": ("STORM", "SNOW", "HAIL"),
}

# --- Fixed values: silver columns, in table order -----------------------------------
SILVER_COLUMNS = """
    event_id vehicle_id sensor_id trip_id
    event_time_ts event_year event_month event_day event_hour_clean event_dow is_peak_hour
    ingested_at_ts silver_processed_at
    road_id city_zone direction road_surface lane_type lane_number speed_limit
    geo_lat geo_lon nearest_intersection
    vehicle_type fuel_type vehicle_make is_commercial weight_class
    weather weather_severity temperature_c humidity_pct wind_speed_kmh visibility_m
    road_temp_c is_daylight
    signal_phase signal_time_elapsed_s
    incident_type incident_id incident_severity
    speed_kmh speed_band speed_excess_kmh speed_variance is_speeding congestion_level
    occupancy_rate headway_secs flow_rate_per_hour queue_length_m travel_time_index
    brake_event horn_event near_miss_event safety_score_clean
    co2_grams_per_km noise_db fuel_consumption_l100km
    toll_amount_usd payment_method toll_tag_present
""".split()

# --- Fixed values: surrogate keys ---------------------------------------------------
KEY_SEPARATOR = "|"
SURROGATE_KEYS = {
    "vehicle_key": ("vehicle_id",),
    "road_key": ("road_id", "lane_type", "direction"),
    "weather_key": ("weather", "weather_severity"),
    "time_key": ("event_year", "event_month", "event_day", "event_hour_clean"),
    "signal_key": ("signal_phase", "signal_time_elapsed_s"),
    "payment_key": ("payment_method",),
}
# Keys taken over from the source as they are, NULL included.
NATURAL_KEYS = {"incident_key": "incident_id"}


@dataclass(frozen=True)
class Dimension:
    """One row per key, holding the attributes seen with it."""

    key: str
    attributes: tuple[str, ...]


# --- Fixed values: star schema, columns in table order -------------------------------
DIMENSIONS = {
    "dim_vehicle": Dimension(
        "vehicle_key",
        ("vehicle_id", "vehicle_type", "fuel_type", "vehicle_make", "weight_class",
         "is_commercial"),
    ),
    "dim_road": Dimension(
        "road_key",
        ("road_id", "lane_type", "lane_number", "direction", "road_surface", "city_zone",
         "speed_limit", "geo_lat", "geo_lon", "nearest_intersection"),
    ),
    "dim_weather": Dimension(
        "weather_key",
        ("weather", "weather_severity", "temperature_c", "road_temp_c", "humidity_pct",
         "wind_speed_kmh", "visibility_m", "is_daylight"),
    ),
    "dim_time": Dimension(
        "time_key",
        ("event_time_ts", "event_year", "event_month", "event_day", "event_hour_clean",
         "event_dow", "is_peak_hour"),
    ),
    "dim_signal": Dimension(
        "signal_key", ("signal_phase", "signal_time_elapsed_s", "queue_length_m")
    ),
    "dim_payment": Dimension("payment_key", ("payment_method",)),
    "dim_incidentdet": Dimension(
        "incident_key", ("incident_severity", "incident_type", "speed_band")
    ),
}

# Flags are stored as 0/1 in facts.
FACT_FLAGS = (
    "is_peak_hour", "is_speeding", "horn_event", "near_miss_event", "brake_event",
    "toll_tag_present",
)
FACTS = {
    "fact_traffic_event": (
        "event_id", "sensor_id", "trip_id",
        "vehicle_key", "road_key", "time_key", "weather_key", "signal_key", "payment_key",
        "speed_kmh", "speed_excess_kmh", "speed_variance", "is_speeding", "congestion_level",
        "occupancy_rate", "headway_secs", "flow_rate_per_hour", "travel_time_index",
        "horn_event", "near_miss_event", "brake_event", "safety_score_clean",
        "co2_grams_per_km", "noise_db", "fuel_consumption_l100km", "toll_amount_usd",
        "toll_tag_present",
    ),
    "fact_incident": (
        "incident_key", "event_id",
        "vehicle_key", "road_key", "time_key", "weather_key",
        "speed_kmh", "congestion_level", "visibility_m",
        "is_peak_hour", "near_miss_event", "brake_event",
    ),
}
# Incident type that stands for "no incident"; such rows are not incident facts.
NO_INCIDENT = "NONE"
