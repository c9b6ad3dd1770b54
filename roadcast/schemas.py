"""Read schemas of the raw payloads and the keyed tables they are flattened into."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Raw payloads -----------------------------------------------------------
# The sources' field names.
#
# Every leaf is read as text and coerced afterwards. A source may or may not quote
# its numbers and flags, and a leaf declared numeric would turn the other spelling
# into null. Where something is not of the shape expected, items of arrays are read as
# text, too, and parsed one by one: an item of another shape turns the array it is in
# into null.

_POINT = "STRUCT<Id: STRING, Name: STRING, Geometry: STRUCT<WGS84: STRING>>"
_VALUE = "STRUCT<Value: STRING>"

RESPONSE = "RESPONSE: STRUCT<RESULT: ARRAY<STRING>>"

WEATHER_ITEM = f"""
Measurepoint: {_POINT},
Sample: STRING,
Surface: STRUCT<Temperature: {_VALUE}, Water: STRING, Ice: STRING, Snow: STRING, Grip: {_VALUE}>,
Air: STRUCT<Temperature: {_VALUE}, RelativeHumidity: {_VALUE}, Dewpoint: {_VALUE}>
"""

SITUATION_HEAD = "Id: STRING, PublicationTime: STRING, VersionTime: STRING"
DEVIATION = """
MessageType: STRING, MessageTypeValue: STRING, MessageCode: STRING, MessageCodeValue: STRING,
SeverityCode: STRING, StartTime: STRING, EndTime: STRING, Suspended: STRING,
Geometry: STRUCT<Point: STRUCT<WGS84: STRING>>
"""

FROST_HEAD = f"Measurepoint: {_POINT}"
READING = "SensorName: STRING, Depth: STRING, Value: STRING"

FORECAST_HEAD = "approvedTime: STRING, referenceTime: STRING"
PARAMETER = "name: STRING, values: ARRAY<STRING>"

# The same with items of the given type, an object's struct or text.


def situation_item(deviation: str) -> str:
    return f"{SITUATION_HEAD}, Deviation: ARRAY<{deviation}>"


def frost_item(reading: str) -> str:
    return f"{FROST_HEAD}, FrostDepth: STRUCT<Sample: STRING, Temperature: ARRAY<{reading}>>"


def forecast(step: str) -> str:
    return f"{FORECAST_HEAD}, timeSeries: ARRAY<{step}>"


def forecast_step(parameter: str) -> str:
    return f"validTime: STRING, parameters: ARRAY<{parameter}>"


def struct(fields: str) -> str:
    return f"STRUCT<{fields.strip()}>"


# The way down a payload: field names, and whether a field holds an array of objects.
_RESULTS = (("RESPONSE", False), ("RESULT", True))
WEATHER_SHAPE = (*_RESULTS, ("WeatherObservation", True))
SITUATION_SHAPE = (*_RESULTS, ("Situation", True), ("Deviation", True))
FROST_SHAPE = (*_RESULTS, ("FrostDepthObservation", True), ("FrostDepth", False), ("Temperature", True))
FORECAST_SHAPE = (("timeSeries", True), ("parameters", True))

LOCATION_ENTRIES = """
MAP<STRING, STRUCT<id: STRING, name: STRING, road: STRING, latitude: DOUBLE, longitude: DOUBLE,
                   municipality: STRING, tv_measurepoint_id: STRING>>
"""


# --- Keyed tables -----------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """A named, versioned table with a primary key and an event time.

    The key always contains the event time, so every key lives in exactly one
    ``event_date`` partition and an upsert touches only the dates it brings.
    """

    name: str
    version: int
    primary_key: tuple[str, ...]
    event_time: str
    columns: str
    description: str = ""
    online_enabled: bool = False

    @property
    def table(self) -> str:
        return f"{self.name}_v{self.version}"

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


WEATHER_OBSERVATION = TableSpec(
    name="weather_observation",
    version=1,
    primary_key=("measurepoint_id", "sample_time"),
    event_time="sample_time",
    columns="""
      measurepoint_id BIGINT, measurepoint_name STRING, wgs84 STRING, sample_time TIMESTAMP,
      surface_temp_c DOUBLE, surface_water BOOLEAN, surface_ice BOOLEAN, surface_snow BOOLEAN,
      surface_grip DOUBLE, air_temp_c DOUBLE, air_rh DOUBLE, dewpoint_c DOUBLE,
      ingested_at TIMESTAMP""",
    description="Road weather observations",
)

SITUATION = TableSpec(
    name="situation",
    version=1,
    primary_key=("situation_id", "version_time"),
    event_time="version_time",
    columns="""
      situation_id STRING, publication_time TIMESTAMP, version_time TIMESTAMP,
      message_type STRING, message_type_value STRING, message_code STRING,
      message_code_value STRING, severity_code STRING, start_time TIMESTAMP,
      end_time TIMESTAMP, suspended BOOLEAN, wgs84 STRING, ingested_at TIMESTAMP""",
    description="Traffic situations: incidents, roadworks and the like",
)

FROST_DEPTH = TableSpec(
    name="frost_depth_observation",
    version=1,
    primary_key=("measurepoint_id", "sample_time", "depth_cm"),
    event_time="sample_time",
    columns="""
      measurepoint_id BIGINT, measurepoint_name STRING, wgs84 STRING, sample_time TIMESTAMP,
      sensor_name STRING, depth_cm DOUBLE, temp_c DOUBLE, ingested_at TIMESTAMP""",
    description="Frost depth observations",
)

POINT_FORECAST = TableSpec(
    name="point_forecast",
    version=3,
    primary_key=("measurepoint_id", "forecast_run_time", "valid_time"),
    event_time="valid_time",
    columns="""
      measurepoint_id BIGINT, lat DOUBLE, lon DOUBLE, forecast_run_time TIMESTAMP,
      valid_time TIMESTAMP, t_air_c DOUBLE, precip_mm DOUBLE, wind_ms DOUBLE, rh DOUBLE,
      ingested_at TIMESTAMP""",
    description="Point forecast time series",
)

PREDICTION = TableSpec(
    name="hazard_prediction",
    version=4,
    primary_key=("measurepoint_id", "forecast_run_time", "valid_time", "horizon_hours"),
    event_time="valid_time",
    columns="""
      measurepoint_id BIGINT, valid_time TIMESTAMP, horizon_hours BIGINT, risk_mean DOUBLE,
      risk_p10 DOUBLE, risk_p90 DOUBLE, hazard_predicted INT, recommendation STRING,
      forecast_run_time TIMESTAMP""",
    description="Hazard forecasts for the 24, 48 and 72 hour horizons",
)

# --- Fixed values -----------------------------------------------------------

HORIZONS = (24, 48, 72)

FORECAST_FEATURES = ("t_air_c", "precip_mm", "wind_ms", "rh")
STATIC_FEATURES = ("lat", "lon")
CALENDAR_FEATURES = ("hour", "day_of_week", "month", "is_rush_hour", "is_weekend")
OBSERVATION_FEATURES = (
    "obs_surface_temp_c",
    "obs_surface_grip",
    "obs_air_temp_c",
    "obs_air_rh",
    "obs_dewpoint_c",
    "obs_surface_ice",
    "obs_surface_snow",
    "obs_surface_water",
    "obs_age_minutes",
)
FEATURES = FORECAST_FEATURES + STATIC_FEATURES + CALENDAR_FEATURES + OBSERVATION_FEATURES
