"""Parsed payloads against the separate reads of rows and faults."""

import json

import pytest
from pyspark.sql import functions as F

from roadcast import schemas
from roadcast.sources import extract
from roadcast.sources.forecasts import location_errors, parsed_errors
from roadcast.sources.landing import answered, listed_faults, quarantined
from roadcast.sources.locations import default_locations
from test_extract import BODIES, FORECAST, FROST, SITUATION, WEATHER, landed

ITEM = json.loads(WEATHER)["RESPONSE"]["RESULT"][0]["WeatherObservation"][0]
ODD = [
    *BODIES.values(), WEATHER, SITUATION, FROST, FORECAST, WEATHER + "x", "{}",
    json.dumps({"RESPONSE": {"RESULT": ["x", {"WeatherObservation": [1, ITEM, None, "bad", ITEM]}, {}, None]}}),
    json.dumps({"RESPONSE": {"RESULT": [{"WeatherObservation": [ITEM, None]}, None]}}),
    json.dumps({"RESPONSE": {"RESULT": [{"WeatherObservation": None}, {}]}}),
    '{"RESPONSE": "oops"}', '{"RESPONSE": {"RESULT": {"a": 1}}}', '{"RESPONSE": null}', '{"RESPONSE": {"RESULT": []}}',
    '{"RESPONSE": {"RESULT": [{"Situation": 5}]}}',
    '{"RESPONSE": {"RESULT": [{"Situation": [{"Deviation": "x"}, {"Deviation": [3]}, {"Deviation": [null, {}]}]}]}}',
    '{"RESPONSE": {"RESULT": [{"Situation": [{"Id": "S", "Deviation": [null, {"MessageType": "m"}]}, null]}]}}',
    FROST.replace('"FrostDepth":{', '"FrostDepth":7,"x":{'), FROST.replace('"Temperature":[', '"Temperature":[null,'),
    '{"timeSeries": [{"parameters": {}}, 2]}', FORECAST.replace('"parameters":[', '"parameters":[null,'),
    FORECAST.replace('"timeSeries":[', '"timeSeries":[null,'),
]

KINDS = {
    "weather": (extract.parsed_weather, extract.weather_rows, extract.weather_observations, schemas.WEATHER_SHAPE),
    "situations": (extract.parsed_situations, extract.situation_rows, extract.situations, schemas.SITUATION_SHAPE),
    "frost": (extract.parsed_frost, extract.frost_rows, extract.frost_depths, schemas.FROST_SHAPE),
}


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("kind", KINDS)
def test_rows_and_faults_of_one_parse(spark, kind):
    parse, flatten, whole, shape = KINDS[kind]
    df = landed(spark, *ODD).withColumn(
        "status", F.when(F.col("payload_id").isin("p3", "p20"), 500).otherwise(200)
    ).cache()
    parsed = parse(df).cache()
    assert "body" not in parsed.columns
    assert rows(flatten(parsed.where("_answered"))) == rows(whole(answered(df)))
    assert rows(listed_faults(parsed)) == rows(quarantined(df, shape))
    assert len(rows(listed_faults(parsed))) > 10


def test_forecasts_of_one_parse(spark):
    df = landed(spark, *ODD).withColumn("location_id", F.when(F.col("payload_id") == "p2", "X").otherwise("MP001")).cache()
    places = default_locations(spark)
    parsed = extract.parsed_forecasts(df).cache()
    assert rows(extract.forecast_rows(parsed.where("_answered"), places)) == rows(extract.point_forecasts(answered(df), places))
    assert rows(listed_faults(parsed)) == rows(quarantined(df, schemas.FORECAST_SHAPE))
    assert rows(parsed_errors(parsed, places)) == rows(location_errors(df, places))


def test_good_payloads_are_parsed_by_one_expression(spark):
    plan = extract.parsed_weather(landed(spark, WEATHER))._jdf.queryExecution().optimizedPlan().toString()
    head = plan[: plan.index("LogicalRDD")] if "LogicalRDD" in plan else plan
    # Of the others only where a body is not fine, inside a branch.
    parsing = [line for line in head.split("\n") if "from_json" in line and "CASE WHEN" not in line]
    assert len(parsing) == 1 and parsing[0].count("from_json") == 1
