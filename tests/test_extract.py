"""Extraction and landing on hand-written payloads."""

import datetime as dt
import json

from pyspark.sql import functions as F

from roadcast import schemas
from roadcast.operators.dedup import keep_last
from roadcast.sources import extract
from roadcast.sources.forecasts import location_errors, location_forecasts
from roadcast.sources.landing import answered, quarantined, read_landing, with_verdict
from roadcast.sources.locations import all_entries, default_locations, locations, read_locations

WEATHER = """{"RESPONSE":{"RESULT":[{"WeatherObservation":[{"Measurepoint":{"Id":"243","Name":"E4 Norrtull","Geometry":{"WGS84":"POINT (18.05 59.357)"}},"Sample":"2024-01-01T05:00:00.000+01:00","Surface":{"Temperature":{"Value":-1.5},"Water":false,"Ice":true,"Snow":"true","Grip":{"Value":"0.41"}},"Air":{"Temperature":{"Value":-0.4},"RelativeHumidity":{"Value":91.0},"Dewpoint":{"Value":-1.7}}},{"Measurepoint":null,"Sample":"bad","Surface":null,"Air":{"Temperature":null}},{"Measurepoint":{"Id":5.5}}]}]}}"""
SITUATION = """{"RESPONSE":{"RESULT":[{"Situation":[{"Id":"S1","PublicationTime":"2024-01-01T00:00:00Z","VersionTime":"2024-01-01T00:10:00Z","Deviation":[{"MessageType":"Roadwork","StartTime":"2024-01-01T00:00:00Z","Suspended":false,"Geometry":{"Point":{"WGS84":"POINT (18 59)"}}},{"MessageType":"Accident","Geometry":null}]},{"Id":"S2","Deviation":null}]}]}}"""
FROST = """{"RESPONSE":{"RESULT":[{"FrostDepthObservation":[{"Measurepoint":{"Id":226,"Name":"P"},"FrostDepth":{"Sample":"2024-01-01T00:00:00Z","Temperature":[{"SensorName":"a","Depth":10,"Value":0.5},{"SensorName":"b","Depth":10,"Value":0.7},{"SensorName":"c","Depth":20,"Value":1.1}]}}]}]}}"""
FORECAST = """{"approvedTime":"","referenceTime":"2024-01-01T00:05:00Z","timeSeries":[{"validTime":"2024-01-02T00:00:00Z","parameters":[{"name":"t","values":[1.0]},{"name":"t","values":[2.0]},{"name":"ws","values":[]},{"name":"r","values":[88]}]}]}"""

INGESTED = dt.datetime(2024, 1, 1, 6)


def landed(spark, *bodies, **extra):
    rows = [(b, f"p{i}", *extra.values()) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "body STRING, payload_id STRING" + "".join(f", {k} STRING" for k in extra))
    return df.withColumn("ingested_at", F.lit("2024-01-01 06:00:00").cast("timestamp"))


def ntz(df):
    return df.select(
        *[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else f.name
          for f in df.schema]
    )


def test_weather(spark):
    rows = ntz(extract.weather_observations(landed(spark, WEATHER))).orderBy("_seq").collect()
    assert len(rows) == 2
    first, second = (r.asDict() for r in rows)
    assert first["measurepoint_id"] == 243
    assert first["sample_time"] == dt.datetime(2024, 1, 1, 4)
    assert (first["surface_temp_c"], first["surface_grip"], first["dewpoint_c"]) == (-1.5, 0.41, -1.7)
    assert (first["surface_water"], first["surface_ice"], first["surface_snow"]) == ("false", "true", "true")
    assert second["measurepoint_id"] is None and second["sample_time"] is None
    assert second["ingested_at"] == INGESTED


def test_fractional_id_is_held_back(spark):
    rows = extract.fractional_ids(landed(spark, WEATHER)).collect()
    assert [r.measurepoint_id for r in rows] == ["5.5"]


def test_situations_and_their_key(spark):
    rows = extract.situations(landed(spark, SITUATION))
    assert [r.message_type for r in rows.orderBy("_seq").collect()] == ["Roadwork", "Accident"]
    kept = keep_last(rows, schemas.SITUATION.primary_key).collect()
    assert [(r.situation_id, r.message_type) for r in kept] == [("S1", "Accident")]


def test_frost_and_its_key(spark):
    rows = extract.frost_depths(landed(spark, FROST))
    kept = keep_last(rows, schemas.FROST_DEPTH.primary_key).orderBy("depth_cm").collect()
    assert [(r.depth_cm, r.sensor_name, r.temp_c) for r in kept] == [(10.0, "b", 0.7), (20.0, "c", 1.1)]


def test_forecast(spark):
    df = landed(spark, FORECAST, location_id="MP001")
    row = ntz(extract.point_forecasts(df, default_locations(spark))).first()
    assert (row.measurepoint_id, row.lat, row.lon) == (243, 59.357, 18.05)
    assert row.forecast_run_time == dt.datetime(2024, 1, 1, 0, 5)
    assert (row.t_air_c, row.precip_mm, row.wind_ms, row.rh) == (2.0, None, None, 88.0)


def test_unreadable_first_run_time_gives_ingest_time(spark):
    body = FORECAST.replace('"approvedTime":""', '"approvedTime":"soon"')
    df = landed(spark, body, location_id="MP001")
    assert ntz(extract.point_forecasts(df, default_locations(spark))).first().forecast_run_time == INGESTED


def test_last_of_a_payload_wins_across_payloads(spark):
    newer = FROST.replace("0.7", "0.9")
    df = landed(spark, FROST, newer)
    kept = keep_last(extract.frost_depths(df), schemas.FROST_DEPTH.primary_key)
    assert kept.where("depth_cm = 10").first().temp_c == 0.9


def accepted(df):
    return with_verdict(df).where("reject_reason is null")


BODIES = {
    "good": '{"a": 1}',
    "repeated": '{"a": 1, "a": 2}',
    "nan": '{"a": NaN}',
    "spaced": ' {"a": 1}\n',
    "empty": "",
    "blank": " \n ",
    "missing": None,
    "html": "<html><body>no</body></html>",
    "cut": '{"RESPONSE": {"RESULT": [',
    "left over": '{"a": 1} x',
    "two": '{"a": 1}{"b": 2}',
    "listed": '{"a": 1},{"b": 2}',
    "closed early": '{"a": 1}] trailing junk',
    "two lists": '{"a": 1}],[{"b": 2}',
    "marked": '{"a": 1},{"__end": "1"}',
    "array": '[{"a": 1}]',
    "number": "1",
    "null": "null",
}


def test_verdicts(spark):
    df = spark.createDataFrame(list(BODIES.items()), "payload_id STRING, body STRING")
    good = {r.payload_id for r in accepted(df).collect()}
    assert good == {"good", "repeated", "nan", "spaced"}
    bad = {r.payload_id: r.reject_reason for r in quarantined(df).collect()}
    assert set(bad) == set(BODIES) - good
    assert {k for k, v in bad.items() if v == "empty body"} == {"empty", "blank", "missing"}


def test_verdict_head_and_response(spark):
    df = spark.createDataFrame(
        [("{}", 200, "application/json"), ("{}", 500, "application/json"), ("{}", 200, "text/html"),
         ("x" * 3000, 200, "application/json")],
        "body STRING, status INT, content_type STRING",
    )
    assert accepted(df).count() == 1
    assert answered(df).count() == 2
    rows = quarantined(df).collect()
    assert sorted(r.reject_reason for r in rows) == ["content type is not JSON", "error status", "not JSON"]
    assert max(len(r.body) for r in rows) == 3000


def test_bad_bodies_yield_no_rows(spark):
    bad = [b for b in BODIES.values()] + [WEATHER[:-3], WEATHER + "x"]
    assert extract.weather_observations(landed(spark, *bad)).count() == 0


def faults(spark, shape, *bodies):
    rows = quarantined(landed(spark, *bodies), shape).orderBy("payload_id", "reject_reason").collect()
    return [(r.payload_id, r.reject_reason, r.body) for r in rows]


def test_good_items_beside_bad_ones(spark):
    item = json.loads(WEATHER)["RESPONSE"]["RESULT"][0]["WeatherObservation"][0]
    mixed = {"RESPONSE": {"RESULT": ["x", {"WeatherObservation": [1, item, None, "bad", item]}, {}, None]}}
    body = json.dumps(mixed)
    rows = extract.weather_observations(landed(spark, body)).orderBy("_seq").collect()
    assert [r.measurepoint_id for r in rows] == [243, 243]
    assert [int(r._seq) for r in rows] == [(1 << 31) + 1, (1 << 31) + 4]
    found = faults(spark, schemas.WEATHER_SHAPE, body)
    assert sorted(r[1:] for r in found) == sorted(
        [("an item of RESULT is not an object", "x"), ("an item of RESULT is not an object", "null")]
        + [("an item of WeatherObservation is not an object", b) for b in ("1", "null", "bad")]
    )


def test_mistyped_fields_are_faults_and_absent_ones_are_not(spark):
    bodies = ['{"RESPONSE": "oops"}', '{"RESPONSE": {"RESULT": {"a": 1}}}', "{}", '{"RESPONSE": null}',
              '{"RESPONSE": {"RESULT": []}}', '{"RESPONSE": {"RESULT": [{"Situation": 5}]}}',
              '{"RESPONSE": {"RESULT": [{"Situation": [{"Deviation": "x"}, {"Deviation": [3]}]}]}}']
    assert faults(spark, schemas.SITUATION_SHAPE, *bodies) == [
        ("p0", "RESPONSE is not an object", "oops"),
        ("p1", "RESULT is not an array", '{"a":1}'),
        ("p5", "Situation is not an array", "5"),
        ("p6", "Deviation is not an array", "x"),
        ("p6", "an item of Deviation is not an object", "3"),
    ]
    assert extract.situations(landed(spark, *bodies)).count() == 0
    assert faults(spark, schemas.FORECAST_SHAPE, FORECAST, '{"timeSeries": [{"parameters": {}}, 2]}') == [
        ("p1", "an item of timeSeries is not an object", "2"), ("p1", "parameters is not an array", "{}")
    ]
    assert faults(spark, schemas.FROST_SHAPE, FROST, FROST.replace('"FrostDepth":{', '"FrostDepth":7,"x":{')) == [
        ("p1", "FrostDepth is not an object", "7")
    ]


def test_places_in_large_arrays_keep_their_order(spark):
    rows = spark.createDataFrame([(0, 1 << 21), (1, 0), (0, (1 << 31) - 1)], "a INT, b INT")
    placed = rows.select("a", "b", extract._place("a", "b", "b")).orderBy("_seq").collect()
    assert [(r.a, r.b) for r in placed] == [(0, 1 << 21), (0, (1 << 31) - 1), (1, 0)]


def test_landing_folder(spark, tmp_path):
    for name, body in (("MP001", FORECAST), ("MP002", "<html>"), ("MP009", FORECAST)):
        folder = tmp_path / "fc" / f"location_id={name}"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text(body)
    df = read_landing(spark, str(tmp_path / "fc"))
    places = default_locations(spark).where("id in ('MP001', 'MP002', 'MP003')")
    assert {r.measurepoint_id for r in location_forecasts(df, places).collect()} == {243}
    errors = {(r.location_id, r.error) for r in location_errors(df, places).collect()}
    assert errors == {("MP002", "not JSON"), ("MP003", "no payload"), ("MP009", "unknown location")}


def test_lines_keep_file_order(spark, tmp_path):
    bodies = [FROST.replace("0.7", str(i)) for i in range(50)]
    (tmp_path / "lines.txt").write_text("\n".join(bodies))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = read_landing(spark, str(tmp_path / "lines.txt"), json_lines=True)
        assert df.rdd.getNumPartitions() > 1
        ordered = [r.body for r in df.orderBy("payload_id").collect()]
        kept = keep_last(extract.frost_depths(df), schemas.FROST_DEPTH.primary_key)
        assert ordered == bodies
        assert kept.where("depth_cm = 10").first().temp_c == 49.0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_locations(spark, tmp_path):
    entries = {
        "A": {"id": "A", "name": "Bridge", "latitude": 1.5, "longitude": 2, "tv_measurepoint_id": 7},
        "B": {"id": "B", "tv_measurepoint_id": "8"},
        "C": {"id": "C", "name": "nowhere"},
    }
    text = spark.createDataFrame([(json.dumps(entries),)], "value STRING")
    rows = locations(text).orderBy("id").collect()
    assert [(r.id, r.name, r.tv_measurepoint_id) for r in rows] == [("A", "Bridge", 7), ("B", "8", 8)]
    assert all_entries(text).count() == 3
    path = tmp_path / "places.json"
    path.write_text(json.dumps(entries))
    assert read_locations(spark, str(path)).count() == 2
    assert read_locations(spark, str(tmp_path / "absent.json")).count() == 5
    path.write_text("{}")
    assert read_locations(spark, str(path)).count() == 5
