"""Runs that read only what earlier ones did not."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from roadcast import schemas
from roadcast.plans import jobs, refresh as refresh_module
from roadcast.sources import ledger as ledger_module
from roadcast.sources.landing import read_landing
from roadcast.sources.ledger import new_files, read_ledger
from roadcast.sources.tables import read_table, table_versions
from test_extract import FORECAST, FROST, WEATHER

SPECS = (schemas.WEATHER_OBSERVATION, schemas.SITUATION, schemas.FROST_DEPTH, schemas.POINT_FORECAST)


@pytest.fixture
def place(spark, tmp_path):
    for spec in SPECS:
        spark.sql(f"DROP TABLE IF EXISTS {spec.table}")
    for folder in ("weather", "frost_depth", "forecast/location_id=MP001"):
        (tmp_path / "landing" / folder).mkdir(parents=True)
    yield tmp_path
    for spec in SPECS:
        spark.sql(f"DROP TABLE IF EXISTS {spec.table}")


def put(place, name, body, time):
    path = place / "landing" / name
    path.write_text(body)
    os.utime(path, (time, time))


def run(spark, place, **options):
    report = jobs.daily(spark, str(place / "landing"), tables=str(place / "tables"), **options)
    return sorted(((r.source, r["rows"], r.error) for r in report.collect()), key=repr)


def entered(spark, place):
    rows = read_ledger(spark, str(place / "tables" / "_ingest_ledger")).collect()
    return sorted((r.source, r.file.rpartition("/")[2], r.payloads, r.rejected, r.outcome) for r in rows)


def frost_values(spark):
    return sorted(r.temp_c for r in read_table(spark, schemas.FROST_DEPTH).collect())


def test_only_new_and_changed_files_are_read(spark, place, monkeypatch):
    put(place, "weather/a.json", WEATHER, 1_700_000_000)
    put(place, "weather/b.json", "<html>", 1_700_000_000)
    put(place, "frost_depth/a.json", FROST, 1_700_000_000)
    put(place, "frost_depth/empty.json", " \n", 1_700_000_000)
    put(place, "forecast/location_id=MP001/a.json", FORECAST, 1_700_000_000)
    first = run(spark, place, quarantine=str(place / "bad"))
    assert [(s, n) for s, n, e in first if e is None] == [("forecast", 1), ("frost_depth", 2), ("weather", 2)]
    assert ("weather", None, "not JSON") in first
    assert entered(spark, place) == [
        ("forecast", "a.json", 1, 0, "stored"), ("frost_depth", "a.json", 1, 0, "stored"),
        ("frost_depth", "empty.json", 1, 1, "with rejects"), ("weather", "a.json", 1, 0, "stored"),
        ("weather", "b.json", 1, 1, "with rejects"),
    ]
    opened = []
    monkeypatch.setattr(jobs, "read_landing", lambda *a, **k: opened.append(a) or read_landing(*a, **k))
    versions = {s.table: table_versions(spark, s) for s in SPECS if spark.catalog.tableExists(s.table)}
    assert run(spark, place) == [("forecast", 0, None), ("frost_depth", 0, None), ("weather", 0, None)]
    assert opened == []  # nothing new: no file is planned
    assert versions == {s.table: table_versions(spark, s) for s in SPECS if spark.catalog.tableExists(s.table)}

    put(place, "frost_depth/a.json", FROST.replace("0.7", "0.75"), 1_700_000_600)
    put(place, "frost_depth/c.json", FROST.replace("226", "227"), 1_700_000_600)
    assert run(spark, place) == [("forecast", 0, None), ("frost_depth", 4, None), ("weather", 0, None)]
    assert len(opened) == 1
    assert frost_values(spark) == [0.7, 0.75, 1.1, 1.1]
    assert len(entered(spark, place)) == 7


@pytest.mark.parametrize("most_named", [0, 10])
def test_a_changed_file_is_read_alone(spark, place, monkeypatch, most_named):
    monkeypatch.setattr(ledger_module, "MOST_NAMED", most_named)
    for k in range(6):
        put(place, f"frost_depth/{k}.json", FROST.replace("226", str(300 + k)), 1_700_000_000)
    run(spark, place)
    put(place, "frost_depth/3.json", FROST.replace("226", "303").replace("0.7", "9.5"), 1_700_000_900)
    intake = new_files(spark, str(place / "tables" / "_ingest_ledger"), "frost_depth", str(place / "landing" / "frost_depth"))
    assert [r.file.rpartition("/")[2] for r in intake.files.collect()] == ["3.json"]
    text = spark.read.text(str(place / "landing" / "frost_depth"), wholetext=True).where(intake.only())
    text.collect()
    plan = text._jdf.queryExecution().executedPlan()
    while plan.children().nonEmpty() and "FileSourceScan" not in plan.getClass().getName():
        plan = plan.children().head()
    assert plan.metrics().apply("numFiles").value() == 1
    run(spark, place)
    assert frost_values(spark) == [0.7] * 5 + [1.1] * 6 + [9.5]


@pytest.mark.parametrize("json_lines", [False, True])
def test_a_run_that_dies_before_the_ledger_repeats_without_a_wrong_row(spark, place, monkeypatch, json_lines):
    put(place, "frost_depth/a.json", FROST, 1_700_000_000)
    put(place, "frost_depth/b.json", "<html>", 1_700_000_000)

    def lost(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(ledger_module.Intake, "record", lost)
    bad = str(place / "bad")
    assert ("frost_depth", None, "driver lost") in run(spark, place, quarantine=bad, json_lines=json_lines)
    assert entered(spark, place) == [] and frost_values(spark) == [0.7, 1.1]
    monkeypatch.undo()
    assert ("frost_depth", 2, None) in run(spark, place, quarantine=bad, json_lines=json_lines)
    assert frost_values(spark) == [0.7, 1.1]
    assert [r.body for r in spark.read.parquet(f"{bad}/*/frost_depth").collect()] == ["<html>"]
    assert run(spark, place, json_lines=json_lines) == [("forecast", 0, None), ("frost_depth", 0, None), ("weather", 0, None)]


def test_a_source_that_fails_is_not_entered(spark, place, monkeypatch):
    put(place, "frost_depth/a.json", FROST, 1_700_000_000)
    put(place, "weather/a.json", WEATHER, 1_700_000_000)
    real = refresh_module.upsert

    def some(spark, spec, rows):
        if spec.name == schemas.WEATHER_OBSERVATION.name:
            raise OSError("disk full")
        return real(spark, spec, rows)

    monkeypatch.setattr(refresh_module, "upsert", some)
    assert ("weather", None, "disk full") in run(spark, place)
    assert [e[0] for e in entered(spark, place)] == ["frost_depth"]
    monkeypatch.undo()
    assert ("weather", 2, None) in run(spark, place)
    assert [e[0] for e in entered(spark, place)] == ["frost_depth", "weather"]


def test_the_ledger_may_lie_elsewhere(spark, place):
    put(place, "frost_depth/a.json", FROST, 1_700_000_000)
    other = str(place / uuid.uuid4().hex)
    assert ("frost_depth", 2, None) in run(spark, place, ledger=other)
    assert read_ledger(spark, other).where(F.col("outcome") == "stored").count() == 1
    assert ("frost_depth", 2, None) in run(spark, place)
