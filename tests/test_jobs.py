"""The scheduled jobs one after the other, from landed text to what readers see."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadcast import __main__ as command
from roadcast import schemas
from roadcast.operators.lag import LAG_ROWS
from roadcast.plans import jobs
from roadcast.plans.refresh import total_rows
from roadcast.plans.training import Settings
from roadcast.queries.ingest import (
    _ALIAS,
    FORECAST_BODY,
    FROST_BODY,
    SITUATION_BODY,
    WEATHER_BODY,
    _landed,
)
from roadcast.sources.tables import read_table

SPECS = (
    schemas.WEATHER_OBSERVATION, schemas.SITUATION, schemas.FROST_DEPTH,
    schemas.POINT_FORECAST, schemas.PREDICTION,
)
NOW = dt.datetime(2024, 1, 28, 0, 20)


@pytest.fixture(scope="module")
def landing(spark, sf_dir, tmp_path_factory):
    for spec in SPECS:
        spark.sql(f"DROP TABLE IF EXISTS {spec.table}")
    root = str(tmp_path_factory.mktemp("landing"))
    for name, body in (("weather", WEATHER_BODY), ("situations", SITUATION_BODY), ("frost_depth", FROST_BODY)):
        _landed(spark, sf_dir, body).select("body").write.text(f"{root}/{name}")
    forecasts = _landed(spark, sf_dir, FORECAST_BODY, f"{_ALIAS} as location_id")
    # A payload whose run time is unreadable would get the time it was landed here.
    readable = forecasts.where("payload_id % 4 <> 2").select("body", "location_id")
    readable.write.partitionBy("location_id").text(f"{root}/forecast")
    return root


def forget(spark):
    """Drop the tables from the catalog, as a new process with its own would not know
    them. Their data stays where it is."""
    for spec in SPECS:
        spark.sql(f"DROP TABLE IF EXISTS {spec.table}")


def test_jobs(spark, landing, tmp_path, capsys):
    models, tables = str(tmp_path / "models"), str(tmp_path / "tables")
    assert jobs.train(spark, models, tables=tables) == {}
    assert jobs.score(spark, models, NOW, tables=tables) is None
    assert jobs.serve(spark, NOW, tables=tables) == {}

    report = jobs.daily(spark, landing, json_lines=True, tables=tables)
    report = {r.source: r["rows"] for r in report.collect()}
    assert set(report) == {"weather", "situations", "frost_depth", "forecast"}
    before = {s.table: read_table(spark, s).count() for s in SPECS[:4]}
    assert sum(before.values()) == sum(report.values())

    forget(spark)
    again = jobs.backfill(spark, landing, json_lines=True, tables=tables)
    assert total_rows(again).first().total_rows == sum(report.values())
    assert {s.table: read_table(spark, s).count() for s in SPECS[:4]} == before

    forget(spark)
    quick = Settings(members=2, trees=1, depth=2, parallelism=2)
    assert set(jobs.train(spark, models, quick, tables=tables)) == {24, 48}
    audit = {r.side: r["rows"] for r in spark.read.parquet(f"{models}/audit").collect()}
    assert audit["forecast"] == before[schemas.POINT_FORECAST.table]
    trained = spark.read.parquet(f"{models}/coverage").first()
    assert 0 < trained.matched <= trained["rows"]

    forget(spark)
    counts = jobs.score(spark, models, NOW, tables=tables).first()
    stored = read_table(spark, schemas.PREDICTION)
    assert sum(counts) == stored.count() > 0
    assert spark.read.parquet(f"{models}/scored-coverage").first()["rows"] == stored.count()
    assert spark.read.parquet(f"{models}/scored-audit").count() == 2
    assert jobs.score(spark, models, NOW, tables=tables).first() == counts
    assert read_table(spark, schemas.PREDICTION).count() == stored.count()

    forget(spark)
    seen = jobs.serve(spark, NOW, horizon=24, tables=tables)
    plan = seen["figures"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    figures = seen["figures"].first()
    assert figures.points >= 1
    assert seen["recommendations"].count() == figures.points
    assert seen["map"].count() == seen["timeline"].count() > 0

    command.main(["serve", "--now", NOW.isoformat(), "--horizon", "24", "--tables", tables])
    command.main(["score", "--now", NOW.isoformat(), "--models", models, "--tables", tables])
    shown = capsys.readouterr().out
    assert "recommendations" in shown and "medium" in shown
    forget(spark)


def test_lags_of_landed_weather(spark, landing):
    rows = jobs.weather_with_lags(spark, landing, json_lines=True)
    assert {f"air_rh_lag_{n}h" for n in LAG_ROWS} <= set(rows.columns)
    assert rows.where(F.col("air_rh_lag_1h").isNotNull()).count() > 0
