"""Training rows kept up with the stored tables, date by date.

The rows are a table of their own, by the forecasts' valid date. An update asks the
manifests which dates of the two source tables have changed since the versions the rows
were made from, and makes anew the dates that this can reach:

* valid dates with other forecasts, or with other observations, from which the labels come;
* valid dates with a run whose latest observation lies on a changed date. (Stored keys do
  not go, so if it lies on another date it is the one it was.)

On which date a run's latest observation lies is told by a table of each point's first
observation time per date: it is the last of these that is not after the run. So neither
that question nor the as-of join reads observations of other dates.

The versions are noted once the rows are stored. A run that dies before makes the same
dates again. Where an old version has expired, everything is made anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadcast import schemas
from roadcast.operators.asof import FLAGS, OBSERVED, latest_before
from roadcast.plans.dataset import training_dataset
from roadcast.plans.features import run_or_fallback
from roadcast.schemas import TableSpec
from roadcast.session import read_note, write_note
from roadcast.sources import snapshots
from roadcast.sources.tables import (
    _utc_date,
    ensure_table,
    on_dates,
    read_table,
    replace_dates,
    table_location,
    table_versions,
)

_KINDS = {"sample_time": "TIMESTAMP"} | {c: "INT" for c in FLAGS}
TRAINING_ROWS = TableSpec(
    name="training_row",
    version=1,
    primary_key=("measurepoint_id", "forecast_run_time", "valid_time"),
    event_time="valid_time",
    columns=schemas.POINT_FORECAST.columns
    + ", horizon_hours BIGINT, hazard INT, obs_age_minutes DOUBLE, "
    + ", ".join(f"{to} {_KINDS.get(c, 'DOUBLE')}" for c, to in OBSERVED.items())
    + ", hour INT, day_of_week INT, month INT, is_rush_hour INT, is_weekend INT",
    description="Forecasts with their latest observation and what came of them",
)
FIRST_TIMES = TableSpec(
    name="observation_first_time",
    version=1,
    primary_key=("measurepoint_id", "first_time"),
    event_time="first_time",
    columns="measurepoint_id BIGINT, first_time TIMESTAMP",
    description="When each point was first observed on each date",
)


def _first_times(observations: DataFrame) -> DataFrame:
    timed = observations.where("measurepoint_id is not null and sample_time is not null")
    per_date = timed.groupBy("event_date", "measurepoint_id").agg(F.min("sample_time").alias("first_time"))
    return per_date.select("measurepoint_id", "first_time")


def _dates_seen(forecasts: DataFrame, first_times: DataFrame) -> DataFrame:
    """Of forecasts with ``event_date``, the date of their run's latest observation:
    ``event_date, seen``, without runs before any observation.

    Runs of one point and day see that day, once it has its first observation, or the one
    observed before it. So the first and the last of them see all that any of them does,
    and only these are looked up."""
    time = F.col("_time")
    runs = forecasts.select("event_date", "measurepoint_id", run_or_fallback(forecasts).alias("_time"))
    runs = (
        runs.where("measurepoint_id is not null and _time is not null")
        .groupBy("event_date", "measurepoint_id", _utc_date(time))
        .agg(F.array(F.min(time), F.max(time)).alias("_ends"))
        .select("event_date", "measurepoint_id", F.explode("_ends").alias("_time"))
        .distinct()
    )
    seen = first_times.select(
        "measurepoint_id", F.col("first_time").alias("_time"), F.struct(F.col("event_date").alias("seen")).alias("_value")
    )
    ids = runs.select("measurepoint_id").unionByName(seen.select("measurepoint_id"))
    found = latest_before(runs.select("measurepoint_id", "_time").distinct(), seen, counted=ids)
    joined = runs.join(found, ["measurepoint_id", "_time"])
    return joined.select("event_date", F.col("_value.seen").alias("seen")).where("seen is not null").distinct()


def _dates(df: DataFrame, column: str) -> list:
    return [r[0] for r in df.select(column).distinct().collect()]


def update_training_rows(
    spark: SparkSession,
    forecasts: TableSpec = schemas.POINT_FORECAST,
    observations: TableSpec = schemas.WEATHER_OBSERVATION,
    rows: TableSpec = TRAINING_ROWS,
    first_times: TableSpec = FIRST_TIMES,
    *,
    location: str | None = None,
) -> list:
    """Bring the training rows up to date with the stored tables; returns the valid dates
    that were made anew. New tables go under ``location``."""
    for spec in (rows, first_times):
        ensure_table(spark, spec, location=f"{location}/{spec.table}" if location else None)
    note = f"{table_location(spark, rows)}/_state/made-from"
    old = [int(n) for n in (read_note(spark, note) or "").split()]
    roots = [table_location(spark, s) for s in (forecasts, observations)]
    now = [snapshots.latest(spark, root) for root in roots]
    known = [table_versions(spark, s) for s in (forecasts, observations)]
    if not (old and all(v == 0 or v in have for v, have in zip(old, known))):
        old = [0, 0]  # compared with tables without rows, all dates have changed
    changed_fc, changed_obs = (
        snapshots.changed_dates(spark, spec, root, a, b)
        for spec, root, a, b in zip((forecasts, observations), roots, old, now)
    )
    fc, obs = (
        read_table(spark, spec, with_date=True, version=v or None) for spec, v in zip((forecasts, observations), now)
    )
    if changed_obs:
        replace_dates(spark, first_times, _first_times(on_dates(obs, changed_obs)), changed_obs)
    firsts = read_table(spark, first_times, with_date=True)
    dates = {*changed_fc, *changed_obs}
    days = [d for d in changed_obs if d is not None]
    if days and old != [0, 0]:
        later = fc.where(run_or_fallback(fc) >= F.lit(min(days)).cast("timestamp"))
        reached = _dates_seen(later, firsts).where(F.col("seen").isin(*days))
        dates |= {*_dates(reached, "event_date")}
    if dates:
        _make(spark, rows, fc, obs, firsts, sorted(dates, key=str))
    write_note(spark, note, f"{now[0]} {now[1]}")
    return sorted(dates, key=str)


def _make(
    spark: SparkSession, rows: TableSpec, fc: DataFrame, obs: DataFrame, firsts: DataFrame, dates: Sequence
) -> None:
    """Make the rows of some valid dates. Of the observations, those of these dates count
    for the labels, and those of the dates their runs see for the as-of join."""
    fc = on_dates(fc, dates)
    seen = _dates(_dates_seen(fc, firsts), "seen")
    obs = on_dates(obs, list({*dates, *seen}))
    made = training_dataset(fc.drop("event_date"), obs.drop("event_date"), unique_keys=True)
    replace_dates(spark, rows, made, dates)
