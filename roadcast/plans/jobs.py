"""The scheduled jobs, from landed payloads to predictions and what readers see.

``landing`` holds one folder per source: ``weather``, ``situations``, ``frost_depth``
and ``forecast/location_id=<id>``. Folders that are absent are not polled.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadcast import schemas
from roadcast.functions.times import HORIZON_WINDOW_HOURS, floor_hour
from roadcast.operators.audit import counting_coverage, zones_join_audit
from roadcast.operators.dedup import keep_last
from roadcast.operators.lag import with_lags
from roadcast.operators.serving import (
    at_horizon,
    key_figures,
    map_points,
    risk_buckets,
    timeline,
)
from roadcast.plans.dataset import has_rows, training_dataset
from roadcast.plans.incremental import TRAINING_ROWS, update_training_rows
from roadcast.plans.refresh import Feed, landing_feeds, refresh
from roadcast.plans.scoring import (
    features_to_score,
    predict,
    prediction_rows,
    reaching_back,
    store_predictions,
)
from roadcast.plans.serving import current_predictions, recommendation_list
from roadcast.plans.training import (
    Ensemble,
    Settings,
    append_metrics,
    load_ensemble,
    save_ensemble,
    train_all,
)
from roadcast.schemas import HORIZONS, TableSpec
from roadcast.session import path_exists, remove_path, scratch_path, use_utc
from roadcast.sources.extract import weather_observations
from roadcast.sources.landing import answered, read_landing
from roadcast.sources.ledger import new_files
from roadcast.sources.locations import default_locations, read_locations
from roadcast.sources.tables import ensure_table, read_table, table_zones


# Each has a folder of its name in the landing.
SOURCES = ("weather", "situations", "frost_depth", "forecast")


def _locations(spark: SparkSession, path: str | None) -> DataFrame:
    return read_locations(spark, path) if path else default_locations(spark)


def _feeds(
    spark: SparkSession,
    landing: str,
    locations: str | None,
    json_lines: bool,
    ledger: str | None,
    suffix: str = "",
) -> tuple[list[Feed], list[str]]:
    """The feeds of the folders there are, and the sources without anything new in the
    ledger's eyes."""
    use_utc(spark)
    found, intakes = {}, {}
    for source in SOURCES:
        path = f"{landing}/{source}"
        if not path_exists(spark, path):
            continue
        if ledger is None:
            found[source] = read_landing(spark, path, json_lines=json_lines)
            continue
        intake = intakes[source] = new_files(spark, ledger, source, path)
        if intake.count:
            landed = read_landing(spark, path, json_lines=json_lines, only=intake.only())
            found[source] = intake.of(landed)
    feeds = landing_feeds(
        weather=found.get("weather"),
        situations=found.get("situations"),
        frost=found.get("frost_depth"),
        forecasts=found.get("forecast"),
        locations=_locations(spark, locations),
        suffix=suffix,
    )
    feeds = [replace(f, done=intakes[f.name].record) if f.name in intakes else f for f in feeds]
    return feeds, [source for source, intake in intakes.items() if not intake.count]


def _ledger(tables: str | None, ledger: str | None) -> str | None:
    return ledger or (f"{tables}/_ingest_ledger" if tables else None)


def daily(
    spark: SparkSession,
    landing: str,
    *,
    locations: str | None = None,
    json_lines: bool = False,
    tables: str | None = None,
    quarantine: str | None = None,
    ledger: str | None = None,
    suffix: str = "",
) -> DataFrame:
    """Bring all tables up to date; returns the report. Landed files that an earlier run
    took in are not read again: ``ledger``, beside the tables unless told otherwise,
    remembers them. Without either everything is read. Of a run with a ledger the
    quarantine has a folder of its own. ``suffix`` is added to the table names."""
    ledger = _ledger(tables, ledger)
    feeds, idle = _feeds(spark, landing, locations, json_lines, ledger, suffix)
    if ledger and quarantine:
        runs = "+".join(sorted(f.done.__self__.run for f in feeds))
        quarantine = f"{quarantine}/run={hashlib.sha256(runs.encode()).hexdigest()[:16]}"
    return refresh(spark, feeds, location=tables, quarantine=quarantine, idle=idle)


def backfill(
    spark: SparkSession,
    landing: str,
    *,
    locations: str | None = None,
    json_lines: bool = False,
    tables: str | None = None,
    quarantine: str | None = None,
) -> DataFrame:
    """The same in bulk and of all landed files: weather rows get their lags and are then
    cut to the columns the table has."""
    feeds, _ = _feeds(spark, landing, locations, json_lines, None)
    feeds = [
        replace(feed, rows=lambda *parsed, feed=feed: _lagged(feed.rows(*parsed))) if feed.name == "weather" else feed
        for feed in feeds
    ]
    return refresh(spark, feeds, align=True, location=tables, quarantine=quarantine)


def _lagged(weather: DataFrame) -> DataFrame:
    """Lags over the last copy of each reading: landed payloads overlap, and a repeated
    reading is not an earlier one."""
    return with_lags(keep_last(weather, schemas.WEATHER_OBSERVATION.primary_key))


def weather_with_lags(spark: SparkSession, landing: str, *, json_lines: bool = False) -> DataFrame:
    """Landed weather rows with their lags, for use outside the stored table."""
    use_utc(spark)
    landed = read_landing(spark, f"{landing}/weather", json_lines=json_lines)
    return _lagged(weather_observations(answered(landed)))


def _stored(
    spark: SparkSession, spec: TableSpec, tables: str | None, *, with_date: bool = False
) -> DataFrame | None:
    """The stored table, or None. One under ``tables`` that this catalog does not know
    yet is taken in first."""
    place = f"{tables}/{spec.table}" if tables else None
    if not spark.catalog.tableExists(spec.table):
        if place is None or not path_exists(spark, place):
            return None
        ensure_table(spark, spec, location=place)
    return read_table(spark, spec, with_date=with_date)


def train(
    spark: SparkSession,
    models: str,
    settings: Settings = Settings(),
    *,
    tables: str | None = None,
    incremental: bool = False,
) -> dict[int, Ensemble]:
    """Train, evaluate and save an ensemble per horizon from the stored tables; none
    when a table is missing or empty. Stored keys are unique, so no dedup is needed. With
    ``incremental`` the training rows are a stored table, too, of which only the dates are
    made anew that changes since the last run can reach.
    What the joins read and matched is appended to ``audit`` and ``coverage`` there."""
    use_utc(spark)
    forecasts = _stored(spark, schemas.POINT_FORECAST, tables)
    observations = _stored(spark, schemas.WEATHER_OBSERVATION, tables)
    if forecasts is None or observations is None or not has_rows(forecasts, observations):
        return {}
    zones = (table_zones(spark, s) for s in (schemas.POINT_FORECAST, schemas.WEATHER_OBSERVATION))
    zones_join_audit(*zones).write.mode("append").parquet(f"{models}/audit")
    if incremental:
        update_training_rows(spark, location=tables)
        dataset = read_table(spark, TRAINING_ROWS)
    else:
        dataset = training_dataset(forecasts, observations, unique_keys=True)
    ensembles = train_all(dataset, settings, coverage=f"{models}/coverage")
    for horizon, ensemble in ensembles.items():
        save_ensemble(spark, ensemble, f"{models}/h{horizon}")
    if ensembles:
        append_metrics(spark, list(ensembles.values()), f"{models}/metrics")
    return ensembles


def score(
    spark: SparkSession,
    models: str,
    now: dt.datetime,
    *,
    tables: str | None = None,
    fallback_csv: str | None = None,
    lookback_days: int = 30,
) -> DataFrame | None:
    """Score the stored forecasts of the coming 72 hours and store the predictions;
    returns high, medium and low counts, or None without models or forecasts.
    ``lookback_days`` changes what is read, not the result. What the tables hold, of the
    forecasts on the dates to come, and what the join matched is appended to
    ``scored-audit`` and ``scored-coverage`` beside the models."""
    use_utc(spark)
    ensembles = {
        h: load_ensemble(spark, f"{models}/h{h}")
        for h in HORIZONS
        if path_exists(spark, f"{models}/h{h}")
    }
    forecasts = _stored(spark, schemas.POINT_FORECAST, tables, with_date=True)
    if not ensembles or forecasts is None:
        return None
    start = floor_hour(now)
    end = start + dt.timedelta(hours=HORIZON_WINDOW_HOURS)
    # The dates repeat the valid-time filter in a form that prunes partitions.
    coming = forecasts.where(F.col("event_date").between(start.date(), end.date()))
    coming = coming.drop("event_date")
    observations = _stored(spark, schemas.WEATHER_OBSERVATION, tables, with_date=True)
    if observations is not None:
        features = features_to_score(coming, now)
        observations = reaching_back(features, observations, lookback_days)
        zones = table_zones(spark, schemas.POINT_FORECAST)
        zones = zones.where(F.col("event_date").between(start.date(), end.date()))
        audit = zones_join_audit(zones, table_zones(spark, schemas.WEATHER_OBSERVATION))
        audit.write.mode("append").parquet(f"{models}/scored-audit")
    # Joined once and scored once: the horizons read the one copy, the store and the
    # counts the other.
    joined, path = scratch_path(spark, "rows-to-score"), scratch_path(spark, "predictions")
    try:
        found, counted = counting_coverage(prediction_rows(coming, observations, now, unique_keys=True))
        found.write.parquet(joined)
        rows = spark.read.parquet(joined)
        counted(spark).write.mode("append").parquet(f"{models}/scored-coverage")
        predict(rows, ensembles).write.parquet(path)
        predictions = spark.read.parquet(path)
        place = f"{tables}/{schemas.PREDICTION.table}" if tables else None
        store_predictions(spark, predictions, fallback_csv, location=place)
        counts = risk_buckets(predictions)
        return spark.createDataFrame(counts.collect(), counts.schema)
    finally:
        remove_path(spark, joined)
        remove_path(spark, path)


def serve(
    spark: SparkSession,
    now: dt.datetime,
    *,
    horizon: int | None = None,
    locations: str | None = None,
    tables: str | None = None,
) -> dict[str, DataFrame]:
    """What readers see of the stored predictions: key figures, map points, the
    recommendation list and the timelines. Empty when there are none."""
    use_utc(spark)
    places = _locations(spark, locations)
    stored = _stored(spark, schemas.PREDICTION, tables, with_date=True)
    if stored is None:
        return {}
    # The newest run is that of all rows, told by the zones without reading them; then
    # only the dates that can be shown are read, however often.
    newest = table_zones(spark, schemas.PREDICTION).agg(F.max("last_run").alias("run"))
    newest = newest.select(F.unix_micros("run").alias("micros")).first().micros
    start = floor_hour(now)
    end = start + dt.timedelta(hours=HORIZON_WINDOW_HOURS)
    coming = stored.where(F.col("event_date").between(start.date(), end.date())).drop("event_date")
    run = F.timestamp_micros(F.lit(newest).cast("bigint"))
    current = at_horizon(current_predictions(coming, places, now, newest=run), horizon)
    return {
        "figures": key_figures(current),
        "map": map_points(current, places),
        "recommendations": recommendation_list(current, places, order="horizon_hours"),
        "timeline": timeline(current),
    }
