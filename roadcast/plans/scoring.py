"""Forecasts to stored predictions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadcast.functions.risk import hazard_predicted, recommendation
from roadcast.functions.times import at_horizons, in_valid_window
from roadcast.operators.asof import (
    FORECAST_KEY,
    attach_latest_observation,
    condensed,
    without_observations,
)
from roadcast.operators.dedup import input_order, keep_last
from roadcast.operators.hotkeys import HOT_ROWS
from roadcast.operators.joins import skewproof_join
from roadcast.plans.features import forecast_features
from roadcast.plans.training import Ensemble, score
from roadcast.schemas import PREDICTION
from roadcast.sources.tables import ensure_table, upsert, write_csv


def features_to_score(forecasts: DataFrame, now: dt.datetime) -> DataFrame:
    return in_valid_window(at_horizons(forecast_features(forecasts)), now)


def reaching_back(features: DataFrame, observations: DataFrame, days: int) -> DataFrame:
    """The part of the stored observations (with ``event_date``) that scoring needs:
    those from ``days`` before the first run on, and the older ones of points that had
    none in those days before the run. Mostly there is no such point, and then the
    older partitions are not read at all."""
    first = features.agg(F.min("forecast_run_time").alias("run")).select(
        F.unix_micros("run").alias("micros"), F.date_sub("run", days).alias("cut")
    ).first()
    if first.micros is None:
        return observations.limit(0)
    recent = observations.where(F.col("event_date") >= F.lit(first.cut))
    before_run = F.unix_micros("sample_time") <= first.micros
    seen = recent.where(before_run).select("measurepoint_id").distinct()
    points = features.select("measurepoint_id").distinct()
    silent = points.join(seen, "measurepoint_id", "left_anti")
    if silent.isEmpty():
        return recent
    older = observations.where(F.col("event_date") < F.lit(first.cut))
    return recent.unionByName(skewproof_join(older, silent, ["measurepoint_id"], "left_semi"))


def prediction_rows(
    forecasts: DataFrame,
    observations: DataFrame | None,
    now: dt.datetime,
    *,
    hot_rows: int = HOT_ROWS,
    unique_keys: bool = False,
) -> DataFrame:
    """Feature rows to score: requested horizons, valid from ``now``'s hour to 72
    hours on, with the latest observation. Both filters need the forecast alone and
    so come before the join."""
    features = features_to_score(forecasts, now)
    if observations is None or observations.isEmpty():
        # This way has no dedup of its own, but the prediction table is keyed.
        order = input_order(features)
        return without_observations(keep_last(features, FORECAST_KEY, order) if order else features)
    first_run = features.select(F.min("forecast_run_time")).scalar()
    return attach_latest_observation(
        features, condensed(observations, first_run), hot_rows=hot_rows, unique_keys=unique_keys
    )


def with_decision(scored: DataFrame) -> DataFrame:
    return scored.withColumns(
        {
            "hazard_predicted": hazard_predicted(F.col("risk_mean")),
            "recommendation": recommendation(F.col("risk_mean"), F.col("risk_p90")),
        }
    )


def predict(rows: DataFrame, ensembles: Mapping[int, Ensemble]) -> DataFrame:
    """Prediction rows of every horizon that has an ensemble."""
    columns = [f.name for f in PREDICTION.schema]
    parts = [
        with_decision(score(rows.where(F.col("horizon_hours") == horizon), ensemble)).select(*columns)
        for horizon, ensemble in ensembles.items()
    ]
    if not parts:
        raise ValueError("no ensembles to score with")
    return union_by_name(parts)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def store_predictions(
    spark: SparkSession,
    predictions: DataFrame,
    fallback_csv: str | None = None,
    *,
    location: str | None = None,
) -> int | None:
    """Upsert into the prediction table. If that fails and ``fallback_csv`` is given,
    write CSV there instead and return None."""
    try:
        ensure_table(spark, PREDICTION, location=location)
        return upsert(spark, PREDICTION, predictions, order=())
    except Exception:
        if fallback_csv is None:
            raise
        write_csv(predictions, fallback_csv)
        return None
