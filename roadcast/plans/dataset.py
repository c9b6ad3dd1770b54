"""Training rows: forecasts with their latest observation and the observed outcome."""

from __future__ import annotations

from pyspark.sql import DataFrame

from roadcast.functions.clean import utc_timestamp, with_measurepoint_id
from roadcast.functions.times import at_horizons, calendar_features
from roadcast.operators.asof import attach_latest_observation
from roadcast.operators.hotkeys import HOT_ROWS
from roadcast.operators.joins import skewproof_join
from roadcast.operators.labels import hourly_labels
from roadcast.plans.features import run_or_fallback, with_horizon


def training_dataset(
    forecasts: DataFrame,
    observations: DataFrame,
    *,
    hot_rows: int = HOT_ROWS,
    unique_keys: bool = False,
) -> DataFrame:
    """One row per forecast at a requested horizon whose valid hour was observed.

    The horizon filter and the label join come before the as-of join: they look at key
    columns only, so they commute with its dedup, and they leave fewer and narrower
    rows to sort. A filter above a window is not pushed below it by itself.
    """
    fc = with_measurepoint_id(forecasts)
    obs = with_measurepoint_id(observations)
    fc = fc.withColumn("valid_time", utc_timestamp(fc, "valid_time"))
    fc = at_horizons(with_horizon(fc.withColumn("forecast_run_time", run_or_fallback(fc))))
    labelled = skewproof_join(fc, hourly_labels(obs), ["measurepoint_id", "valid_time"], "inner")
    attached = attach_latest_observation(labelled, obs, hot_rows=hot_rows, unique_keys=unique_keys)
    return calendar_features(attached, "valid_time")


def complete_rows(dataset: DataFrame) -> DataFrame:
    """Rows that have both an outcome and a horizon."""
    return dataset.na.drop(subset=["hazard", "horizon_hours"])


def has_rows(*frames: DataFrame) -> bool:
    """Whether each frame has any row; reads at most one row of each."""
    return not any(f.isEmpty() for f in frames)
