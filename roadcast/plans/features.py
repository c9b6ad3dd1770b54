"""Forecast features, and the vector a model reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from roadcast.functions.clean import nan_to_null, utc_timestamp, with_measurepoint_id
from roadcast.functions.times import calendar_features, horizon_hours
from roadcast.schemas import FEATURES


def run_or_fallback(df: DataFrame) -> Column:
    """Run time, else ingest time, else valid time."""
    known = [c for c in ("forecast_run_time", "ingested_at", "valid_time") if c in df.columns]
    return F.coalesce(*[utc_timestamp(df, c) for c in known])


def with_horizon(df: DataFrame) -> DataFrame:
    hours = horizon_hours(F.col("forecast_run_time"), F.col("valid_time"))
    return df.withColumn("horizon_hours", hours)


def forecast_features(forecasts: DataFrame) -> DataFrame:
    """Typed identifier and times, horizon and calendar features. The valid time
    stands in for the run time only where the whole column is absent."""
    df = with_measurepoint_id(forecasts)
    df = df.withColumn("valid_time", utc_timestamp(df, "valid_time"))
    run = "forecast_run_time" if "forecast_run_time" in df.columns else "valid_time"
    df = df.withColumn("forecast_run_time", utc_timestamp(df, run))
    return calendar_features(with_horizon(df), "valid_time")


def available_features(df: DataFrame) -> list[str]:
    return [c for c in FEATURES if c in df.columns]


def _filled(df: DataFrame, name: str) -> Column:
    """A feature as a double: 0 when missing, and 0 when the frame lacks the column."""
    if name not in df.columns:
        return F.lit(0.0)
    return F.coalesce(nan_to_null(F.col(name).cast("double")), F.lit(0.0))


def filled_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({c: _filled(df, c) for c in features})


def with_vector(df: DataFrame, features: Sequence[str], vector: str = "features") -> DataFrame:
    """Add the vector of filled features in the given order; the columns themselves
    stay as they are."""
    named = {f"_f_{c}": _filled(df, c) for c in features}
    assembler = VectorAssembler(inputCols=list(named), outputCol=vector)
    return assembler.transform(df.withColumns(named)).drop(*named)
