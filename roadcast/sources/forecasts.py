"""All locations' landed forecasts in one read, with the failures beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadcast import schemas
from roadcast.operators.joins import dimension_join
from roadcast.sources.extract import forecast_rows, point_forecasts
from roadcast.sources.landing import answered, listed_faults, quarantined


def location_forecasts(landed: DataFrame, locations: DataFrame) -> DataFrame:
    """Forecast rows of every usable payload that belongs to a usable location."""
    usable = locations.where(F.col("tv_measurepoint_id").isNotNull())
    return point_forecasts(answered(landed), usable)


def parsed_forecast_rows(parsed: DataFrame, locations: DataFrame) -> DataFrame:
    """The same of parsed payloads."""
    usable = locations.where(F.col("tv_measurepoint_id").isNotNull())
    return forecast_rows(parsed.where("_answered"), usable)


def location_errors(landed: DataFrame, locations: DataFrame) -> DataFrame:
    """One row ``(location_id, error)`` per rejected payload or part of one, per location
    that has no identifier or no payload at all, and per location with payloads that is
    not among ``locations``."""
    bad_bodies = quarantined(landed, schemas.FORECAST_SHAPE)
    return _errors(bad_bodies, landed.select("location_id").distinct(), locations)


def parsed_errors(parsed: DataFrame, locations: DataFrame) -> DataFrame:
    """The same of parsed payloads."""
    return _errors(listed_faults(parsed), parsed.select("location_id").distinct(), locations)


def _errors(rejects: DataFrame, landed_for: DataFrame, locations: DataFrame) -> DataFrame:
    bad_bodies = rejects.select("location_id", F.col("reject_reason").alias("error"))
    unnumbered = locations.where(F.col("tv_measurepoint_id").isNull()).select(
        F.col("id").alias("location_id"), F.lit("no measurement point identifier").alias("error")
    )
    numbered = locations.where(F.col("tv_measurepoint_id").isNotNull())
    silent = (
        numbered.select(F.col("id").alias("location_id"))
        .join(landed_for, "location_id", "left_anti")
        .withColumn("error", F.lit("no payload"))
    )
    unknown = landed_for.join(
        locations.select(F.col("id").alias("location_id")), "location_id", "left_anti"
    ).withColumn("error", F.lit("unknown location"))
    # Only payloads of numbered locations are asked for, so only theirs can fail.
    asked = dimension_join(
        bad_bodies, numbered.select(F.col("id").alias("location_id")), ["location_id"], "left_semi"
    )
    return asked.unionByName(unnumbered).unionByName(silent).unionByName(unknown)
