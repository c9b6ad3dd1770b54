"""Hourly hazard labels from observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadcast.functions.clean import utc_timestamp
from roadcast.functions.risk import hazard


def hourly_labels(observations: DataFrame) -> DataFrame:
    """1 per point and hour in which any observation was a hazard, else 0. Rows
    without identifier or time have no hour to label."""
    hour = F.date_trunc("hour", utc_timestamp(observations, "sample_time"))
    return (
        observations.select(
            "measurepoint_id", hour.alias("valid_time"), hazard(observations).alias("hazard")
        )
        .where(F.col("measurepoint_id").isNotNull() & F.col("valid_time").isNotNull())
        .groupBy("measurepoint_id", "valid_time")
        .agg(F.max("hazard").alias("hazard"))
    )
