"""Counts that say what a join dropped and matched."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def side_audit(df: DataFrame, time_col: str, keys: Sequence[str]) -> DataFrame:
    """One row: rows, rows without time, repeated keys among the rest, time range."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    if time_col not in keys:
        raise ValueError("the time column must be one of the keys")
    timed = F.col(time_col).isNotNull()
    rows = F.sum("_rows")
    return per_key.agg(
        F.coalesce(rows, F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~timed, F.col("_rows"))), F.lit(0)).alias("null_times"),
        F.coalesce(F.sum(F.when(timed, F.col("_rows") - 1)), F.lit(0)).alias("duplicates"),
        F.min(time_col).alias("min_time"),
        F.max(time_col).alias("max_time"),
    )


def join_audit(forecasts: DataFrame, observations: DataFrame) -> DataFrame:
    """``side_audit`` of both inputs of the as-of join, one row each."""
    left = side_audit(
        forecasts, "forecast_run_time", ("measurepoint_id", "forecast_run_time", "valid_time")
    )
    right = side_audit(observations, "sample_time", ("measurepoint_id", "sample_time"))
    return left.select(F.lit("forecast").alias("side"), "*").unionByName(
        right.select(F.lit("observation").alias("side"), "*")
    )


def attach_coverage(attached: DataFrame) -> DataFrame:
    """How many forecast rows found an observation."""
    return attached.agg(F.count("*").alias("rows"), F.count("obs_time").alias("matched"))


def zone_audit(zones: DataFrame, *, runs: bool) -> DataFrame:
    """``side_audit`` of a stored table, whose keys are unique, from what is known of its
    dates (see ``table_zones``): no row is read. ``runs`` audits the forecast run time,
    else the event time, which only rows without event date lack."""
    rows = F.coalesce(F.sum("rows"), F.lit(0))
    unplaced = F.coalesce(F.sum(F.when(F.col("event_date").isNull(), F.col("rows"))), F.lit(0))
    return zones.agg(
        rows.alias("rows"),
        (F.coalesce(F.sum("null_runs"), F.lit(0)) if runs else unplaced).alias("null_times"),
        F.lit(0).cast("long").alias("duplicates"),
        F.min("first_run" if runs else "first").alias("min_time"),
        F.max("last_run" if runs else "last").alias("max_time"),
    )


def zones_join_audit(forecast_zones: DataFrame, observation_zones: DataFrame) -> DataFrame:
    """``join_audit`` of two stored tables, or of whole dates of them."""
    left, right = zone_audit(forecast_zones, runs=True), zone_audit(observation_zones, runs=False)
    return left.select(F.lit("forecast").alias("side"), "*").unionByName(
        right.select(F.lit("observation").alias("side"), "*")
    )


def counting_coverage(attached: DataFrame) -> tuple[DataFrame, Callable[[SparkSession], DataFrame]]:
    """The frame, and what gives its ``attach_coverage`` once it has been written: counted
    by the write itself, without a job of its own."""
    seen = Observation()
    counts = (F.count(F.lit(1)).alias("rows"), F.count("obs_time").alias("matched"))

    def counted(spark: SparkSession) -> DataFrame:
        got = seen.get
        return spark.createDataFrame([(got["rows"], got["matched"])], "rows BIGINT, matched BIGINT")

    return attached.observe(seen, *counts), counted
