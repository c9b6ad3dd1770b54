"""The predictions a reader looks at."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from roadcast.functions.clean import utc_timestamp
from roadcast.functions.risk import risk_colour, risk_level
from roadcast.functions.times import in_valid_window
from roadcast.operators.serving import (
    best_per_point,
    by_severity,
    latest_run,
    numeric_ids,
    repair_schema,
    with_point_name,
)


def current_predictions(
    predictions: DataFrame,
    locations: DataFrame,
    now: dt.datetime,
    newest: Column | None = None,
) -> DataFrame:
    """Newest run, numeric identifiers, the coming 72 hours, all expected columns.
    ``newest`` is the time of that run where the caller knows it."""
    df = predictions
    if "forecast_run_time" in df.columns:
        df = df.withColumn("forecast_run_time", utc_timestamp(df, "forecast_run_time"))
    df = numeric_ids(latest_run(df, newest), locations)
    df = df.withColumn("valid_time", utc_timestamp(df, "valid_time"))
    return repair_schema(in_valid_window(df, now))


def recommendation_list(
    predictions: DataFrame, locations: DataFrame, order: str = "ingest_seq"
) -> DataFrame:
    """The best row of each point with its name, level and colour, worst first."""
    named = with_point_name(best_per_point(predictions, order), locations)
    return by_severity(
        named.withColumns(
            {
                "risk_level": risk_level(F.col("risk_mean")),
                "risk_colour": risk_colour(F.col("risk_mean")),
            }
        ),
        order,
    )
