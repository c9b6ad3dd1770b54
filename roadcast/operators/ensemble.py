"""Mean and quantiles over the members of an ensemble."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from roadcast.functions.calibration import array_mean, array_quantile, member_array

# --- Fixed values
LOW_QUANTILE, HIGH_QUANTILE = 0.1, 0.9


def ensemble_summary(df: DataFrame, members: Sequence[str]) -> DataFrame:
    """Replace the member columns by ``risk_mean``, ``risk_p10`` and ``risk_p90``.
    Row by row, no shuffle."""
    values = F.col("_members")
    return (
        df.withColumn("_members", member_array(members))
        .withColumns(
            {
                "risk_mean": array_mean(values),
                "risk_p10": array_quantile(values, LOW_QUANTILE),
                "risk_p90": array_quantile(values, HIGH_QUANTILE),
            }
        )
        .drop("_members", *members)
    )


def long_ensemble_summary(df: DataFrame, keys: Sequence[str], value: str = "prob") -> DataFrame:
    """The same for one row per member. A group holds the members of one row, so
    the exact percentile stays small."""
    return df.groupBy(*keys).agg(
        F.avg(value).alias("risk_mean"),
        F.percentile(value, LOW_QUANTILE).alias("risk_p10"),
        F.percentile(value, HIGH_QUANTILE).alias("risk_p90"),
    )
