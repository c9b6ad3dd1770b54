"""Thresholds that turn conditions and probabilities into decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadcast.functions.clean import label_flag, nan_to_null

# --- Fixed values -----------------------------------------------------------

FREEZING_BELOW_C = 0.0
SLIPPERY_GRIP_BELOW = 0.5

HIGH_RISK = 0.7
MEDIUM_RISK = 0.4
HIGH_UPPER_RISK = 0.85
MODERATE_UPPER_RISK = 0.6
HAZARD_AT = 0.5

HIGH_COLOUR = "#FF0000"
MEDIUM_COLOUR = "#FFA500"
LOW_COLOUR = "#00CC00"

HIGH_ADVICE = "HIGH: Salting recommended within 2 hours"
MODERATE_ADVICE = "MODERATE: Standby for salting, prepare equipment"
LOW_ADVICE = "LOW: Normal operations, continue monitoring"


def hazard(df: DataFrame) -> Column:
    """1 when a row's observed surface is freezing, icy, snowy or slippery.

    A missing reading is safe, and a missing column takes no part.
    """
    checks = []
    if "surface_temp_c" in df.columns:
        checks.append(nan_to_null(F.col("surface_temp_c")) < FREEZING_BELOW_C)
    for flag in ("surface_ice", "surface_snow"):
        if flag in df.columns:
            checks.append(label_flag(df, flag) == 1)
    if "surface_grip" in df.columns:
        checks.append(nan_to_null(F.col("surface_grip")) < SLIPPERY_GRIP_BELOW)
    hit = F.lit(False)
    for check in checks:
        hit = hit | F.coalesce(check, F.lit(False))
    return hit.cast("int")


def risk_level(risk: Column) -> Column:
    return F.when(risk > HIGH_RISK, "HIGH").when(risk > MEDIUM_RISK, "MEDIUM").otherwise("LOW")


def risk_colour(risk: Column) -> Column:
    return (
        F.when(risk > HIGH_RISK, HIGH_COLOUR)
        .when(risk > MEDIUM_RISK, MEDIUM_COLOUR)
        .otherwise(LOW_COLOUR)
    )


def recommendation(mean: Column, p90: Column | None = None) -> Column:
    """Maintenance advice from the mean and upper risk; without an upper value
    the mean stands in. These bounds are inclusive, unlike ``risk_level``."""
    upper = mean if p90 is None else F.coalesce(nan_to_null(p90), mean)
    return (
        F.when((mean >= HIGH_RISK) | (upper >= HIGH_UPPER_RISK), HIGH_ADVICE)
        .when((mean >= MEDIUM_RISK) | (upper >= MODERATE_UPPER_RISK), MODERATE_ADVICE)
        .otherwise(LOW_ADVICE)
    )


def hazard_predicted(mean: Column) -> Column:
    return F.coalesce(mean >= HAZARD_AT, F.lit(False)).cast("int")


def severity(df: DataFrame) -> Column:
    """2/1/0 from ``risk_mean`` if the frame has it, else from ``risk_level`` text."""
    if "risk_mean" in df.columns:
        risk = nan_to_null(F.col("risk_mean"))
        return F.when(risk > HIGH_RISK, 2).when(risk > MEDIUM_RISK, 1).otherwise(0)
    if "risk_level" in df.columns:
        level = F.col("risk_level")
        return F.when(level == "HIGH", 2).when(level == "MEDIUM", 1).otherwise(0)
    return F.lit(0)
