"""Queries over stored predictions: latest run, best row per point, key figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadcast.functions.clean import nan_to_null, whole_from_text
from roadcast.functions.risk import HIGH_RISK, MEDIUM_RISK, severity
from roadcast.operators.joins import dimension_join

# --- Fixed values: names a point, its time and its score may go by, first match wins
KEY_NAMES = ("measurepoint_id", "road_name", "name", "measurepoint_name", "location")
TIME_NAMES = (
    "valid_time",
    "prediction_time",
    "event_time",
    "timestamp",
    "time",
    "forecast_run_time",
)
SCORE_NAMES = ("risk_mean", "risk_probability", "probability", "score")


def _first_present(df: DataFrame, names: tuple[str, ...]) -> str | None:
    return next((n for n in names if n in df.columns), None)


def latest_run(predictions: DataFrame, newest: Column | None = None) -> DataFrame:
    """Rows of the newest run over all points, or of the run at ``newest`` where it is
    known. A point without that run has no rows; when no row has a run time, all stay."""
    if "forecast_run_time" not in predictions.columns:
        return predictions
    if newest is None:
        newest = predictions.select(F.max("forecast_run_time")).scalar()
    return predictions.where((F.col("forecast_run_time") == newest) | newest.isNull())


def repair_schema(predictions: DataFrame) -> DataFrame:
    """Give older prediction tables the columns the queries use."""
    df = predictions
    if "risk_mean" not in df.columns and "risk_probability" in df.columns:
        df = df.withColumn("risk_mean", F.col("risk_probability"))
    for name in ("risk_p10", "risk_p90"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("double"))
    return df


def numeric_ids(predictions: DataFrame, locations: DataFrame) -> DataFrame:
    """Replace display aliases in ``measurepoint_id`` by their numeric identifier.
    What is neither an alias nor a whole number becomes null; no row is dropped."""
    if "measurepoint_id" not in predictions.columns:
        return predictions
    text = predictions.withColumn("_alias", F.trim(F.col("measurepoint_id").cast("string")))
    aliases = locations.where(F.col("id").isNotNull()).select(
        F.col("id").alias("_alias"), F.col("tv_measurepoint_id").alias("_number")
    )
    joined = dimension_join(text, aliases, ["_alias"], "left")
    number = F.coalesce("_number", whole_from_text(F.col("_alias")))
    return joined.withColumn("measurepoint_id", number).select(*predictions.columns)


def with_point_name(df: DataFrame, locations: DataFrame) -> DataFrame:
    """Add ``point_name``: the location's name, or the identifier when unknown."""
    names = locations.select(
        F.col("tv_measurepoint_id").alias("measurepoint_id"), F.col("name").alias("_name")
    )
    joined = dimension_join(df, names, ["measurepoint_id"], "left")
    name = F.coalesce("_name", F.col("measurepoint_id").cast("string"))
    return joined.withColumn("point_name", name).drop("_name")


def map_points(df: DataFrame, locations: DataFrame) -> DataFrame:
    """Rows of known points with their position and name."""
    places = locations.select(
        F.col("tv_measurepoint_id").alias("measurepoint_id"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        F.col("name").alias("point_name"),
    )
    return dimension_join(df, places, ["measurepoint_id"], "inner")


def at_horizon(df: DataFrame, horizon: int | None = None) -> DataFrame:
    """Rows of one horizon; all rows for ``None`` or without such a column."""
    if horizon is None or "horizon_hours" not in df.columns:
        return df
    return df.where(F.col("horizon_hours") == horizon)


def best_per_point(predictions: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """One row per point: newest time, then highest score, then first in input
    order, with missing times and scores last. Without a key column all rows stay.

    A grouped maximum, so each task sends one row per point to the shuffle however
    many rows a point has.
    """
    key = _first_present(predictions, KEY_NAMES)
    if key is None:
        return predictions
    ranks = []
    time, score = _first_present(predictions, TIME_NAMES), _first_present(predictions, SCORE_NAMES)
    if time:
        ranks.append(F.col(time))
    if score:
        ranks.append(nan_to_null(F.col(score)))
    rest = [c for c in predictions.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(*ranks, -F.col(order)))
    return (
        predictions.groupBy(key).agg(best.alias("_best")).select(key, "_best.*")
        .select(*predictions.columns)
    )


def by_severity(df: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """Most severe first, then highest score; equal rows in input order."""
    score = _first_present(df, SCORE_NAMES)
    by = [severity(df).desc()]
    if score:
        by.append(nan_to_null(F.col(score)).desc_nulls_last())
    return df.orderBy(*by, F.col(order).asc())


def timeline(predictions: DataFrame, point: int | None = None) -> DataFrame:
    """Rows by point and valid time with ``has_band``: whether the point has any
    P10 and any P90. One point, or all at once."""
    df = predictions if point is None else predictions.where(F.col("measurepoint_id") == point)
    bands = df.groupBy("measurepoint_id").agg(
        (
            F.max(nan_to_null(F.col("risk_p10")).isNotNull())
            & F.max(nan_to_null(F.col("risk_p90")).isNotNull())
        ).alias("has_band")
    )
    flagged = dimension_join(df, bands, ["measurepoint_id"], "inner")
    by = ("measurepoint_id", "valid_time", "forecast_run_time", "horizon_hours")
    return flagged.orderBy(*[c for c in by if c in flagged.columns])


def key_figures(df: DataFrame) -> DataFrame:
    """Rows at high risk, mean risk in percent, number of points."""
    risk = nan_to_null(F.col("risk_mean"))
    return df.agg(
        F.count_if(risk > HIGH_RISK).alias("high_risk"),
        (F.avg(risk) * 100).alias("avg_risk_pct"),
        F.count_distinct("measurepoint_id").alias("points"),
    )


def risk_buckets(df: DataFrame) -> DataFrame:
    """Rows at high, medium and low risk; a missing risk is in none."""
    risk = nan_to_null(F.col("risk_mean"))
    return df.agg(
        F.count_if(risk > HIGH_RISK).alias("high"),
        F.count_if((risk > MEDIUM_RISK) & (risk <= HIGH_RISK)).alias("medium"),
        F.count_if(risk <= MEDIUM_RISK).alias("low"),
    )
