"""Latest observation at or before each forecast run, per measurement point.

Spark has no as-of join, and a join on the time inequality compares every pair of a
point's rows. Here both sides are stacked, sorted by time within a group, and the
last observation is carried forward.

What keeps it distributed:

* Only the distinct run times go through the sort. Forecast rows, of which a run
  may have any number, join the matches afterwards on (point, run time).
* After that and the dedup of observations, a point has at most one row per side
  and microsecond.
* A point with more than ``hot_rows`` rows is cut into blocks of one ``grain``.
  Every block that has runs also receives the last observation of the earlier
  blocks, which is found on a table of one row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadcast.functions.clean import (
    feature_flag,
    number,
    utc_timestamp,
    with_measurepoint_id,
)
from roadcast.functions.times import age_minutes
from roadcast.operators.dedup import input_order, keep_last
from roadcast.operators.hotkeys import HOT_ROWS, flag_hot
from roadcast.operators.joins import skewproof_join
from roadcast.schemas import OBSERVATION_FEATURES

# --- Fixed values
READINGS = ("surface_temp_c", "surface_grip", "air_temp_c", "air_rh", "dewpoint_c")
FLAGS = ("surface_ice", "surface_snow", "surface_water")
OBSERVED = {c: f"obs_{c}" for c in READINGS + FLAGS} | {"sample_time": "obs_time"}
FORECAST_KEY = ("measurepoint_id", "forecast_run_time", "valid_time")


def observation_features(observations: DataFrame) -> DataFrame:
    """Typed identifier, time, readings and flags; absent columns come as null.
    The columns that record input order are kept for the dedup."""
    df = with_measurepoint_id(observations)
    readings = [
        (number(df, c) if c in df.columns else F.lit(None).cast("double")).alias(c)
        for c in READINGS
    ]
    flags = [
        (feature_flag(df, c) if c in df.columns else F.lit(None).cast("int")).alias(c)
        for c in FLAGS
    ]
    time = utc_timestamp(df, "sample_time").alias("sample_time")
    return df.select("measurepoint_id", time, *readings, *flags, *input_order(df))


def without_observations(forecasts: DataFrame) -> DataFrame:
    """The result when there is no observation at all: rows stay as they are."""
    blanks = {c: F.lit(None).cast("double") for c in OBSERVATION_FEATURES}
    for flag in FLAGS:
        blanks[f"obs_{flag}"] = F.lit(None).cast("int")
    blanks["obs_time"] = F.lit(None).cast("timestamp")
    blanks["obs_age_minutes"] = age_minutes(F.lit(None).cast("timestamp"), F.lit(None).cast("timestamp"))
    return forecasts.withColumns(blanks)


def attach_latest_observation(
    forecasts: DataFrame,
    observations: DataFrame | None,
    *,
    hot_rows: int = HOT_ROWS,
    grain: str = "minute",
    unique_keys: bool = False,
) -> DataFrame:
    """Forecast rows with the whole latest observation (``obs_*``) and its age.

    Rows without identifier or run time go, and repeated keys on either side keep
    their last row; rows before any observation stay, with nulls and a fixed large
    age. ``unique_keys`` skips the dedup for inputs read from keyed tables, which
    hold one row per key already. Pass ``None`` when there are no observations.
    """
    if (
        observations is None
        or "sample_time" not in observations.columns
        or "forecast_run_time" not in forecasts.columns
    ):
        return without_observations(forecasts)
    timed = _timed_forecasts(forecasts)
    runs = timed if unique_keys or "valid_time" not in timed.columns else keep_last(timed, FORECAST_KEY)
    seen = _observation_side(observations, unique_keys)
    ids = [
        with_measurepoint_id(side.select("measurepoint_id")) for side in (forecasts, observations)
    ]
    matches = latest_before(
        # The dedup leaves the same run times, so they are taken from before it.
        timed.select("measurepoint_id", F.col("forecast_run_time").alias("_time")).distinct(),
        seen.select(
            "measurepoint_id",
            F.col("sample_time").alias("_time"),
            F.struct(*[F.col(c).alias(to) for c, to in OBSERVED.items()]).alias("_value"),
        ),
        counted=ids[0].unionByName(ids[1]),
        hot_rows=hot_rows,
        grain=grain,
    ).withColumnRenamed("_time", "forecast_run_time")
    joined = skewproof_join(runs, matches, ["measurepoint_id", "forecast_run_time"], "left")
    return joined.select(
        *runs.columns,
        *[F.col(f"_value.{to}").alias(to) for to in OBSERVED.values()],
        age_minutes(F.col("_value.obs_time"), F.col("forecast_run_time")).alias("obs_age_minutes"),
    )


def _timed_forecasts(forecasts: DataFrame) -> DataFrame:
    df = with_measurepoint_id(forecasts)
    df = df.withColumn("forecast_run_time", utc_timestamp(df, "forecast_run_time"))
    return df.where(F.col("forecast_run_time").isNotNull())


def _observation_side(observations: DataFrame, unique_keys: bool) -> DataFrame:
    df = observation_features(observations).where(F.col("sample_time").isNotNull())
    return df if unique_keys else keep_last(df, ("measurepoint_id", "sample_time"))


def condensed(observations: DataFrame, since: Column) -> DataFrame:
    """The observations that can be the latest for any run from ``since`` on: those
    from then on, and each point's last one before.

    Scoring looks at a few recent runs, and the observation may be arbitrarily old.
    The history is read, but of each point's older rows a task passes on only one.
    """
    df = with_measurepoint_id(observations)
    df = df.withColumn("sample_time", utc_timestamp(df, "sample_time"))
    recent = df.where(F.col("sample_time") >= since)
    older = df.where(F.col("sample_time") < since)
    last = keep_last(older, ["measurepoint_id"], ["sample_time", *input_order(df)])
    return recent.unionByName(last)


def latest_before(
    probes: DataFrame,
    values: DataFrame,
    counted: DataFrame,
    *,
    hot_rows: int = HOT_ROWS,
    grain: str = "minute",
) -> DataFrame:
    """For each distinct probe ``(measurepoint_id, _time)`` the ``_value`` struct of
    the last value row at or before it, or null. ``counted`` holds the identifiers
    by whose number of rows a point is taken for hot; an over-count does no harm,
    so the inputs before their dedup serve, at the cost of one narrow scan."""
    stacked = values.withColumn("_side", F.lit(0)).unionByName(
        probes.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    flagged = flag_hot(stacked, counted, "measurepoint_id", hot_rows)
    blocked = flagged.withColumn("_block", F.when(F.col("_hot"), F.date_trunc(grain, "_time")))
    everything = blocked.drop("_hot").unionByName(_carried(blocked.where("_hot")))
    # At equal times the observation sorts first, so it counts for the run.
    so_far = (
        Window.partitionBy("measurepoint_id", "_block")
        .orderBy("_time", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        everything.withColumn("_value", F.last("_value", ignorenulls=True).over(so_far))
        .where(F.col("_side") == 1)
        .select("measurepoint_id", "_time", "_value")
    )


def _carried(blocked: DataFrame) -> DataFrame:
    """For each block of a hot point that has probes, the last value of the earlier
    blocks, as one more value row of that block."""
    blocks = (
        blocked.groupBy("measurepoint_id", "_block")
        .agg(
            F.max_by("_value", F.when(F.col("_side") == 0, F.col("_time"))).alias("_last"),
            F.max(F.when(F.col("_side") == 0, F.col("_time"))).alias("_last_time"),
            F.max("_side").alias("_probed"),
        )
    )
    earlier = (
        Window.partitionBy("measurepoint_id")
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        blocks.withColumns(
            {
                "_value": F.last("_last", ignorenulls=True).over(earlier),
                "_time": F.last("_last_time", ignorenulls=True).over(earlier),
            }
        )
        .where((F.col("_probed") == 1) & F.col("_value").isNotNull())
        .select("measurepoint_id", "_block", "_time", "_value", F.lit(0).alias("_side"))
    )
