"""Calendar, horizon and age expressions over UTC timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from roadcast.functions.clean import utc_timestamp
from roadcast.schemas import HORIZONS

# --- Fixed values
RUSH_HOURS = (7, 8, 9, 16, 17, 18)
NO_OBSERVATION_AGE = 1e6
HORIZON_WINDOW_HOURS = 72


def calendar_features(df: DataFrame, time_col: str) -> DataFrame:
    """Hour, Monday-based weekday, month, and 0/1 rush-hour and weekend flags.
    A missing time has null parts but 0 flags."""
    when = utc_timestamp(df, time_col)
    hour, weekday = F.hour(when), F.weekday(when)
    return df.withColumns(
        {
            "hour": hour,
            "day_of_week": weekday,
            "month": F.month(when),
            "is_rush_hour": F.coalesce(hour.isin(*RUSH_HOURS), F.lit(False)).cast("int"),
            "is_weekend": F.coalesce(weekday >= 5, F.lit(False)).cast("int"),
        }
    )


def micros_between(start: Column, end: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def horizon_hours(run: Column, valid: Column) -> Column:
    """Whole hours from run to valid time; halves go to the even hour."""
    return F.rint(micros_between(run, valid) / F.lit(3.6e9)).cast("bigint")


def at_horizons(df: DataFrame, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """Keep the rows of the given horizons; rows without one go."""
    return df.where(F.col("horizon_hours").isin(*horizons))


def age_minutes(observed: Column, run: Column) -> Column:
    """Fractional minutes from observation to run; a fixed large age when there is none."""
    return F.coalesce(micros_between(observed, run) / F.lit(6e7), F.lit(NO_OBSERVATION_AGE))


def floor_hour(now: dt.datetime) -> dt.datetime:
    return now.replace(minute=0, second=0, microsecond=0)


def in_valid_window(
    df: DataFrame, now: dt.datetime, hours: int = HORIZON_WINDOW_HOURS, time_col: str = "valid_time"
) -> DataFrame:
    """Rows valid from the start of ``now``'s hour to ``hours`` later, both ends
    included. ``now`` is naive UTC and the caller's, so results repeat."""
    start = floor_hour(now)
    low, high = utc_literal(start), utc_literal(start + dt.timedelta(hours=hours))
    return df.where(F.col(time_col).between(low, high))


def utc_literal(moment: dt.datetime) -> Column:
    """A naive UTC datetime as a literal, whatever zone the Python process runs in."""
    return F.timestamp_micros(F.lit(_epoch_micros(moment)))


def _epoch_micros(moment: dt.datetime) -> int:
    return (moment - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
