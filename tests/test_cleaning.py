"""Coercions, flags, calendar, horizon and decision rules on hand-written rows."""

import datetime as dt

from pyspark.sql import functions as F

from roadcast.functions.clean import (
    feature_flag,
    label_flag,
    number,
    utc_timestamp,
    with_measurepoint_id,
)
from roadcast.functions.risk import hazard, recommendation, risk_level, severity
from roadcast.functions.times import (
    age_minutes,
    at_horizons,
    calendar_features,
    horizon_hours,
    in_valid_window,
)
from roadcast.plans.dataset import has_rows
from roadcast.plans.features import filled_features, forecast_features, run_or_fallback


def values(df, column):
    return [r[column] for r in df.orderBy("i").collect()]


def frame(spark, kind, cells):
    return spark.createDataFrame(list(enumerate(cells)), f"i INT, x {kind}")


def test_text_ids(spark):
    cells = ["243", "243.9", " 7 ", "1e3", "-3.9", "9007199254740993", "1d", "nan", "", None]
    kept = with_measurepoint_id(frame(spark, "STRING", cells), "x")
    assert values(kept, "x") == [243, 243, 7, 1000, -3, 9007199254740993]


def test_number_ids(spark):
    kept = with_measurepoint_id(frame(spark, "DOUBLE", [243.9, float("nan"), None, 1e30]), "x")
    assert values(kept, "x") == [243]
    whole = with_measurepoint_id(frame(spark, "INT", [3, None]), "x")
    assert values(whole, "x") == [3]


def test_ids_without_the_column(spark):
    df = frame(spark, "INT", [1])
    assert with_measurepoint_id(df, "absent") is df


def test_flags_of_text(spark):
    cells = ["true", "True", "1", "0", "false", "2.7", "yes", "nan", None]
    df = frame(spark, "STRING", cells)
    assert values(df.withColumn("f", feature_flag(df, "x")), "f") == [1, 1, 1, 0, 0, 2, 0, 0, 0]
    assert values(df.withColumn("f", label_flag(df, "x")), "f") == [1, 0, 0, 0, 0, 0, 0, 0, 0]


def test_flags_of_other_types(spark):
    df = frame(spark, "DOUBLE", [1.0, 2.0, -2.7, float("nan"), None])
    assert values(df.withColumn("f", feature_flag(df, "x")), "f") == [1, 2, -2, 0, 0]
    assert values(df.withColumn("f", label_flag(df, "x")), "f") == [1, 0, 0, 0, 0]
    df = frame(spark, "BOOLEAN", [True, False, None])
    for flag in (feature_flag, label_flag):
        assert values(df.withColumn("f", flag(df, "x")), "f") == [1, 0, 0]


def test_numbers(spark):
    df = frame(spark, "STRING", ["1.5", " 2 ", "1f", "inf", "nan", None])
    assert values(df.withColumn("n", number(df, "x")), "n") == [1.5, 2.0, None, None, None, None]


def test_times(spark):
    cells = [
        "2024-01-01T00:00:00+01:00", "2024-01-01 05:00", "2024-01-01T05:00:00.250Z", "x", "", None,
    ]
    df = frame(spark, "STRING", cells)
    out = df.withColumn("t", utc_timestamp(df, "x").cast("timestamp_ntz"))
    assert values(out, "t") == [
        dt.datetime(2023, 12, 31, 23),
        dt.datetime(2024, 1, 1, 5),
        dt.datetime(2024, 1, 1, 5, 0, 0, 250_000),
        None, None, None,
    ]


def test_calendar(spark):
    df = frame(spark, "STRING", ["2024-01-06 07:00", "2024-01-08 19:00", None])
    rows = calendar_features(df, "x").orderBy("i").drop("i", "x").collect()
    assert [tuple(r) for r in rows] == [(7, 5, 1, 1, 1), (19, 0, 1, 0, 0), (None, None, None, 0, 0)]


def test_horizon_rounds_halves_to_even(spark):
    df = spark.sql(
        "select i, timestamp'2024-01-01' as r, timestamp'2024-01-01' + make_dt_interval(0, 0, m) as v"
        " from values (0, 23*60+30), (1, 24*60+30), (2, 25*60+30), (3, -90), (4, null) as t(i, m)"
    )
    out = df.withColumn("horizon_hours", horizon_hours(F.col("r"), F.col("v")))
    assert values(out, "horizon_hours") == [24, 24, 26, -2, None]
    assert values(at_horizons(out), "horizon_hours") == [24, 24]


def test_age(spark):
    df = spark.sql(
        "select i, o, timestamp'2024-01-01 01:00:00' as r from values"
        " (0, timestamp'2024-01-01 00:59:30'), (1, null) as t(i, o)"
    )
    assert values(df.withColumn("a", age_minutes(F.col("o"), F.col("r"))), "a") == [0.5, 1e6]


def test_window_is_closed_and_floors_now(spark):
    cells = ["2024-01-01 09:59", "2024-01-01 10:00", "2024-01-04 10:00", "2024-01-04 10:01"]
    df = frame(spark, "STRING", cells).withColumn("valid_time", F.col("x").cast("timestamp"))
    kept = in_valid_window(df, dt.datetime(2024, 1, 1, 10, 59))
    assert values(kept, "i") == [1, 2]


def test_run_fallback(spark):
    df = spark.sql(
        "select 0 as i, timestamp'2024-01-03' as valid_time, timestamp'2024-01-02' as ingested_at,"
        " cast(null as timestamp) as forecast_run_time"
    )
    out = df.withColumn("r", run_or_fallback(df).cast("timestamp_ntz"))
    assert values(out, "r") == [dt.datetime(2024, 1, 2)]
    bare = df.select("i", "valid_time")
    assert values(bare.withColumn("r", run_or_fallback(bare).cast("timestamp_ntz")), "r") == [
        dt.datetime(2024, 1, 3)
    ]


def test_forecast_without_run_column(spark):
    df = spark.sql("select '5' as measurepoint_id, '2024-01-03' as valid_time")
    row = forecast_features(df).first()
    assert (row.measurepoint_id, row.horizon_hours) == (5, 0)


def test_hazard(spark):
    df = spark.createDataFrame(
        [(0, 0.0, None, None, 0.5), (1, -0.1, None, None, None), (2, None, True, None, None),
         (3, None, False, True, None), (4, None, None, None, 0.49), (5, None, None, None, None),
         (6, float("nan"), None, None, float("nan"))],
        "i INT, surface_temp_c DOUBLE, surface_ice BOOLEAN, surface_snow BOOLEAN, surface_grip DOUBLE",
    )
    assert values(df.withColumn("h", hazard(df)), "h") == [0, 1, 1, 1, 1, 0, 0]
    bare = df.select("i")
    assert values(bare.withColumn("h", hazard(bare)), "h") == [0] * 7


def test_decisions(spark):
    df = spark.createDataFrame(
        [(0, 0.7, None), (1, 0.4, None), (2, 0.2, 0.85), (3, 0.2, 0.6), (4, 0.39, 0.5),
         (5, 0.71, float("nan"))],
        "i INT, risk_mean DOUBLE, risk_p90 DOUBLE",
    )
    advice = df.withColumn("r", recommendation(F.col("risk_mean"), F.col("risk_p90")))
    assert [r.split(":")[0] for r in values(advice, "r")] == [
        "HIGH", "MODERATE", "HIGH", "MODERATE", "LOW", "HIGH",
    ]
    levels = df.withColumn("l", risk_level(F.col("risk_mean")))
    assert values(levels, "l") == ["MEDIUM", "LOW", "LOW", "LOW", "LOW", "HIGH"]


def test_severity_by_level_text(spark):
    df = spark.createDataFrame([(0, "HIGH"), (1, "MEDIUM"), (2, "odd"), (3, None)], "i INT, risk_level STRING")
    assert values(df.withColumn("s", severity(df)), "s") == [2, 1, 0, 0]


def test_filled_features(spark):
    df = spark.createDataFrame([(0, float("nan"), 2), (1, None, None)], "i INT, a DOUBLE, b INT")
    out = filled_features(df, ["b", "a", "c"]).orderBy("i").select("a", "b", "c")
    assert [tuple(r) for r in out.collect()] == [(0.0, 2.0, 0.0), (0.0, 0.0, 0.0)]


def test_has_rows(spark):
    some, none = spark.range(1), spark.range(0)
    assert has_rows(some) and not has_rows(some, none)
