"""The as-of join against a brute-force search, in all its ways."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from roadcast.operators.asof import attach_latest_observation, condensed
from roadcast.operators.audit import attach_coverage, join_audit

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
FC = "measurepoint_id BIGINT, forecast_run_time TIMESTAMP, valid_time TIMESTAMP, t_air_c DOUBLE, ingest_seq BIGINT"
OBS = "measurepoint_id BIGINT, sample_time TIMESTAMP, surface_temp_c DOUBLE, ingest_seq BIGINT"


def moment(seconds):
    return None if seconds is None else START + dt.timedelta(seconds=seconds)


def frames(spark, forecasts, observations):
    fc = [(i, moment(r), moment(v), float(n), n) for n, (i, r, v) in enumerate(forecasts)]
    obs = [(i, moment(t), x, n) for n, (i, t, x) in enumerate(observations)]
    return spark.createDataFrame(fc, FC), spark.createDataFrame(obs, OBS)


def expected(forecasts, observations):
    fc, obs = {}, {}
    for n, (i, r, v) in enumerate(forecasts):
        if i is not None and r is not None:
            fc[i, r, v] = n
    for i, t, x in observations:
        if i is not None and t is not None:
            obs[i, t] = x
    rows = []
    for (i, r, v), n in fc.items():
        seen = [t for (j, t) in obs if j == i and t <= r]
        last = max(seen) if seen else None
        rows.append((n, last, obs[i, last] if seen else None, (r - last) / 60 if seen else 1e6))
    return sorted(rows)


def actual(df):
    rows = df.select(
        "ingest_seq", F.unix_seconds("obs_time") - int(START.timestamp()), "obs_surface_temp_c", "obs_age_minutes"
    ).collect()
    return sorted(tuple(r) for r in rows)


times = st.integers(0, 400)
forecast_rows = st.lists(
    st.tuples(st.sampled_from([1, 1, 1, 2, None]), times | st.none(), st.sampled_from([0, 3600, None])),
    max_size=25,
)
observation_rows = st.lists(
    st.tuples(st.sampled_from([1, 1, 2, 3, None]), times | st.none(), st.sampled_from([None, -1.5, 2.0])),
    max_size=25,
)


@pytest.mark.parametrize("ways", [{}, {"hot_rows": 0}, {"hot_rows": 5, "grain": "hour"}])
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(forecasts=forecast_rows, observations=observation_rows)
def test_like_brute_force(spark, ways, forecasts, observations):
    fc, obs = frames(spark, forecasts, observations)
    assert actual(attach_latest_observation(fc, obs, **ways)) == expected(forecasts, observations)


def test_carries_over_blocks_without_observations(spark):
    """Blocks: 0 has the observation, 1 nothing, 2 only runs, 3 both."""
    forecasts = [(1, 150, 0), (1, 179, 0), (1, 185, 0), (1, 200, 0)]
    observations = [(1, 10, 1.0), (1, 20, 2.0), (1, 190, 3.0)]
    fc, obs = frames(spark, forecasts, observations)
    out = actual(attach_latest_observation(fc, obs, hot_rows=0))
    assert [r[2] for r in out] == [2.0, 2.0, 2.0, 3.0]


def test_whole_row_even_if_its_reading_is_missing(spark):
    fc, obs = frames(spark, [(1, 100, 0)], [(1, 10, -3.0), (1, 50, None)])
    assert actual(attach_latest_observation(fc, obs)) == [(0, 50, None, 50 / 60)]


def test_equal_time_counts(spark):
    fc, obs = frames(spark, [(1, 100, 0)], [(1, 100, -3.0)])
    assert actual(attach_latest_observation(fc, obs)) == [(0, 100, -3.0, 0.0)]


def test_without_observations_rows_stay(spark):
    fc, _ = frames(spark, [(1, 100, 0), (1, 100, 0), (1, None, 0)], [])
    out = attach_latest_observation(fc, None)
    assert out.count() == 3
    assert out.where("obs_age_minutes = 1e6 and obs_time is null").count() == 3


def test_same_columns_with_and_without_observations(spark):
    fc, obs = frames(spark, [(1, 100, 0)], [(1, 100, -3.0)])
    with_obs = attach_latest_observation(fc, obs)
    without = attach_latest_observation(fc, None)
    assert dict(with_obs.dtypes) == dict(without.dtypes)


def test_unique_inputs_need_no_dedup(spark):
    fc, obs = frames(spark, [(1, 100, 0), (2, 90, 0)], [(1, 60, -3.0)])
    assert actual(attach_latest_observation(fc, obs, unique_keys=True)) == actual(
        attach_latest_observation(fc, obs)
    )


def test_never_a_nested_loop(spark):
    fc, obs = frames(spark, [(1, 100, 0)], [(1, 100, -3.0)])
    plan = attach_latest_observation(fc, obs)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_audit(spark):
    fc, obs = frames(
        spark, [(1, 100, 0), (1, 100, 0), (1, None, 0), (1, None, 0)], [(1, 5, 0.0), (1, 5, 1.0), (2, 7, 0.0)]
    )
    rows = {r.side: r for r in join_audit(fc, obs).collect()}
    assert (rows["forecast"].rows, rows["forecast"].null_times, rows["forecast"].duplicates) == (4, 2, 1)
    assert (rows["observation"].rows, rows["observation"].duplicates) == (3, 1)
    cover = attach_coverage(attach_latest_observation(fc, obs)).first()
    assert (cover["rows"], cover.matched) == (1, 1)


def test_condensed_history_gives_the_same(spark):
    forecasts = [(1, 200, 0), (1, 150, 0), (2, 300, 0), (3, 151, 0)]
    observations = [(1, 10, 1.0), (1, 20, 2.0), (1, 20, 2.5), (1, 150, 3.0), (1, 180, 4.0), (2, 5, 5.0), (4, 1, 0.0)]
    fc, obs = frames(spark, forecasts, observations)
    less = condensed(obs, fc.select(F.min("forecast_run_time")).scalar())
    assert less.count() == 5
    assert actual(attach_latest_observation(fc, less)) == expected(forecasts, observations)
