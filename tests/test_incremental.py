"""Training rows after updates against a full build."""

import datetime as dt
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from roadcast import schemas
from roadcast.plans import incremental
from roadcast.plans.dataset import training_dataset
from roadcast.plans.incremental import FIRST_TIMES, TRAINING_ROWS, update_training_rows
from roadcast.session import scratch_path
from roadcast.sources.tables import ensure_table, expire_versions, read_table, upsert

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
OBS = "measurepoint_id BIGINT, sample_time TIMESTAMP, surface_temp_c DOUBLE, ingested_at TIMESTAMP, _seq BIGINT"
FC = ("measurepoint_id BIGINT, forecast_run_time TIMESTAMP, valid_time TIMESTAMP, t_air_c DOUBLE, "
      "ingested_at TIMESTAMP, _seq BIGINT")


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def observed(spark, *rows, come=0):
    return spark.createDataFrame([(p, at(h), t, at(5000 + come), i) for i, (p, h, t) in enumerate(rows)], OBS)


def forecast(spark, *rows, come=0):
    cells = [(p, None if r is None else at(r), at(v), t, at(5000 + come), i) for i, (p, r, v, t) in enumerate(rows)]
    return spark.createDataFrame(cells, FC)


@pytest.fixture
def specs(spark):
    suffix, place = f"_{uuid.uuid4().hex}", scratch_path(spark, "incremental")
    out = [replace(s, name=s.name + suffix)
           for s in (schemas.POINT_FORECAST, schemas.WEATHER_OBSERVATION, TRAINING_ROWS, FIRST_TIMES)]
    for spec in out:
        ensure_table(spark, spec, location=f"{place}/{spec.table}")
    # Point 2 was last observed on the second day; its later runs see that.
    upsert(spark, out[1], observed(spark, *[(1, h, h / 10 - 5) for h in range(3, 240, 6)], (2, 5, 1.0), (2, 30, -1.0)))
    upsert(spark, out[0], forecast(spark, *[(p, r, r + n, r / 100) for p in (1, 2) for r in range(9, 150, 24)
                                            for n in (24, 48, 72)], (1, None, 99, 9.0)))
    return out


def told(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def full(spark, specs):
    made = training_dataset(read_table(spark, specs[0]), read_table(spark, specs[1]), unique_keys=True)
    return told(made.select(*[F.col(f.name).cast(f.dataType) for f in TRAINING_ROWS.schema]))


def files(spark, specs):
    return {f.rpartition("event_date=")[2][:10]: f for f in read_table(spark, specs[2]).inputFiles()}


def test_a_late_payload_remakes_only_what_it_reaches(spark, specs):
    made = update_training_rows(spark, *specs)
    assert len(made) >= 9 and told(read_table(spark, specs[2])) == full(spark, specs)
    assert len(full(spark, specs)) > 10
    assert update_training_rows(spark, *specs) == []
    before = files(spark, specs)
    # Seen by the runs of that day at most: those at 57 and before 63, and the labels.
    upsert(spark, specs[1], observed(spark, (1, 56, 3.0), come=1))
    made = update_training_rows(spark, *specs)
    assert [str(d) for d in made] == ["2024-01-03", "2024-01-04", "2024-01-05", "2024-01-06"]
    assert told(read_table(spark, specs[2])) == full(spark, specs)
    after = files(spark, specs)
    assert {d for d in before if before[d] != after.get(d)} <= {str(d) for d in made}
    assert any(before[d] == after.get(d) for d in before)


def test_a_point_silent_since_is_reached_by_later_runs(spark, specs):
    update_training_rows(spark, *specs)
    upsert(spark, specs[1], observed(spark, (2, 31, -3.0), (1, 81, 4.0), come=1))
    upsert(spark, specs[0], forecast(spark, (2, 57, 105, 1.5), (1, 9, 33, -7.0), come=1))
    update_training_rows(spark, *specs)
    assert told(read_table(spark, specs[2])) == full(spark, specs)


def test_a_run_that_dies_repeats_and_expired_versions_mean_all(spark, specs, monkeypatch):
    update_training_rows(spark, *specs)
    upsert(spark, specs[1], observed(spark, (1, 56, 3.0), come=1))

    def lost(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(incremental, "write_note", lost)
    with pytest.raises(RuntimeError, match="driver lost"):
        update_training_rows(spark, *specs)
    monkeypatch.undo()
    assert len(update_training_rows(spark, *specs)) == 4
    assert told(read_table(spark, specs[2])) == full(spark, specs)
    upsert(spark, specs[1], observed(spark, (1, 8, 3.5), come=2))
    expire_versions(spark, specs[1])
    assert len(update_training_rows(spark, *specs)) >= 9
    assert told(read_table(spark, specs[2])) == full(spark, specs)


def test_dates_seen_by_the_ends_of_each_day(spark, monkeypatch):
    """Of many runs of a point on one day, two are looked up; every date seen is found."""
    firsts = [(1, 6), (1, 24 * 2 + 13), (2, 24 * 2)]
    runs = [(p, h / 10, n) for p in (1, 2, 3) for h in range(0, 960) for n in (24, 48)]
    runs += [(None, 5, 24)]
    fc = forecast(spark, *[(p, r, r + n, 0.0) for p, r, n in runs])
    fc = fc.withColumn("event_date", F.to_date("valid_time"))
    first_times = spark.createDataFrame([(p, at(h)) for p, h in firsts], "measurepoint_id BIGINT, first_time TIMESTAMP")
    first_times = first_times.withColumn("event_date", F.to_date("first_time"))
    probed = []
    look_up = incremental.latest_before

    def watched(probes, *given, **named):
        probed.append(probes.count())
        return look_up(probes, *given, **named)

    monkeypatch.setattr(incremental, "latest_before", watched)
    found = {tuple(r) for r in incremental._dates_seen(fc, first_times).collect()}
    want = set()
    for p, r, n in runs:
        if p is not None:
            before = [h for q, h in firsts if q == p and h <= r]
            if before:
                want.add((at(r + n).date(), at(max(before)).date()))
    assert found == want
    # Three points on four days, of each the first and the last run of two valid dates a run.
    assert probed[0] <= 3 * 4 * 4
