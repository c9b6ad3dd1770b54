"""Lags of batches against lags of their union."""

import datetime as dt
import random
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from roadcast.operators.lag import with_lags
from roadcast.plans import lagged
from roadcast.plans.lagged import LAG_NAMES, WEATHER_LAGGED, upsert_with_lags
from roadcast.session import scratch_path
from roadcast.sources import tables
from roadcast.sources.tables import read_table, table_location

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
COLUMNS = "measurepoint_id BIGINT, sample_time TIMESTAMP, surface_temp_c DOUBLE, air_rh DOUBLE, ingested_at TIMESTAMP, _seq BIGINT"


def row(point, hour, value, come, seq=0):
    at = None if hour is None else T0 + dt.timedelta(hours=hour)
    return (point, at, value, None if value is None else value + 50, T0 + dt.timedelta(days=300 + come), seq)


@pytest.fixture
def spec(spark):
    return replace(WEATHER_LAGGED, name=f"weather_lagged_{uuid.uuid4().hex}")


def union_of(spark, batches):
    """Of each key the row ingested last, of several the one that came last."""
    best = {}
    for batch in batches:
        for r in batch:
            old = best.get(r[:2])
            if old is None or r[4] >= old[4]:
                best[r[:2]] = r
    rows = spark.createDataFrame([(*r[:5], 0) for r in best.values()], COLUMNS)
    return told(with_lags(rows.withColumns({c: F.lit(None).cast("double") for c in ("surface_grip", "air_temp_c")})))


def told(df):
    return sorted(map(repr, df.select("measurepoint_id", "sample_time", "surface_temp_c", *LAG_NAMES).collect()))


def batches():
    rng = random.Random(2)
    first = [row(p, h, p + h / 10, 0) for p in (1, 2, 3) for h in range(0, 60, 2)]
    second = [row(p, h, p + h / 10, 1) for p in (1, 2) for h in range(60, 70)] + [row(4, 5, 0.5, 1), row(None, 3, 9.0, 1)]
    late = [row(1, 31, 7.0, 2), row(3, 1, 8.0, 2), row(2, 66, -1.0, 2), row(2, 67, -2.0, 0), row(5, None, 1.5, 2), row(1, None, 4.0, 2)]
    mixed = [row(rng.choice((1, 2, 3, 4, None)), rng.randrange(0, 90), rng.random(), 3) for _ in range(25)]
    return [first, second, late, list({r[:2]: r for r in mixed}.values()), [row(1, 95, 2.0, 4)]]


def test_lags_are_those_of_the_union(spark, spec, monkeypatch):
    place, done = scratch_path(spark, spec.table), []
    for batch in batches():
        upsert_with_lags(spark, spark.createDataFrame(batch, COLUMNS), spec, location=place)
        done.append(batch)
        assert told(read_table(spark, spec)) == union_of(spark, done)
    assert upsert_with_lags(spark, spark.createDataFrame([], COLUMNS), spec) == 0
    assert told(read_table(spark, spec)) == union_of(spark, done)


def test_a_batch_behind_the_tail_reads_no_stored_row_and_a_late_one_mends_few(spark, spec, monkeypatch):
    rows = [row(p, h, p + h / 10, 0) for p in (1, 2) for h in range(0, 200, 2)]
    place = scratch_path(spark, spec.table)
    upsert_with_lags(spark, spark.createDataFrame(rows, COLUMNS), spec, location=place)
    read = []
    monkeypatch.setattr(lagged, "read_table", lambda *a: read.append(a) or read_table(*a))
    assert upsert_with_lags(spark, spark.createDataFrame([row(1, 300, 1.0, 1), row(9, 0, 1.0, 1)], COLUMNS), spec) == 2
    assert read == []
    late = [row(2, 51, 5.0, 2)]
    assert upsert_with_lags(spark, spark.createDataFrame(late, COLUMNS), spec) == 25  # itself and 24 behind it
    assert len(read) == 1
    assert told(read_table(spark, spec)) == union_of(spark, [rows, [row(1, 300, 1.0, 1), row(9, 0, 1.0, 1)], late])


def test_a_tail_that_does_not_fit_is_made_anew(spark, spec, monkeypatch):
    rows = [row(1, h, h / 10, 0) for h in range(0, 80, 2)]
    place = scratch_path(spark, spec.table)

    def lost(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(lagged, "_write_tail", lost)
    with pytest.raises(RuntimeError, match="driver lost"):
        upsert_with_lags(spark, spark.createDataFrame(rows, COLUMNS), spec, location=place)
    monkeypatch.undo()
    more = [row(1, 81, 1.0, 1), row(1, 90, 2.0, 1)]
    upsert_with_lags(spark, spark.createDataFrame(more, COLUMNS), spec)
    assert told(read_table(spark, spec)) == union_of(spark, [rows, more])
    assert table_location(spark, spec).rstrip("/").endswith(place.rsplit("/", 1)[1])


def test_lagged_rows_are_not_copied_again(spark, spec, monkeypatch):
    """The upsert takes them from where they were written, also of a late batch."""
    labels, fresh = [], tables.scratch_path

    def named(spark, label):
        labels.append(label)
        return fresh(spark, label)

    monkeypatch.setattr(tables, "scratch_path", named)
    place, days = fresh(spark, spec.table), batches()[:3:2]
    counts = [upsert_with_lags(spark, spark.createDataFrame(b, COLUMNS), spec, location=place) for b in days]
    assert not [x for x in labels if x.endswith("-incoming")]
    assert told(read_table(spark, spec)) == union_of(spark, days)
    assert counts[0] == len(days[0]) and len(days[1]) < counts[1] <= 24 * 3 + len(days[1])
    assert upsert_with_lags(spark, spark.createDataFrame([], COLUMNS), spec, location=place) == 0
