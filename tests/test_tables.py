"""Keyed tables: creation, upsert, recovery, refresh and streaming."""

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from roadcast import schemas
from roadcast.plans.refresh import Feed, landing_feeds, refresh, total_rows
from roadcast.queries import ingest
from roadcast.session import SHUFFLE_CLEANUP, scratch_path
from roadcast.sources import extract, snapshots, tables
from roadcast.sources.landing import read_landing
from roadcast.sources.tables import (
    align_to_table,
    ensure_table,
    expire_versions,
    merged,
    read_table,
    table_columns,
    table_location,
    table_properties,
    table_versions,
    table_zones,
    upsert,
    write_csv,
)
from roadcast.streaming.landing import stream_landing, stream_to_table
from test_extract import FROST, WEATHER


@pytest.fixture
def spec(spark):
    spec = replace(schemas.FROST_DEPTH, name=f"frost_{uuid.uuid4().hex}")
    ensure_table(spark, spec, location=scratch_path(spark, spec.table))
    return spec


def readings(spark, *rows):
    """Rows of (point, day, depth, value, seq)."""
    cells = [
        (p, None if d is None else dt.datetime(2024, 1, d, 12, tzinfo=dt.timezone.utc), z, v, s)
        for p, d, z, v, s in rows
    ]
    return spark.createDataFrame(
        cells, "measurepoint_id BIGINT, sample_time TIMESTAMP, depth_cm DOUBLE, temp_c DOUBLE, _seq BIGINT"
    )


def stored(spark, spec):
    rows = read_table(spark, spec).select("measurepoint_id", F.dayofmonth("sample_time"), "depth_cm", "temp_c")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def test_create_is_repeatable_and_described(spark, spec):
    ensure_table(spark, spec)
    properties = table_properties(spark, spec)
    assert properties["primary_key"] == "measurepoint_id,sample_time,depth_cm"
    assert properties["event_time"] == "sample_time"
    assert table_columns(spark, spec) == [f.name for f in spec.schema]
    assert table_columns(spark, replace(spec, name="no_such")) == []


def test_upsert_counts_and_newest_wins(spark, spec):
    assert upsert(spark, spec, readings(spark)) == 0
    first = readings(spark, (1, 1, 10.0, 0.1, 0), (1, 1, 10.0, 0.2, 1), (1, 2, 10.0, 0.3, 2))
    assert upsert(spark, spec, first) == 2
    assert upsert(spark, spec, readings(spark, (1, 2, 10.0, 0.9, 0), (2, 2, 10.0, 0.4, 1))) == 2
    assert stored(spark, spec) == [(1, 1, 10.0, 0.2), (1, 2, 10.0, 0.9), (2, 2, 10.0, 0.4)]


def test_files_are_named_once_not_for_each_row(spark, spec):
    upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.1, 0), (2, 2, 10.0, 0.2, 1)))
    root = table_location(spark, spec)
    live = snapshots.manifest(spark, spec, root)
    place = f"{root}/data/{live.first().file.split('/')[0]}"
    found = snapshots.described(spark, spec, root, place)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    named = [line for line in plan if "regexp_extract" in line]
    assert named and all(line.lstrip(" +-").startswith("Aggregate [event_date") for line in named)
    assert sorted(found.collect(), key=repr) == sorted(live.collect(), key=repr)


def test_upsert_sorts_by_time_first(spark, spec, monkeypatch):
    asked, whole = [], tables.keep_last
    monkeypatch.setattr(tables, "keep_last", lambda df, keys, order: asked.append(keys) or whole(df, keys, order))
    rows = readings(spark, (1, 1, 10.0, 0.1, 0), (None, None, 10.0, 0.1, 0), (None, None, 10.0, 0.2, 1), (1, 1, 10.0, 0.3, 1))
    assert upsert(spark, spec, rows) == 2
    assert asked == [["sample_time", "measurepoint_id", "depth_cm"]]
    assert stored(spark, spec) == [(1, 1, 10.0, 0.3), (None, None, 10.0, 0.2)]


def test_upsert_twice_is_once(spark, spec):
    rows = readings(spark, (1, 1, 10.0, 0.1, 0), (None, 3, None, 0.5, 1), (None, None, 1.0, 0.7, 2))
    for _ in range(2):
        assert upsert(spark, spec, rows) == 3
    assert len(stored(spark, spec)) == 3


def test_event_date_does_not_depend_on_the_session_zone(spark, spec):
    df = spark.sql(
        "select 1L as measurepoint_id, 10D as depth_cm, 0D as temp_c, 0L as _seq,"
        " explode(array(timestamp'2024-01-01 23:59:59.999999', timestamp'1969-12-31 00:00:00')) as sample_time"
    )
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        upsert(spark, spec, df)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    dates = {str(r.event_date) for r in read_table(spark, spec, with_date=True).select("event_date").collect()}
    assert dates == {"2024-01-01", "1969-12-31"}


def test_untouched_dates_are_not_rewritten(spark, spec):
    upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.1, 0), (1, 2, 10.0, 0.2, 1)))
    files = lambda day: {f for f in read_table(spark, spec).inputFiles() if f"event_date=2024-01-0{day}" in f}
    before = files(1)
    upsert(spark, spec, readings(spark, (2, 2, 10.0, 0.5, 0)))
    assert files(1) == before
    assert len(stored(spark, spec)) == 3


def test_dates_between_those_that_come_are_not_rewritten(spark, spec):
    """However many dates come, only theirs are replaced."""
    day = "date_add(date'2000-01-01', cast(2 * id + {} as int))"
    rows = lambda first, n: spark.range(n).selectExpr(
        "1L as measurepoint_id", f"cast({day.format(first)} as timestamp) as sample_time",
        "10D as depth_cm", "0D as temp_c", "id as _seq",
    )
    upsert(spark, spec, rows(1, 3))
    before = set(read_table(spark, spec).inputFiles())
    upsert(spark, spec, rows(0, 1100))
    assert before <= set(read_table(spark, spec).inputFiles())
    assert read_table(spark, spec).count() == 1103


def test_a_late_payload_does_not_overwrite_a_newer_one(spark):
    def frame(*rows):
        return spark.createDataFrame(rows, "k INT, ingested_at STRING, v STRING")

    stored = frame((1, "2", "old"), (2, "2", "old"), (3, "2", "old"), (4, None, "old"), (5, "2", "old"), (6, None, "old"))
    come = frame((1, "1", "new"), (2, "2", "new"), (3, "3", "new"), (4, "1", "new"), (5, None, "new"), (6, None, "new"), (7, "1", "new"))
    found = {r.k: r.v for r in merged(stored, come, ["k"]).collect()}
    assert found == {1: "old", 2: "new", 3: "new", 4: "new", 5: "old", 6: "new", 7: "new"}
    plain = merged(stored.drop("ingested_at"), come.drop("ingested_at"), ["k"]).collect()
    assert {r.v for r in plain} == {"new"} and len(plain) == 7


def beside(monkeypatch, other):
    """Let another writer commit between an upsert's merge and its own commit, once."""
    real, turns = snapshots.commit, [other]

    def commit(*args):
        if turns:
            turns.pop()()
        return real(*args)

    monkeypatch.setattr(snapshots, "commit", commit)


def test_writers_of_different_dates_both_succeed(spark, spec, monkeypatch):
    upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.1, 0), (1, 2, 10.0, 0.2, 1)))
    merges, real = [], snapshots.write_files
    monkeypatch.setattr(snapshots, "write_files", lambda *a: merges.append(1) or real(*a))
    beside(monkeypatch, lambda: upsert(spark, spec, readings(spark, (1, 2, 10.0, 0.9, 0), (5, 3, 10.0, 0.5, 1))))
    upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.8, 0)))
    assert stored(spark, spec) == [(1, 1, 10.0, 0.8), (1, 2, 10.0, 0.9), (5, 3, 10.0, 0.5)]
    assert len(merges) == 2  # neither had to begin anew
    assert table_versions(spark, spec) == [1, 2, 3]


def test_writers_of_one_date_lose_nothing(spark, spec, monkeypatch):
    upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.1, 0), (2, 1, 10.0, 0.2, 1)))
    beside(monkeypatch, lambda: upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.7, 0), (3, 1, 10.0, 0.3, 1))))
    upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.9, 0), (4, 1, 10.0, 0.4, 1)))
    assert stored(spark, spec) == [(1, 1, 10.0, 0.9), (2, 1, 10.0, 0.2), (3, 1, 10.0, 0.3), (4, 1, 10.0, 0.4)]


def test_writers_at_the_same_time(spark, spec):
    def write(point):
        return upsert(spark, spec, readings(spark, (point, 1, 10.0, point / 10, 0), (0, 1 + point, 10.0, 0.0, 1)))

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(write, range(1, 5))) == [2] * 4
    assert len(stored(spark, spec)) == 8


def test_a_reader_keeps_to_its_version(spark, spec):
    upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.1, 0), (2, 2, 10.0, 0.2, 1)))
    old = read_table(spark, spec)
    upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.9, 0), (3, 3, 10.0, 0.3, 1)))
    assert old.count() == 2 and old.where("temp_c = 0.9").isEmpty()
    assert {r.temp_c for r in read_table(spark, spec, version=1).collect()} == {0.1, 0.2}
    assert {r.temp_c for r in read_table(spark, spec).collect()} == {0.9, 0.2, 0.3}
    with pytest.raises(ValueError, match="no version 9"):
        read_table(spark, spec, version=9)


def test_old_versions_and_their_files_go(spark, spec):
    for value in (0.1, 0.2, 0.3):
        upsert(spark, spec, readings(spark, (1, 1, 10.0, value, 0), (int(value * 10), 2, 10.0, 0.0, 1)))
    assert expire_versions(spark, spec, keep=2) == 0  # the files are younger than a day
    assert table_versions(spark, spec) == [2, 3]
    assert expire_versions(spark, spec, keep=1, older_than_hours=0) > 0
    assert table_versions(spark, spec) == [3]
    assert stored(spark, spec) == [(1, 1, 10.0, 0.3), (1, 2, 10.0, 0.0), (2, 2, 10.0, 0.0), (3, 2, 10.0, 0.0)]
    assert expire_versions(spark, spec, keep=1, older_than_hours=0) == 0


def test_a_note_that_was_never_filled_is_passed_over(spark, spec, monkeypatch):
    upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.1, 0)))
    root = table_location(spark, spec)
    snapshots.create_note(spark, snapshots._note(root, 2), "")
    monkeypatch.setattr(snapshots, "NOTE_SECONDS", -1)  # as if its writer were long gone
    assert stored(spark, spec) == [(1, 1, 10.0, 0.1)]
    upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.2, 0)))
    assert stored(spark, spec) == [(1, 1, 10.0, 0.2)]
    assert table_versions(spark, spec) == [1, 3]


def test_only_files_that_hold_a_key_are_rewritten(spark, spec):
    """One day in many files, of ranges of points: a late row costs one of them."""
    rows = spark.range(4000).selectExpr(
        "id div 10 as measurepoint_id", "timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,cast(id % 10 as int)) as sample_time",
        "10D as depth_cm", "0D as temp_c", "id as _seq",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        upsert(spark, spec, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    before = set(read_table(spark, spec).inputFiles())
    assert len(before) >= 4
    late = rows.where("id = 1234").withColumn("temp_c", F.lit(1.5))
    upsert(spark, spec, late)
    after = set(read_table(spark, spec).inputFiles())
    assert len(before - after) == 1
    assert read_table(spark, spec).agg(F.count("*"), F.sum("temp_c")).first() == (4000, 1.5)
    # A new key that lies in the range of a file is added beside it.
    new = rows.where("id = 1234").withColumn("sample_time", F.expr("sample_time + interval 1 second"))
    upsert(spark, spec, new)
    assert after < set(read_table(spark, spec).inputFiles())
    assert read_table(spark, spec).count() == 4001


def test_zones_tell_without_reading(spark, spec):
    assert table_zones(spark, spec).isEmpty()
    upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.1, 0), (1, 2, 10.0, 0.2, 1), (2, 2, 20.0, 0.2, 1), (None, None, 1.0, 0.0, 2)))
    upsert(spark, spec, readings(spark, (1, 2, 10.0, 0.9, 0), (7, 2, 10.0, 0.9, 1)))
    found = {str(r.event_date): (r["rows"], r.first, r.last) for r in table_zones(spark, spec).collect()}
    rows = read_table(spark, spec, with_date=True).groupBy("event_date").agg(
        F.count("*").alias("n"), F.min("sample_time").alias("a"), F.max("sample_time").alias("b"))
    assert found == {str(r.event_date): (r.n, r.a, r.b) for r in rows.collect()}


def test_failed_write_leaves_the_table(spark, spec):
    upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.1, 0)))
    broken = readings(spark, (1, 1, 10.0, 0.9, 0)).withColumn("temp_c", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        upsert(spark, spec, broken)
    assert stored(spark, spec) == [(1, 1, 10.0, 0.1)]


def test_interrupted_upsert_leaves_the_table(spark, spec, monkeypatch):
    upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.1, 0)))

    def lost(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(snapshots, "create_note", lost)
    with pytest.raises(RuntimeError):
        upsert(spark, spec, readings(spark, (1, 1, 10.0, 0.2, 0)))
    monkeypatch.undo()
    # Another catalog, as a new process would have, knows nothing of the table.
    place = table_location(spark, spec)
    spark.sql(f"DROP TABLE {spec.table}")
    ensure_table(spark, spec, location=place)
    assert stored(spark, spec) == [(1, 1, 10.0, 0.1)]
    upsert(spark, spec, readings(spark, (3, 1, 10.0, 0.3, 0)))
    assert [r[0] for r in stored(spark, spec)] == [1, 3]
    assert expire_versions(spark, spec, older_than_hours=0) > 0  # what the lost one left
    assert [r[0] for r in stored(spark, spec)] == [1, 3]


def test_upsert_needs_an_order(spark, spec):
    rows = readings(spark, (1, 1, 10.0, 0.1, 0)).drop("_seq")
    with pytest.raises(ValueError):
        upsert(spark, spec, rows)
    assert upsert(spark, spec, rows, order=()) == 1


def test_align(spark, spec):
    df = spark.createDataFrame([(1, 2.0, 3)], "extra INT, depth_cm DOUBLE, measurepoint_id INT")
    kept, dropped = align_to_table(spark, df, spec)
    assert (kept.columns, dropped) == (["depth_cm", "measurepoint_id"], ["extra"])
    unknown = replace(spec, name="no_such")
    assert align_to_table(spark, df, unknown, ["extra"])[0].columns == ["extra"]
    assert align_to_table(spark, df, unknown) == (df, [])


def test_csv_has_a_header(spark, tmp_path):
    write_csv(spark.createDataFrame([(1, "a")], "n INT, s STRING"), str(tmp_path / "out"))
    texts = {p.read_text() for p in (tmp_path / "out").glob("*.csv")}
    assert "n,s\n1,a\n" in texts


# --- Refresh -----------------------------------------------------------------------


def test_refresh_goes_on_after_a_failure(spark, spec):
    def broken():
        raise OSError("source is down")

    good = Feed("good", spec, lambda: readings(spark, (1, 1, 10.0, 0.1, 0)))
    bad = Feed("bad", replace(spec, name=spec.name + "b"), broken)
    report = {r.source: (r["rows"], r.error) for r in refresh(spark, [bad, good]).collect()}
    assert report == {"good": (1, None), "bad": (None, "source is down")}
    with pytest.raises(RuntimeError, match="source is down"):
        refresh(spark, [bad])
    nothing = replace(good, name="nothing", rows=lambda: readings(spark))
    assert [r["rows"] for r in refresh(spark, [nothing]).collect()] == [0]
    complaint = spark.createDataFrame([("half a file",)], "error STRING")
    with pytest.raises(RuntimeError, match="half a file"):
        refresh(spark, [replace(nothing, errors=lambda: complaint)])


def test_no_step_of_a_feed_stops_the_others(spark, spec):
    def silent():
        raise ValueError

    def unreadable():
        return spark.range(1).select(F.raise_error(F.lit("cannot be read")).alias("error"))

    fine = lambda name, day, **more: Feed(
        name, replace(spec, name=f"{spec.name}_{name}"), lambda: readings(spark, (1, day, 10.0, 0.1, 0)), **more
    )
    feeds = [
        Feed("mute", replace(spec, name=spec.name + "_mute"), silent),
        fine("a", 1, rejects=silent),
        fine("b", 2, errors=unreadable),
        fine("c", 3, rejects=unreadable, errors=silent),
        fine("d", 4),
    ]
    report = refresh(spark, feeds, quarantine=scratch_path(spark, "quarantine")).collect()
    assert {r.source: r["rows"] for r in report if r["rows"]} == {n: 1 for n in "abcd"}
    failed = [(r.source, r.error) for r in report if r.error]
    assert [(s, e) for s, e in failed if "cannot" not in e] == [("mute", "ValueError()"), ("a", "ValueError()"), ("c", "ValueError()")]
    assert [s for s, e in failed if "cannot be read" in e] == ["b", "c"]


def test_refresh_from_landing(spark, tmp_path):
    for name, body in (("w", WEATHER), ("f", FROST), ("x", "<html>")):
        (tmp_path / f"{name}.json").write_text(body)
    feeds = landing_feeds(
        weather=read_landing(spark, str(tmp_path / "[wx].json")),
        frost=read_landing(spark, str(tmp_path / "f.json")),
        suffix=f"_{uuid.uuid4().hex}",
    )
    bad = str(tmp_path / "quarantine")
    for _ in range(2):
        report = refresh(
            spark, feeds, align=True, location=scratch_path(spark, "refresh"), quarantine=bad
        )
    rejected = {(r.reject_reason, r.body) for r in spark.read.parquet(f"{bad}/weather").collect()}
    assert rejected == {("not JSON", "<html>"), ("identifier is not whole", "5.5")}
    assert spark.read.parquet(f"{bad}/weather").count() == 2
    rows = sorted(((r.source, r["rows"], r.error) for r in report.collect()), key=repr)
    assert rows == [("frost_depth", 2, None), ("weather", 2, None), ("weather", None, "not JSON")]
    assert total_rows(report).first().total_rows == 4
    weather = read_table(spark, feeds[0].spec).where("measurepoint_id = 243").first()
    assert (weather.surface_ice, weather.surface_snow, weather.surface_water) == (True, True, False)


def test_refresh_drops_shuffles_when_a_query_ends(spark, spec):
    rows = readings(spark, *[(p, 1 + p % 3, 10.0, 0.1, p) for p in range(20)])
    seen = []

    def told(frame):
        seen.append(spark.conf.get(SHUFFLE_CLEANUP))
        return frame

    landed = Feed("own", spec, told, lambda parsed: told(parsed).limit(0).select(F.lit("").alias("error")), parsed=lambda: told(rows))
    assert refresh(spark, [landed]).first()["rows"] == 20
    assert seen == ["true"] * 3 and spark.conf.get(SHUFFLE_CLEANUP) == "false"
    with pytest.raises(RuntimeError):
        refresh(spark, [replace(landed, parsed=lambda: 1 / 0)])
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        assert refresh(spark, [landed]).first()["rows"] == 20
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)
    assert len(stored(spark, spec)) == 20


def test_landed_files_are_packed_and_small(spark, monkeypatch):
    monkeypatch.setattr(ingest, "PACKED_PAYLOADS", 3)
    bodies = [f'{{"n": "{i}", "of": "\u00e6\u00f8"}}' for i in range(20)]
    landed = spark.createDataFrame([(b, i < 9) for i, b in enumerate(bodies)], "body STRING, half BOOLEAN")
    path = ingest._write_lines(landed.coalesce(1), "packed", "half", packed=True)
    found = read_landing(spark, path, json_lines=True)
    assert sorted(r.body for r in found.select("body").collect()) == sorted(bodies)
    assert found.select("payload_id").distinct().count() == 20
    files = found.groupBy(F.substring_index("payload_id", "#", 1).alias("file")).count().collect()
    assert all(f.file.endswith(".gz") and f["count"] <= 3 for f in files)


def test_refresh_queries_land_packed_files(spark, sf_dir, monkeypatch):
    asked, whole = [], ingest._write_lines
    monkeypatch.setattr(ingest, "_write_lines", lambda *a, **k: asked.append(whole(*a, **k)) or asked[-1])
    assert len(ingest._usual_feeds(spark, sf_dir, "_x")) == 4 == len(asked)
    for path in asked:
        assert all(f.endswith(".gz") for f in spark.read.text(path).inputFiles())


# --- Streaming -----------------------------------------------------------------------


@pytest.mark.parametrize("json_lines", [False, True])
def test_stream(spark, spec, tmp_path, json_lines):
    folder, progress, bad = tmp_path / "in", str(tmp_path / "progress"), str(tmp_path / "bad")
    folder.mkdir()

    def run():
        landed = stream_landing(spark, str(folder), max_files=1, json_lines=json_lines)
        stream_to_table(
            landed, spec, extract.frost_depths, progress, json_lines=json_lines, quarantine=bad
        ).awaitTermination()

    (folder / "a.json").write_text(FROST)
    (folder / "b.json").write_text("<html>")
    run()
    assert stored(spark, spec) == [(226, 1, 10.0, 0.7), (226, 1, 20.0, 1.1)]
    (folder / "c.json").write_text(FROST.replace("0.7", "0.8"))
    run()
    assert stored(spark, spec) == [(226, 1, 10.0, 0.8), (226, 1, 20.0, 1.1)]
    assert [r.reject_reason for r in spark.read.parquet(bad).collect()] == ["not JSON"]
