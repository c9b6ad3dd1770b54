"""Bring several keyed tables up to date, each on its own."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadcast import schemas
from roadcast.schemas import TableSpec
from roadcast.sources import extract
from roadcast.sources.forecasts import parsed_errors, parsed_forecast_rows
from roadcast.sources.landing import listed_faults
from roadcast.session import SCRATCH_CODEC, remove_path, scratch_path, shuffles_dropped
from roadcast.sources.tables import align_to_table, ensure_table, upsert

REPORT_COLUMNS = "source STRING, rows BIGINT, error STRING"


@dataclass(frozen=True)
class Feed:
    """One source and the table it fills. Everything is called within the job, so a
    source that cannot be read costs its own table only. With ``parsed``, its payloads
    are parsed once, kept in the shared folder and handed to the other steps, which take
    no argument without it. ``done`` is called once all of them have succeeded."""

    name: str
    spec: TableSpec
    rows: Callable[..., DataFrame]
    errors: Callable[..., DataFrame] | None = None
    rejects: Callable[..., DataFrame] | None = None
    parsed: Callable[[], DataFrame] | None = None
    done: Callable[..., None] | None = None


def refresh(
    spark: SparkSession,
    feeds: Iterable[Feed],
    *,
    align: bool = False,
    location: str | None = None,
    quarantine: str | None = None,
    idle: Iterable[str] = (),
) -> DataFrame:
    """Upsert every feed and report ``(source, rows, error)``: one row per feed that was
    stored, one per step of a feed that failed, and one per error a feed lists. Feeds are
    independent and go on side by side. ``align`` drops columns the table does not have;
    new tables go under ``location`` if given, else where the catalog puts them. What a
    feed had to reject is written under ``quarantine``, replacing what an earlier run
    found. ``idle`` names sources that had nothing new; they are reported with 0 rows.

    Raises only when no feed brought any row and there was an error.
    """

    def settled(feed: Feed) -> tuple[DataFrame, ...]:
        if feed.parsed is None:
            return ()
        frame, path = feed.parsed(), scratch_path(spark, f"{feed.name}-parsed")
        frame.write.option("compression", SCRATCH_CODEC).parquet(path)
        return (spark.read.schema(frame.schema).parquet(path),)

    def store(feed: Feed, *parsed: DataFrame) -> int:
        place = f"{location}/{feed.spec.table}" if location else None
        ensure_table(spark, feed.spec, location=place)
        rows = feed.rows(*parsed)
        if align:
            rows = _aligned(spark, rows, feed.spec)
        return upsert(spark, feed.spec, rows)

    def keep_rejects(feed: Feed, *parsed: DataFrame) -> None:
        if quarantine and feed.rejects is not None:
            feed.rejects(*parsed).write.mode("overwrite").parquet(f"{quarantine}/{feed.name}")

    def list_errors(feed: Feed, *parsed: DataFrame) -> DataFrame | None:
        if feed.errors is None:
            return None
        # Written now, so that a source that cannot be read fails here, not the report.
        found = feed.errors(*parsed).select(F.lit(feed.name).alias("source"), "error")
        path = scratch_path(spark, "errors")
        found.write.parquet(path)
        return spark.read.schema("source STRING, error STRING").parquet(path)

    def run(feed: Feed) -> tuple[list[tuple], list[DataFrame]]:
        outcomes: list[tuple[str, int | None, str | None]] = []
        listed: list[DataFrame] = []
        failed = False

        def attempt(step: Callable, *given) -> object:
            nonlocal failed
            try:
                return step(feed, *given)
            except Exception as failure:  # one bad source must not stop the others
                failed = True
                outcomes.append((feed.name, None, str(failure) or repr(failure)))

        parsed = attempt(settled)
        if not failed:
            count = attempt(store, *parsed)
            if count is not None:
                outcomes.append((feed.name, count, None))
            attempt(keep_rejects, *parsed)
            errors = attempt(list_errors, *parsed)
            if errors is not None:
                listed.append(errors)
            if feed.done is not None and not failed:
                attempt(lambda feed, *given: feed.done(*given), *parsed)
            for copy in parsed:
                _forget(spark, copy)
        return outcomes, listed

    feeds = list(feeds)
    with shuffles_dropped(spark), ThreadPoolExecutor(max(1, len(feeds))) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(run), feeds))
    outcomes = [(name, 0, None) for name in idle] + [o for own, _ in found for o in own]
    listed = [frame for _, frames in found for frame in frames]
    if not any(rows for _, rows, _ in outcomes):
        failed = [f"{name}: {error}" for name, _, error in outcomes if error]
        # At most one listed error per feed is looked at.
        failed += [f"{e.source}: {e.error}" for frame in listed for e in frame.take(1)]
        if failed:
            raise RuntimeError("; ".join(failed))
    report = spark.createDataFrame(outcomes, REPORT_COLUMNS)
    for errors in listed:
        report = report.unionByName(errors.withColumn("rows", F.lit(None).cast("bigint")))
    return report


def _forget(spark: SparkSession, copy: DataFrame) -> None:
    """Remove a parsed copy. What is left of it was written before."""
    for path in {file.rpartition("/")[0] for file in copy.inputFiles()}:
        remove_path(spark, path)


def _aligned(spark: SparkSession, rows: DataFrame, spec: TableSpec) -> DataFrame:
    order = [c for c in extract.ORDER if c in rows.columns]
    kept, _ = align_to_table(spark, rows, spec)
    return rows.select(*dict.fromkeys([*kept.columns, *order]))


def total_rows(report: DataFrame) -> DataFrame:
    return report.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"))


def landing_feeds(
    weather: DataFrame | None = None,
    situations: DataFrame | None = None,
    frost: DataFrame | None = None,
    forecasts: DataFrame | None = None,
    locations: DataFrame | None = None,
    suffix: str = "",
) -> list[Feed]:
    """The usual four feeds from landed payload frames; leave out what is not polled.
    ``suffix`` is added to the table names."""
    feeds = []
    for name, spec, landed, parse, flatten in (
        ("weather", schemas.WEATHER_OBSERVATION, weather, extract.parsed_weather, extract.weather_rows),
        ("situations", schemas.SITUATION, situations, extract.parsed_situations, extract.situation_rows),
        ("frost_depth", schemas.FROST_DEPTH, frost, extract.parsed_frost, extract.frost_rows),
    ):
        if landed is not None:
            feeds.append(
                Feed(
                    name,
                    replace(spec, name=spec.name + suffix),
                    lambda parsed, flatten=flatten: flatten(parsed.where("_answered")),
                    lambda parsed: listed_faults(parsed).select(F.col("reject_reason").alias("error")),
                    lambda parsed, name=name: _rejects(name, parsed),
                    lambda landed=landed, parse=parse: parse(landed),
                )
            )
    if forecasts is not None:
        feeds.append(
            Feed(
                "forecast",
                replace(schemas.POINT_FORECAST, name=schemas.POINT_FORECAST.name + suffix),
                lambda parsed: parsed_forecast_rows(parsed, locations),
                lambda parsed: parsed_errors(parsed, locations).select(
                    F.concat_ws(": ", "location_id", "error").alias("error")
                ),
                listed_faults,
                lambda: extract.parsed_forecasts(forecasts),
            )
        )
    return feeds


def _rejects(name: str, parsed: DataFrame) -> DataFrame:
    """Unusable bodies and parts of bodies, and the single rows whose identifier is not a
    whole number."""
    bodies = listed_faults(parsed)
    if name == "situations":
        return bodies
    found = extract.fractional_rows(parsed.where("_answered"), frost=name == "frost_depth")
    rows = found.select(
        "payload_id",
        "ingested_at",
        F.lit("identifier is not whole").alias("reject_reason"),
        F.col("measurepoint_id").alias("body"),
    )
    return bodies.unionByName(rows, allowMissingColumns=True)
