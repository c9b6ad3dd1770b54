"""Weather rows with their lags, kept up batch by batch.

Lags count rows back, so a batch's first rows need stored ones, and a row that comes late
changes the lags of up to 24 rows behind it. Beside the table lies its tail, the last 24
rows of every point. A point whose rows all come behind its tail is answered from that; of
other points the stored rows from the 24th before the first of the batch on are read, and
those whose lags have changed are stored again.

The tail tells the version of the table it belongs to. One that does not fit, because a
run died in between or another wrote the table, is made anew from the table.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from roadcast import schemas
from roadcast.operators.dedup import input_order, keep_last
from roadcast.operators.joins import skewproof_join
from roadcast.operators.lag import _LAST, LAG_COLUMNS, LAG_ROWS, with_lags
from roadcast.schemas import TableSpec
from roadcast.session import read_note, remove_path, scratch_path, write_note
from roadcast.sources.tables import (
    as_stored,
    ensure_table,
    merged,
    read_table,
    table_location,
    table_versions,
    upsert,
)

LAG_NAMES = tuple(f"{c}_lag_{n}h" for c in LAG_COLUMNS for n in LAG_ROWS)
WEATHER_LAGGED = replace(
    schemas.WEATHER_OBSERVATION,
    name="weather_lagged",
    columns=schemas.WEATHER_OBSERVATION.columns + ", " + ", ".join(f"{n} DOUBLE" for n in LAG_NAMES),
    description="Road weather observations with the readings before them",
)
POINT, TIME = "measurepoint_id", "sample_time"
REACH = max(LAG_ROWS)


def _place(time: str = TIME) -> Column:
    """Rows without a time come last."""
    return F.coalesce(F.col(time), F.expr(_LAST))


def last_rows(rows: DataFrame) -> DataFrame:
    """The last rows of every point that a lag may reach."""
    order = Window.partitionBy(POINT).orderBy(_place().desc())
    nth = rows.where(F.col(POINT).isNotNull()).withColumn("_nth", F.row_number().over(order))
    return nth.where(F.col("_nth") <= REACH).drop("_nth")


def _tail_note(spark: SparkSession, spec: TableSpec) -> str:
    return f"{table_location(spark, spec)}/_tail/current"


def _read_tail(spark: SparkSession, spec: TableSpec, version: int) -> DataFrame:
    """The tail of the table's newest version."""
    folder, _, of = (read_note(spark, _tail_note(spark, spec)) or "").partition(" ")
    if folder and int(of) == version:
        place = f"{table_location(spark, spec)}/_tail/{folder}"
        return spark.read.schema(spec.schema).parquet(place)
    return last_rows(read_table(spark, spec))


def _write_tail(spark: SparkSession, spec: TableSpec, rows: DataFrame, version: int) -> None:
    old = (read_note(spark, _tail_note(spark, spec)) or "").partition(" ")[0]
    folder = uuid.uuid4().hex
    rows.hint("rebalance").write.parquet(f"{table_location(spark, spec)}/_tail/{folder}")
    write_note(spark, _tail_note(spark, spec), f"{folder} {version}")
    if old:
        remove_path(spark, f"{table_location(spark, spec)}/_tail/{old}")


def upsert_with_lags(
    spark: SparkSession,
    weather: DataFrame,
    spec: TableSpec = WEATHER_LAGGED,
    *,
    location: str | None = None,
    **lag_options: int,
) -> int:
    """Store a batch of weather rows with their lags, and mend the lags of the stored rows
    behind those that come late; returns how many rows were written."""
    ensure_table(spark, spec, location=location)
    keys = list(spec.primary_key)
    bare = replace(spec, columns=schemas.WEATHER_OBSERVATION.columns)
    copy = scratch_path(spark, "lag-batch")
    lagged_copy, tail_copy = scratch_path(spark, "lag-rows"), scratch_path(spark, "lag-tail")
    try:
        rows = as_stored(keep_last(weather, keys, input_order(weather)), bare).drop("event_date")
        rows.write.parquet(copy)
        batch = spark.read.schema(bare.schema).parquet(copy)
        version = max(table_versions(spark, spec), default=0)
        tail = _read_tail(spark, spec, version)
        known = _around(spark, spec, batch, tail)
        new = batch.withColumns({"_new": F.lit(True), "_was": F.lit(None).cast(known.schema["_was"].dataType)})
        both = merged(known, new.select(*known.columns), keys)
        lagged = with_lags(both.withColumn("_seq", F.lit(0)), **lag_options).drop("_seq")
        now = F.struct(*[F.col(n).alias(n) for n in LAG_NAMES])
        mended = F.col("_was").isNotNull() & ~F.col("_was").eqNullSafe(now)
        lagged = lagged.withColumn("_changed", (F.col("_new") | mended).cast("int")).drop("_new", "_was")
        # By whether a row is to be stored, so that the upsert takes these from here.
        lagged.write.partitionBy("_changed").parquet(lagged_copy)
        lagged = spark.read.schema(lagged.schema).parquet(lagged_copy)
        changed = lagged.where(F.col("_changed") == 1).select(*spec.schema.names)
        last_rows(lagged).select(*spec.schema.names).write.parquet(tail_copy)
        points = batch.select(POINT).distinct()
        others = tail.join(points, POINT, "left_anti").select(*spec.schema.names)
        left = others.unionByName(spark.read.schema(spec.schema).parquet(tail_copy))
        count = upsert(spark, spec, changed, order=(), kept=True)
        if count:
            _write_tail(spark, spec, left, max(table_versions(spark, spec)))
        return count
    finally:
        for path in (copy, lagged_copy, tail_copy):
            remove_path(spark, path)


def _around(spark: SparkSession, spec: TableSpec, batch: DataFrame, tail: DataFrame) -> DataFrame:
    """The stored rows that the lags of a batch, and of what follows its rows, reach, with
    ``_new``, false, and ``_was``, the stored lags of rows that may follow one."""
    columns = schemas.WEATHER_OBSERVATION.schema.names
    was = F.struct(*[F.col(n).alias(n) for n in LAG_NAMES])
    first = batch.where(F.col(POINT).isNotNull()).groupBy(POINT).agg(F.min(_place()).alias("_first"))
    newest = tail.groupBy(POINT).agg(F.max(_place()).alias("_newest"))
    seen = first.join(newest, POINT)
    late = seen.where(F.col("_first") <= F.col("_newest")).select(POINT, "_first")
    on_time = seen.where(F.col("_first") > F.col("_newest")).select(POINT)
    plain = skewproof_join(tail, on_time, [POINT], "left_semi").select(*columns)
    plain = plain.withColumns({"_new": F.lit(False), "_was": F.lit(None)})
    if late.isEmpty():
        return plain.withColumn("_was", F.lit(None).cast(tail.select(was.alias("s")).schema["s"].dataType))
    stored = skewproof_join(read_table(spark, spec), late, [POINT], "inner")
    before = last_rows(stored.where(_place() < F.col("_first"))).withColumn("_was", F.lit(None))
    behind = stored.where(_place() >= F.col("_first")).withColumn("_was", was)
    history = behind.unionByName(before).withColumn("_new", F.lit(False))
    return history.select(*columns, "_new", "_was").unionByName(plain)
