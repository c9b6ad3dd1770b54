"""Keyed tables: create, read, align, upsert.

The catalog has a table's columns and properties; which files hold its rows is told by
numbered versions (see ``snapshots``), so `read_table` is the way to read it. Each primary
key contains the event time, so a key only ever lives on one event date.

An upsert reads the key columns of the files that may hold an incoming key, rewrites those
that do hold one, adds files for what is new, and carries all other files over.

Which row of a key stays: where the table records ``ingested_at``, the one ingested last,
so that a payload that comes late does not overwrite a newer one; of rows ingested at the
same time, and in tables without that column, the one written last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadcast.functions.clean import keep_columns
from roadcast.operators.dedup import input_order, keep_last
from roadcast.operators.joins import same_keys
from roadcast.schemas import TableSpec
from roadcast.session import SCRATCH_CODEC, remove_path, scratch_path
from roadcast.sources import snapshots

INGESTED = "ingested_at"
# How often a writer starts again because others changed the same dates meanwhile.
ATTEMPTS = 20


def ensure_table(spark: SparkSession, spec: TableSpec, *, location: str | None = None) -> str:
    """Create the table unless it exists; key and event time go into its properties.
    Versions that ``location`` holds already, as known to another catalog, count."""
    quoted = {
        "primary_key": ",".join(spec.primary_key),
        "event_time": spec.event_time,
        "description": spec.description,
        "online_enabled": str(spec.online_enabled).lower(),
    }
    properties = ", ".join(f"'{k}' = '{v}'" for k, v in quoted.items())
    at = f"LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {spec.table} ({spec.columns}, event_date DATE) "
        f"USING parquet PARTITIONED BY (event_date) {at} TBLPROPERTIES ({properties})"
    )
    return spec.table


def table_columns(spark: SparkSession, spec: TableSpec) -> list[str]:
    """Column names of the stored table, or none when there is no such table."""
    if not spark.catalog.tableExists(spec.table):
        return []
    return [c for c in spark.table(spec.table).columns if c != "event_date"]


def table_properties(spark: SparkSession, spec: TableSpec) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {spec.table}").collect()}


def read_table(
    spark: SparkSession, spec: TableSpec, *, with_date: bool = False, version: int | None = None
) -> DataFrame:
    """The table of that name, as last written by any session or as of a version of its
    own. What is written later does not change the frame. ``with_date`` keeps the
    partition column, for filters that should prune by it."""
    root = table_location(spark, spec)
    files = snapshots.manifest(spark, spec, root, version)
    df = snapshots.rows_of(spark, spec, root, files)
    return df if with_date else df.drop("event_date")


def table_versions(spark: SparkSession, spec: TableSpec) -> list[int]:
    """The versions that can be read, the newest last."""
    return snapshots.versions(spark, table_location(spark, spec))


def table_zones(spark: SparkSession, spec: TableSpec, *, version: int | None = None) -> DataFrame:
    """What is known of each event date without reading a row: ``event_date, files, rows,
    first, last`` (event time), ``first_run, last_run, null_runs`` and ``last_ingested``."""
    files = snapshots.manifest(spark, spec, table_location(spark, spec), version)
    return files.groupBy("event_date").agg(
        F.count("*").alias("files"),
        *[F.sum(c).alias(c) for c in ("rows", "null_runs")],
        *[F.min(c).alias(c) for c in ("first", "first_run")],
        *[F.max(c).alias(c) for c in ("last", "last_run", "last_ingested")],
    )


def expire_versions(
    spark: SparkSession, spec: TableSpec, *, keep: int = 1, older_than_hours: float = 24.0
) -> int:
    """Drop all but the newest versions and the files that only they had."""
    return snapshots.expire(spark, spec, table_location(spark, spec), keep, older_than_hours)


def align_to_table(
    spark: SparkSession,
    df: DataFrame,
    spec: TableSpec,
    fallback: Sequence[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Keep the columns the table has, in the frame's order, and name the dropped
    ones. Without a stored schema the fallback list counts; without either the
    frame stays as it is."""
    allowed = table_columns(spark, spec) or list(fallback or [])
    if not allowed:
        return df, []
    return keep_columns(df, allowed), [c for c in df.columns if c not in allowed]


def as_stored(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The table's columns in its types, null where the frame has none, with the
    event date. Columns that only record input order are dropped."""
    columns = [
        (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType))
        .alias(f.name)
        for f in spec.schema
    ]
    return df.select(*columns, _utc_date(F.col(spec.event_time).cast("timestamp")).alias("event_date"))


def _utc_date(time: Column) -> Column:
    """The day in UTC whatever the session's zone, so a key cannot move between
    partitions."""
    days = F.floor(F.unix_micros(time) / F.lit(86_400e6))
    return F.date_from_unix_date(days.cast("int"))


def merged(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of each key that stays, of the existing and the incoming ones; both must
    hold one row per key.

    Anti-joins rather than a dedup of both together: the existing rows are not sorted,
    and when the incoming keys are few they are not shuffled either.
    """
    keys = list(keys)
    if INGESTED not in existing.columns or INGESTED not in incoming.columns:
        new_keys = incoming.select(*keys)
        kept = existing.join(new_keys, same_keys(existing, new_keys, keys), "left_anti")
        return kept.unionByName(incoming)
    new, old = (df.select(*keys, F.col(INGESTED).alias("_other")) for df in (incoming, existing))
    # A row without the time counts as older than any other.
    later = existing[INGESTED].isNotNull() & (
        new["_other"].isNull() | (existing[INGESTED] > new["_other"])
    )
    kept = existing.join(new, same_keys(existing, new, keys) & ~later, "left_anti")
    late = old["_other"].isNotNull() & (
        incoming[INGESTED].isNull() | (incoming[INGESTED] < old["_other"])
    )
    fresh = incoming.join(old, same_keys(incoming, old, keys) & late, "left_anti")
    return kept.unionByName(fresh)


def upsert(
    spark: SparkSession,
    spec: TableSpec,
    df: DataFrame,
    *,
    dedup_keys: Sequence[str] | None = None,
    order: Sequence[str] | None = None,
    kept: bool = False,
) -> int:
    """Insert rows, one staying per key (see above); returns the number of rows after
    the dedup of ``df`` (on the primary key unless told otherwise). An empty ``order``
    says that ``df`` holds one row per key already; if ``kept`` as well, that it only reads
    files that stay meanwhile, so that its rows are not written to the shared folder again.

    All files of a version are written before its number is taken, so a failure leaves
    the table as it was. A writer that finds the number taken by another goes on from
    there where that one changed other dates, and else merges anew.
    """
    keys = list(dedup_keys or spec.primary_key)
    if order is None:
        order = input_order(df)
        if not order:
            raise ValueError("upsert needs columns that order the rows, or order=()")
    root = table_location(spark, spec)
    if order:
        # Rows are sorted by the time first, which tells most of them apart.
        df = keep_last(df, sorted(keys, key=lambda k: k != spec.event_time), order)
    latest = as_stored(df, spec)
    if kept and not order:
        count = latest.count()
        if count:
            _merge(spark, spec, root, latest)
        return count
    incoming_path = scratch_path(spark, f"{spec.table}-incoming")
    try:
        # Written once, as it is read several times below and may be costly to derive.
        latest.write.option("compression", SCRATCH_CODEC).parquet(incoming_path)
        incoming = spark.read.schema(latest.schema).parquet(incoming_path)
        count = incoming.count()
        if count:
            _merge(spark, spec, root, incoming)
    finally:
        remove_path(spark, incoming_path)
    return count


def on_dates(df: DataFrame, dates: Sequence) -> DataFrame:
    """The rows, which have ``event_date``, of some dates, None among them if given."""
    date = F.col("event_date")
    hit = date.isNull() if None in dates else F.lit(False)
    days = sorted(d for d in dates if d is not None)
    return df.where(hit | date.isin(*days) if days else hit)


def replace_dates(spark: SparkSession, spec: TableSpec, df: DataFrame, dates: Sequence) -> None:
    """Put rows in the place of all that a table has on some event dates; ``df`` has rows
    of these only, one per key. Other dates' files are carried over."""
    root = table_location(spark, spec)
    rows = on_dates(as_stored(df, spec), dates)
    added = snapshots.write_files(spark, spec, root, rows)
    for _ in range(ATTEMPTS):
        base = snapshots.latest(spark, root)
        live = snapshots.manifest(spark, spec, root, base)
        replaced = on_dates(live, dates).select("file")
        if snapshots.commit(spark, spec, root, _with(live, replaced, added), snapshots.next_free(spark, root)):
            return
    raise RuntimeError(f"{spec.table}: other writers keep committing")


def _merge(spark: SparkSession, spec: TableSpec, root: str, incoming: DataFrame) -> None:
    """Commit a version that has the incoming rows."""
    for _ in range(ATTEMPTS):
        base = snapshots.latest(spark, root)
        live = snapshots.manifest(spark, spec, root, base)
        names = _holding(spark, spec, root, live, incoming) if base else []
        replaced = spark.createDataFrame([(n,) for n in names], "file STRING")
        rows = incoming
        if names:
            rows = merged(snapshots.rows_of(spark, spec, root, replaced), incoming, spec.primary_key)
        added = snapshots.write_files(spark, spec, root, rows)
        number = base + 1
        while not snapshots.commit(spark, spec, root, _with(live, replaced, added), number):
            newest = snapshots.latest(spark, root)
            if newest > base:
                if snapshots.changed(spark, spec, root, base, newest, incoming.select("event_date").distinct()):
                    break
                base, live = newest, snapshots.manifest(spark, spec, root, newest)
            number = snapshots.next_free(spark, root)
        else:
            return
    raise RuntimeError(f"{spec.table}: other writers keep changing the same dates")


def _with(live: DataFrame, replaced: DataFrame, added: DataFrame) -> DataFrame:
    """A manifest with some of its files replaced by others."""
    return live.join(replaced, "file", "left_anti").unionByName(added)


def _holding(
    spark: SparkSession, spec: TableSpec, root: str, live: DataFrame, incoming: DataFrame
) -> list[str]:
    """The live files that hold a key of the incoming rows. Of the files that may, only
    the key columns are read. The names, at most those of the live files, are kept on the
    driver."""
    keys = list(spec.primary_key)
    maybe = snapshots.may_hold(live, incoming, spec)
    stored = snapshots.rows_of(spark, spec, root, maybe, with_file=True).select(*keys, "file_path")
    asked = incoming.select(*keys)
    hit = stored.join(asked, same_keys(stored, asked, keys), "left_semi")
    found = hit.select("file_path").distinct()
    return [r.file for r in found.select(snapshots.file_name("file_path").alias("file")).collect()]


def table_location(spark: SparkSession, spec: TableSpec) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {spec.table}").where("col_name = 'Location'")
    return details.first().data_type


def write_csv(df: DataFrame, path: str) -> None:
    """The fallback sink: CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
