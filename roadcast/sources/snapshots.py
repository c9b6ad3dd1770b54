"""Which files make up a stored table: one manifest per version, one note per commit.

A table's folder holds

    data/commit=<id>/event_date=<day>/*.parquet   files, never changed once written
    _manifests/<id>/*.parquet                     a row per live file of a version
    _commits/<number>                             names the manifest of that version

A version exists once its note does. Notes are created only where there is none, so of
two writers one gets a number, and the other looks at what the first one changed. Readers
take the files from the manifest of the newest version, and keep to it whatever is
written meanwhile. Nothing is removed but by `expire`.

A manifest tells of each file the day, the number of rows, the range of the first key
column and of the event time, and the newest run and ingest time. Files are written in
ranges of the key, so that the ranges tell the files in which a key may be.
"""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from roadcast.schemas import TableSpec
from roadcast.session import _file_system, create_note, modified, path_exists, remove_path

# A writer that takes longer to fill a note of a few bytes is taken to be gone.
NOTE_SECONDS = 600
RUN, INGESTED = "forecast_run_time", "ingested_at"


def _commits(spark: SparkSession, root: str) -> dict[int, int]:
    """The numbers of the notes and their sizes."""
    files, target = _file_system(spark, os.path.join(root, "_commits"))
    if not files.exists(target):
        return {}
    found = ((s.getPath().getName(), s.getLen()) for s in files.listStatus(target))
    return {int(name): size for name, size in found if name.isdigit()}


def _note(root: str, number: int) -> str:
    return os.path.join(root, "_commits", f"{number:020d}")


def _named(spark: SparkSession, root: str, number: int) -> str:
    """The manifest that a note names, or nothing while it is being filled."""
    files, target = _file_system(spark, _note(root, number))
    if not files.exists(target):
        return ""
    stream = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the versions that can be read, ascending."""
    return sorted(number for number, size in _commits(spark, root).items() if size)


def latest(spark: SparkSession, root: str) -> int:
    """The newest version's number, 0 where there is none yet. A note that is being
    filled is waited for; one whose writer is gone is passed over."""
    for number in sorted(_commits(spark, root), reverse=True):
        while not _named(spark, root, number):
            since = modified(spark, _note(root, number))
            if since is None or time.time() - since > NOTE_SECONDS:
                break
            time.sleep(0.05)
        else:
            return number
    return 0


def next_free(spark: SparkSession, root: str) -> int:
    return max([0, *_commits(spark, root)]) + 1


def manifest_schema(spec: TableSpec) -> T.StructType:
    key = spec.schema[spec.primary_key[0]].dataType.simpleString()
    return T.StructType.fromDDL(
        f"event_date DATE, file STRING, rows BIGINT, low {key}, high {key}, first TIMESTAMP, last TIMESTAMP, "
        "first_run TIMESTAMP, last_run TIMESTAMP, null_runs BIGINT, last_ingested TIMESTAMP"
    )


def manifest(spark: SparkSession, spec: TableSpec, root: str, version: int | None = None) -> DataFrame:
    """A row per live file of a version, the newest unless told otherwise. Files are
    named from ``data`` on."""
    number = latest(spark, root) if version is None else version
    name = _named(spark, root, number) if number else ""
    if not name:
        if version:
            raise ValueError(f"there is no version {version}")
        return spark.createDataFrame([], manifest_schema(spec))
    return spark.read.schema(manifest_schema(spec)).parquet(os.path.join(root, "_manifests", name))


def file_name(path: str = "_metadata.file_path") -> Column:
    """The file a row was read from, as manifests name it. Where rows are many it is told
    of their distinct paths."""
    return F.regexp_extract(F.col(path), "/data/(commit=[^/]+/.*)$", 1)


def rows_of(
    spark: SparkSession, spec: TableSpec, root: str, files: DataFrame, *, with_file: bool = False
) -> DataFrame:
    """The rows of the files in a manifest or a part of one, with ``event_date`` and, if
    asked for, ``file_path``, of which `file_name` makes the file. The names pass through
    the driver, where a read lists its files in any case."""
    schema = T.StructType([*spec.schema, T.StructField("event_date", T.DateType())])
    data = os.path.join(root, "data")
    paths = [os.path.join(data, r.file) for r in files.select("file").collect()]
    if not paths:
        named = T.StructType([*schema, T.StructField("file_path", T.StringType())])
        return spark.createDataFrame([], named if with_file else schema)
    read = spark.read.schema(schema).option("basePath", data).parquet(*paths)
    return read.select(*schema.names, *(["_metadata.file_path"] if with_file else []))


def write_files(spark: SparkSession, spec: TableSpec, root: str, rows: DataFrame) -> DataFrame:
    """Write rows, which have ``event_date``, as new files and describe these as a
    manifest does. They belong to no version yet."""
    place = os.path.join(root, "data", f"commit=c{uuid.uuid4().hex}")
    keys = ["event_date", *spec.primary_key]
    # Ranges of the keys make even files, also where one day or point has most rows.
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged.write.partitionBy("event_date").parquet(place)
    return described(spark, spec, root, place)


def described(spark: SparkSession, spec: TableSpec, root: str, place: str) -> DataFrame:
    schema = T.StructType([*spec.schema, T.StructField("event_date", T.DateType())])
    data = os.path.join(root, "data")
    read = spark.read.schema(schema).option("basePath", data).parquet(place)
    key = F.col(spec.primary_key[0])
    time_ = F.col(spec.event_time)

    def bound(of, name: str) -> Column:
        return (of(name) if name in spec.schema.names else F.lit(None)).cast("timestamp")

    return (
        read.select("*", "_metadata.file_path")
        .groupBy("event_date", "file_path")
        .agg(
            F.count("*").alias("rows"),
            F.min(key).alias("low"),
            F.max(key).alias("high"),
            F.min(time_).cast("timestamp").alias("first"),
            F.max(time_).cast("timestamp").alias("last"),
            bound(F.min, RUN).alias("first_run"),
            bound(F.max, RUN).alias("last_run"),
            (F.count("*") - F.count(RUN) if RUN in spec.schema.names else F.lit(0)).alias("null_runs"),
            bound(F.max, INGESTED).alias("last_ingested"),
            # A null is in no range: files with one may hold any.
            F.max(key.isNull() | time_.isNull()).alias("_any"),
        )
        .withColumn("low", F.when(~F.col("_any"), F.col("low")))
        .withColumn("file", file_name("file_path"))
        .select(*manifest_schema(spec).names)
    )


def commit(spark: SparkSession, spec: TableSpec, root: str, live: DataFrame, number: int) -> bool:
    """Make a manifest the version of that number, unless another writer has it."""
    name = uuid.uuid4().hex
    path = os.path.join(root, "_manifests", name)
    live.select(*manifest_schema(spec).names).hint("rebalance").write.parquet(path)
    if create_note(spark, _note(root, number), name):
        return True
    remove_path(spark, path)
    return False


def may_hold(files: DataFrame, incoming: DataFrame, spec: TableSpec) -> DataFrame:
    """The files of a manifest that may hold a key of the incoming rows, by their day and
    the ranges of the first key column and of the event time."""
    key, time_ = spec.primary_key[0], spec.event_time
    asked = incoming.groupBy(F.col("event_date").alias("_day"), F.col(key).alias("_key")).agg(
        F.min(time_).cast("timestamp").alias("_from"), F.max(time_).cast("timestamp").alias("_to")
    )
    in_range = (F.col("_key") >= F.col("low")) & (F.col("_key") <= F.col("high"))
    in_time = (F.col("_from") <= F.col("last")) & (F.col("_to") >= F.col("first"))
    anywhere = F.col("low").isNull() | F.col("_key").isNull() | F.col("_from").isNull()
    same_day = F.col("event_date").eqNullSafe(F.col("_day"))
    return files.join(asked, same_day & (anywhere | (in_range & in_time)), "left_semi")


def changed(spark: SparkSession, spec: TableSpec, root: str, base: int, now: int, days: DataFrame) -> bool:
    """Whether a later version has other files than an earlier one on some days."""
    old, new = (
        manifest(spark, spec, root, v).join(
            days.select(F.col("event_date").alias("_day")),
            F.col("event_date").eqNullSafe(F.col("_day")), "left_semi",
        ).select("file")
        for v in (base, now)
    )
    apart = old.join(new, "file", "left_anti").unionByName(new.join(old, "file", "left_anti"))
    return not apart.isEmpty()


def changed_dates(spark: SparkSession, spec: TableSpec, root: str, base: int, now: int) -> list:
    """The event dates whose files differ between two versions, None for rows without."""
    old, new = (manifest(spark, spec, root, v).select("event_date", "file") for v in (base, now))
    apart = old.join(new, "file", "left_anti").unionByName(new.join(old, "file", "left_anti"))
    return [r.event_date for r in apart.select("event_date").distinct().collect()]


def expire(spark: SparkSession, spec: TableSpec, root: str, keep: int = 1, older_than_hours: float = 24.0) -> int:
    """Drop all but the newest ``keep`` versions, and remove the files of none that were
    written more than that many hours ago, so that neither a reader of a version that goes
    nor a writer at work loses any. Returns how many files went."""
    known = versions(spark, root)
    kept, gone = known[-keep:], known[:-keep]
    for number in gone:
        name = _named(spark, root, number)
        remove_path(spark, _note(root, number))
        remove_path(spark, os.path.join(root, "_manifests", name))
    data = os.path.join(root, "data")
    if not path_exists(spark, data):
        return 0
    live = manifest(spark, spec, root, kept[0]) if kept else manifest(spark, spec, root)
    for number in kept[1:]:
        live = live.unionByName(manifest(spark, spec, root, number))
    before = F.timestamp_seconds(F.lit(time.time() - older_than_hours * 3600))
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(data)
        .where(F.col("modificationTime") < before)
        .select(file_name().alias("file"))
    )
    count = 0
    for row in files.join(live, "file", "left_anti").toLocalIterator():
        remove_path(spark, os.path.join(data, row.file))
        count += 1
    return count
