"""Session conventions: UTC clock, adaptive execution, shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


# Bytes one shuffle partition should hold, to fit a task's memory without much spilling,
# and the bounds of their number: beyond the upper one the blocks of a shuffle (map tasks
# times partitions) get too many and too small.
PARTITION_BYTES = 256 << 20
MIN_PARTITIONS, MAX_PARTITIONS = 200, 50_000

# Of large copies that one job writes, reads and removes: smaller than the default's, by
# little more work.
SCRATCH_CODEC = "zstd"

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_partitions(shuffle_bytes: int, most: int = MAX_PARTITIONS) -> int:
    """Partitions for shuffles of up to that size. Too many do little harm, as adaptive
    execution merges small ones; too few cannot be split again. Raise ``most`` for
    shuffles of more than ``most * PARTITION_BYTES`` where partitions must stay small."""
    wanted = -(-shuffle_bytes // PARTITION_BYTES)
    return max(MIN_PARTITIONS, min(most, wanted))


def build_session(
    app: str = "roadcast",
    master: str | None = None,
    shuffle_bytes: int | None = None,
    most_partitions: int = MAX_PARTITIONS,
    **conf: str,
) -> SparkSession:
    """A session with the settings every job here relies on.

    ``shuffle_bytes`` is the size of the largest shuffle to expect, that is the rows of
    the biggest input in the columns a job uses. Without it the cluster's own number of
    shuffle partitions stays.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(
            shuffle_partitions(shuffle_bytes, most_partitions)
        )
        settings["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(PARTITION_BYTES)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone. The zone is fixed when a plan is analysed, so this
    must run before the first DataFrame of a job is built."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files go when it ends, not whenever the driver next collects
    garbage. For jobs that run no frame twice: that would shuffle again."""
    if spark.conf.get(SHUFFLE_CLEANUP, "false") == "true":  # by the user, or a job beside this
        yield
        return
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, "false")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in
    ``spark.checkpoint.dir``; where that is unset, one in the warehouse, which any
    session's executors reach and any later process finds again."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    fallback = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_roadcast-shared")
    refuse_own_disk(context.master, fallback)
    context.setCheckpointDir(fallback)
    return fallback


def refuse_own_disk(master: str, path: str) -> None:
    """On a cluster a local folder is another one on every machine."""
    if path.startswith("file:") and not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def use_checkpoints(spark: SparkSession) -> None:
    """Make ``checkpoint()`` and the periodic checkpoints of iterative
    estimators write to the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return os.path.join(shared_dir(spark), "roadcast-scratch", f"{label}-{uuid.uuid4().hex}")


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Put a line of text into a small file; it is there in full once this returns."""
    files, target = _file_system(spark, path)
    out = files.create(target, True)
    out.write(text.encode())
    out.close()


def create_note(spark: SparkSession, path: str, text: str) -> bool:
    """Put a line of text into a file that must not be there yet; whether it was not.
    The file system lets one of several callers win."""
    from py4j.protocol import Py4JJavaError

    files, target = _file_system(spark, path)
    try:
        out = files.create(target, False)
    except Py4JJavaError:
        if files.exists(target):
            return False
        raise
    out.write(text.encode())
    out.close()
    return True


def modified(spark: SparkSession, path: str) -> float | None:
    """When a file was last written, in seconds since 1970, or None without it."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return None
    return files.getFileStatus(target).getModificationTime() / 1000


def read_note(spark: SparkSession, path: str) -> str | None:
    """The text of a note, or None when there is none or its writing did not finish."""
    if not path_exists(spark, path):
        return None
    row = spark.read.text(path, wholetext=True).first()
    return row.value if row and row.value else None


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path made by this library, on whatever file system holds it."""
    files, target = _file_system(spark, path)
    files.delete(target, True)
