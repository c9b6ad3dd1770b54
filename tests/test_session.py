"""Session conventions and the command line."""

import pytest

from roadcast import __main__ as command
from roadcast.session import (
    refuse_own_disk,
    scratch_path,
    shared_dir,
    shuffle_partitions,
    use_checkpoints,
    use_utc,
)


def test_partition_sizing():
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(256 << 30) == 1024
    assert shuffle_partitions(100 << 40) == 50_000


def test_zone_is_pinned(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert use_utc(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    assert scratch_path(spark, "x").startswith(configured)
    use_checkpoints(spark)
    assert spark.sparkContext.getCheckpointDir()


class _Unset:
    """A session without a checkpoint folder, on the given master."""

    def __init__(self, master):
        self.sparkContext = self
        self.conf = self
        self.master = master
        self.folder = None

    def get(self, key, default=None):
        return "/warehouse" if key == "spark.sql.warehouse.dir" else default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_without_a_setting_the_warehouse_is_shared():
    session = _Unset("yarn")
    assert shared_dir(session) == session.folder == "/warehouse/_roadcast-shared"
    assert shared_dir(session) == session.folder


def test_command_line():
    args = command._parser().parse_args(
        ["--shuffle-gb", "10", "backfill", "--landing", "in"]
    )
    assert (args.job, args.landing, args.shuffle_gb) == ("backfill", "in", 10)
    assert command._now("2024-01-02T03:04").hour == 3
    assert command._now(None).tzinfo is None


def test_a_cluster_needs_a_shared_folder():
    for master, path in (("local", "file:/w"), ("local[4]", "file:/w"), ("yarn", "hdfs://n/w"), ("k8s://x", "s3a://b/w")):
        refuse_own_disk(master, path)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="checkpoint.dir"):
            refuse_own_disk(master, "file:/w")
