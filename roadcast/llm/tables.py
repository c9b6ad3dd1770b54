"""Reading the text tables and keeping stages between jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from roadcast.session import remove_path, scratch_path

_settled: list[str] = []


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_small_batches(df: DataFrame) -> DataFrame:
    """The frame, to be read by Python tasks: unless the session sets a size of its own,
    Arrow batches of texts get 8 MB instead of Spark's 64, of which a task holds several
    copies."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key).removesuffix("b") == str(64 << 20):
        conf.set(key, str(8 << 20))
    return df


def settle(df: DataFrame, label: str, sort_by: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there, so
    neither a later use nor a lost executor computes it again. The copy stays until
    `release`, as results read it."""
    path = scratch_path(df.sparkSession, label)
    _settled.append(path)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    (df.sortWithinPartitions(sort_by) if sort_by else df).write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove what this process has settled, once the results are written."""
    while _settled:
        remove_path(spark, _settled.pop())
