"""Landed files to keyed tables as they arrive.

No state is kept: the upsert is by key and ingest time, so a late or repeated payload
replaces what it is newer than and nothing else, and a batch replayed after a failure
changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadcast.schemas import TableSpec
from roadcast.sources.landing import answered, as_landed, quarantined, with_line_order
from roadcast.sources.tables import ensure_table, upsert


def stream_landing(
    spark: SparkSession, path: str, *, max_files: int | None = None, json_lines: bool = False
) -> DataFrame:
    """Landed payloads of a folder as a stream."""
    reader = spark.readStream.option("wholetext", not json_lines)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return as_landed(reader.format("text").load(path))


def stream_to_table(
    landed: DataFrame,
    spec: TableSpec,
    extract: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    *,
    json_lines: bool = False,
    location: str | None = None,
    quarantine: str | None = None,
    shape: tuple = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query that flattens each batch and upserts it. ``checkpoint`` keeps
    the stream's progress; rejected payloads, and parts of
    others that are not of the ``shape``, are appended to ``quarantine``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = with_line_order(batch) if json_lines else batch
        ensure_table(spark, spec, location=location)
        upsert(spark, spec, extract(answered(batch)))
        if quarantine:
            # One folder per batch, so a replayed batch replaces its own rows.
            quarantined(batch, shape).write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")

    return (
        landed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
