"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

INPUT_ORDER = ("ingested_at", "payload_id", "_seq", "ingest_seq")


def input_order(df: DataFrame) -> list[str]:
    """The columns that record the order rows arrived in, as far as present."""
    return [c for c in INPUT_ORDER if c in df.columns]


def keep_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the last in ``order``. Null keys count as equal.

    Every task first keeps its own last row per key (Spark limits the groups of a
    ``row_number`` filter ahead of the shuffle), so a key with very many copies
    sends one row per task. ``order`` must tell rows of one key apart, or the choice
    between them is open.
    """
    order = list(order) if order is not None else input_order(df)
    if not order:
        raise ValueError("keep_last needs columns that order the rows")
    newest_first = [F.col(c).desc_nulls_last() for c in order]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")
