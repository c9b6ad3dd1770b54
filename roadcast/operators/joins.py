"""Equi-joins that stand up to hot keys and to sides of unknown size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

DIMENSION_ROWS = 100_000


def skewproof_join(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """An equi-join in which a hot key's rows can be split over many tasks.

    Adaptive execution splits a skewed partition only when both sides reach the
    join straight from their own shuffle. A side that was just grouped by the join
    key would reuse that partitioning and rule the split out. A hash of the keys,
    added as one more join key, asks for a shuffle on both sides; it changes no match.
    """
    key_hash = F.xxhash64(*on)
    joined = left.withColumn("_key_hash", key_hash).join(
        right.withColumn("_key_hash", key_hash), [*on, "_key_hash"], how
    )
    return joined.drop("_key_hash")


def dimension_join(
    left: DataFrame, dim: DataFrame, on: list[str], how: str, max_rows: int = DIMENSION_ROWS
) -> DataFrame:
    """Join to a dimension: broadcast when a count shows it small, else a shuffled
    join. The count stops at ``max_rows``, so it costs little on a large side."""
    if dim.limit(max_rows + 1).count() <= max_rows:
        return left.join(F.broadcast(dim), on, how)
    return skewproof_join(left, dim, on, how)


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]):
    """Join condition on ``keys`` under which null equals null."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])
