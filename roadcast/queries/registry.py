"""Where queries and their SQL counterparts are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it has no counterpart."""

    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


# One division of whole microseconds: equal in both engines as it is, while rounding
# it would meet exact halves.
_EXACT = ("obs_age_minutes",)


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without zone and doubles to six places, as the counterparts give."""
    shown = []
    for f in df.schema:
        column = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType) and f.name == "_seq":
            column = column.cast("bigint")
        elif isinstance(f.dataType, T.DoubleType) and f.name not in _EXACT:
            column = F.round(column, 6)
        shown.append(column.alias(f.name))
    return df.select(*shown)
