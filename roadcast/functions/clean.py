"""Coercions that turn loosely typed source columns into typed ones.

Missing values are always null in this library. NaN is turned into null on the
way in, since Spark orders NaN above every number and a NaN would pass ``>=``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# What counts as a number in text: sign, digits, optional fraction and exponent.
# Rejects spellings only Spark accepts, such as "1d" and "NaN".
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def utc_timestamp(df: DataFrame, name: str) -> Column:
    """Timestamp in UTC; unreadable text is null. Each value is parsed on its
    own, so mixed formats within a column all survive."""
    kind = column_type(df, name)
    if isinstance(kind, T.StringType):
        return utc_from_text(F.col(name))
    if isinstance(kind, T.NullType):
        return F.lit(None).cast("timestamp")
    return F.col(name).cast("timestamp")


def utc_from_text(text: Column) -> Column:
    """Text with an offset is converted to UTC; text without one is taken as UTC
    (the session zone)."""
    return F.try_to_timestamp(F.trim(text))


def number_from_text(text: Column) -> Column:
    return F.when(text.rlike(NUMERIC_TEXT), F.trim(text).try_cast("double"))


def whole_from_text(text: Column) -> Column:
    """Integer of text that is a whole number, else null; long integers stay exact."""
    exact = F.when(text.rlike(NUMERIC_TEXT), F.trim(text).try_cast("bigint"))
    number = number_from_text(text)
    return F.coalesce(exact, F.when(number == F.floor(number), number.try_cast("bigint")))


def number(df: DataFrame, name: str) -> Column:
    """Double, with NaN and unreadable text as null."""
    kind = column_type(df, name)
    if isinstance(kind, T.StringType):
        return number_from_text(F.col(name))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(F.col(name)).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return F.col(name).cast("double")
    return F.lit(None).cast("double")


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def truncated_id(df: DataFrame, name: str) -> Column:
    """Integer identifier, fractions cut off; null when not a number."""
    kind = column_type(df, name)
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    if isinstance(kind, T.StringType):
        text = F.when(F.col(name).rlike(NUMERIC_TEXT), F.trim(name))
        # The direct cast keeps long integers exact; only the rest go through double.
        return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    return number(df, name).try_cast("bigint")


def with_measurepoint_id(df: DataFrame, name: str = "measurepoint_id") -> DataFrame:
    """Coerce the identifier and drop rows that have none; no-op without the column."""
    if name not in df.columns:
        return df
    return df.withColumn(name, truncated_id(df, name)).where(F.col(name).isNotNull())


def feature_flag(df: DataFrame, name: str) -> Column:
    """0/1 flag for features: true in any usual spelling is 1, other numbers are
    cut to integers, everything else is 0."""
    kind = column_type(df, name)
    if isinstance(kind, T.StringType):
        flag = (
            F.when(F.col(name).isin("true", "True"), 1)
            .when(F.col(name).isin("false", "False"), 0)
            .otherwise(number(df, name).try_cast("int"))
        )
    else:
        flag = number(df, name).try_cast("int")
    return F.coalesce(flag, F.lit(0))


def label_flag(df: DataFrame, name: str) -> Column:
    """0/1 flag for labels: only true, 1 and "true" count. Narrower than
    ``feature_flag`` on purpose."""
    kind = column_type(df, name)
    if isinstance(kind, T.BooleanType):
        hit = F.col(name)
    elif isinstance(kind, T.StringType):
        hit = F.col(name) == "true"
    elif isinstance(kind, T.NumericType):
        hit = F.col(name) == 1
    else:
        return F.lit(0)
    return F.when(hit, 1).otherwise(0)


def keep_columns(df: DataFrame, allowed: list[str]) -> DataFrame:
    """Project to the allowed columns, in the order the input has them."""
    wanted = set(allowed)
    return df.select(*[c for c in df.columns if c in wanted])
