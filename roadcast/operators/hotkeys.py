"""Finding the few identifiers that hold too many rows for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadcast.operators.joins import skewproof_join

# Rows of one identifier that one task may sort on its own.
HOT_ROWS = 5_000_000
# From this threshold on the hot keys are few enough to broadcast: at most
# rows / 1,000,000 of them, one million for 10**12 rows.
BROADCAST_FROM = 1_000_000


def flag_hot(df: DataFrame, counted: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Add ``_hot``: true if the row's key has more than ``hot_rows`` rows in
    ``counted`` (a frame of that key column; rows per key are added up map-side),
    else null. Filtering on it turns the join into an inner one, which adaptive
    execution drops, with all that follows, once no key turns out hot.

    At most rows / ``hot_rows`` keys can be hot, which bounds what is broadcast: 200,000
    keys for 10**12 rows at the default. A low ``hot_rows`` gives no such bound
    and takes a shuffled join.
    """
    hot = (
        counted.groupBy(key)
        .agg(F.count("*").alias("_rows"))
        .where((F.col("_rows") > hot_rows) & F.col(key).isNotNull())
        .select(key, F.lit(True).alias("_hot"))
    )
    if hot_rows >= BROADCAST_FROM:
        return df.join(F.broadcast(hot), key, "left")
    return skewproof_join(df, hot, [key], "left")
