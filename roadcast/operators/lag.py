"""Earlier readings of the same measurement point, counted in rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadcast.operators.hotkeys import HOT_ROWS, flag_hot

# --- Fixed values
LAG_COLUMNS = ("surface_temp_c", "surface_grip", "air_temp_c", "air_rh")
LAG_ROWS = (1, 3, 6, 12, 24)

# Missing times sort last; this stands in for them where a null would not compare.
_LAST = "timestamp'9999-12-31 23:59:59.999999'"


def with_lags(
    df: DataFrame,
    *,
    seq: str = "_seq",
    lags: tuple[int, ...] = LAG_ROWS,
    hot_rows: int = HOT_ROWS,
    chunk_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``<column>_lag_<n>h`` for each lag column present: the value ``n`` rows
    back by sample time, ties in order of the unique integer ``seq``. The name says
    hours, the step is rows. Rows without identifier get nulls.

    A point within ``hot_rows`` is one window group. A larger one is numbered
    exactly, cut into chunks of ``chunk_rows`` rows, and each chunk is given the
    last rows of the chunk before it.
    """
    if chunk_rows < max(lags):
        raise ValueError("a chunk must hold at least as many rows as the longest lag")
    columns = [c for c in LAG_COLUMNS if c in df.columns]
    if not columns:
        return df
    named = {f"{c}_lag_{n}h": (c, n) for c in columns for n in lags}
    flagged = flag_hot(df, df.select("measurepoint_id"), "measurepoint_id", hot_rows)
    flagged = flagged.withColumn("_order_time", F.coalesce("sample_time", F.expr(_LAST)))

    by_point = Window.partitionBy("measurepoint_id").orderBy("_order_time", seq)
    known = F.col("measurepoint_id").isNotNull()
    whole = flagged.where(known & F.col("_hot").isNull()).withColumns(_lags(named, by_point))

    chunk = F.floor((F.col("_row") - 1) / chunk_rows).cast("bigint")
    halo = (F.col("_row") - 1) % chunk_rows >= chunk_rows - max(lags)
    both = F.when(halo, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    by_chunk = Window.partitionBy("measurepoint_id", "_chunk").orderBy("_row")
    cut = (
        numbered(flagged.where(known & F.col("_hot")), seq, hot_rows)
        .withColumn("_chunk", F.explode(both))
        .withColumns(_lags(named, by_chunk))
        .where(F.col("_chunk") == chunk)
    )

    unknown = flagged.where(~known).withColumns(
        {name: F.lit(None).cast(df.schema[c].dataType) for name, (c, _) in named.items()}
    )
    wanted = [*df.columns, *named]
    return whole.select(*wanted).unionByName(cut.select(*wanted)).unionByName(unknown.select(*wanted))


def _lags(named: dict[str, tuple[str, int]], window) -> dict[str, Column]:
    return {name: F.lag(c, n).over(window) for name, (c, n) in named.items()}


def numbered(df: DataFrame, seq: str, hot_rows: int) -> DataFrame:
    """Add ``_row``: the row's number (from 1) within its point by time and ``seq``.

    Rows are numbered within blocks of one minute; the rows of the blocks before
    are added from a table of one row per block. A minute with more than
    ``hot_rows`` rows, such as one record delivered over and over, is cut further by
    exact time and by ranges of ``seq``, which hold at most ``hot_rows`` rows each.
    """
    minute = F.date_trunc("minute", "_order_time")
    keyed = df.withColumn("_minute", F.struct("measurepoint_id", minute.alias("minute")))
    # The point's own flag has done its work; the same column now tells of the minute.
    keyed = flag_hot(keyed.drop("_hot"), keyed.select("_minute"), "_minute", hot_rows)
    crowded = F.col("_hot")
    blocked = keyed.withColumns(
        {
            "_block_time": F.when(crowded, F.col("_order_time")).otherwise(minute),
            "_block_seq": F.when(crowded, F.expr(f"{seq} div {max(hot_rows, 1)}")).otherwise(0),
        }
    ).drop("_minute", "_hot")
    block = ["measurepoint_id", "_block_time", "_block_seq"]
    earlier = (
        Window.partitionBy("measurepoint_id")
        .orderBy("_block_time", "_block_seq")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        blocked.groupBy(*block)
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    within = Window.partitionBy(*block).orderBy("_order_time", seq)
    return (
        blocked.withColumn("_row", F.row_number().over(within))
        .join(offsets, block)
        .withColumn("_row", F.col("_row") + F.col("_before"))
        .drop("_before", "_block_time", "_block_seq")
    )
