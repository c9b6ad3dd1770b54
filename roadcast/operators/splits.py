"""Training, calibration and test sets, and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# --- Fixed values
TEST_DAYS = 14
CALIBRATION_DAYS = 7
TEST_SHARE = 0.2
TEST_AND_CALIBRATION_SHARE = 0.35
SEED = 42

SETS = ("train", "calibration", "test")


def _days_before(moment: Column, days: int) -> Column:
    return moment - F.expr(f"interval {days} days")


def with_time_split(
    df: DataFrame, *, test_days: int = TEST_DAYS, calibration_days: int = CALIBRATION_DAYS
) -> DataFrame:
    """Add ``split``. The last days by run time are the test set, the days before
    the last remaining run are for calibration; a run on a boundary belongs to the
    later set. Rows without run time are in no set.

    The two boundaries are scalar subqueries, so the rows themselves never move.
    """
    run = F.col("forecast_run_time")
    test_from = df.select(_days_before(F.max(run), test_days)).scalar()
    calibration_from = (
        df.where(run < test_from).select(_days_before(F.max(run), calibration_days)).scalar()
    )
    return _split_at(df, test_from, calibration_from)


def _split_at(df: DataFrame, test_from: Column, calibration_from: Column) -> DataFrame:
    run = F.col("forecast_run_time")
    return df.withColumn(
        "split",
        F.when(run >= test_from, "test")
        .when(run >= calibration_from, "calibration")
        .when(run < calibration_from, "train"),
    )


def set_sizes(split: DataFrame) -> DataFrame:
    """Rows of each set, zero included, as one row ``train, calibration, test``."""
    return split.agg(*[F.count_if(F.col("split") == s).alias(s) for s in SETS])


def with_split(df: DataFrame, keys: Sequence[str], **days: int) -> DataFrame:
    """Time split, or the random one when that would leave a set empty. Decided by one job
    that looks for each set's first run time. Those are constants from then on: whoever
    reads a set would else look for the boundaries again."""
    by_time = with_time_split(df, **days)
    run = F.col("forecast_run_time")
    micros = F.unix_micros(run.cast("timestamp"))
    first = by_time.agg(*[F.min(F.when(F.col("split") == s, micros)).alias(s) for s in SETS]).first()
    if any(first[s] is None for s in SETS):
        return with_random_split(df, keys)
    kind = df.schema["forecast_run_time"].dataType
    test_from, calibration_from = (F.timestamp_micros(F.lit(first[s])).cast(kind) for s in ("test", "calibration"))
    return _split_at(df, test_from, calibration_from).where(F.col("split").isNotNull())


def with_random_split(df: DataFrame, keys: Sequence[str], seed: int = SEED) -> DataFrame:
    """Add ``split`` by the rank of a seeded hash of ``keys``, which must identify a
    row: the lowest fifth is the test set, the next 15 percent are for calibration.
    The cut sizes are exact and the assignment repeats. (Rows that share their keys
    are never parted, so with such copies a cut is as near as that allows.)

    Only the two boundary rows are looked for; the rows are then compared with them.
    """
    place = F.struct(F.xxhash64(F.lit(seed), *keys), *keys)
    cuts = _rows_at_shares(df, place, test=TEST_SHARE, calibration=TEST_AND_CALIBRATION_SHARE)
    test_cut, calibration_cut = cuts["test"], cuts["calibration"]
    # A cut is null only where no row lies before it.
    return df.withColumn(
        "split",
        F.when(place <= test_cut, "test")
        .when(place <= calibration_cut, "calibration")
        .otherwise("train"),
    )


def _rows_at_shares(df: DataFrame, place: Column, **shares: float) -> Column:
    """Scalar struct: for each share, the place of the last of the first
    floor(share * rows) rows.

    Hashes are spread evenly over 2**16 buckets by their top bits. Bucket sizes say
    which buckets hold the wanted rows, and only those buckets' rows are ranked.
    """
    placed = df.select(place.alias("place"))
    bucket = F.shiftright(F.col("place")["col1"], 48)
    sizes = placed.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows"))
    # One task sees all buckets here, of which there are never more than 2**16.
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    ends = sizes.withColumns(
        {"end": F.sum("rows").over(running), "total": F.sum("rows").over(everything)}
    ).withColumn("start", F.col("end") - F.col("rows"))
    cuts = F.array(*[F.struct(F.lit(n).alias("cut"), F.lit(s).alias("share")) for n, s in shares.items()])
    wanted = F.floor(F.col("total") * F.col("share"))
    # One row per share.
    holders = (
        ends.select("*", F.inline(cuts))
        .where((wanted > F.col("start")) & (wanted <= F.col("end")))
        .select("bucket", "cut", (wanted - F.col("start")).alias("nth"))
    )
    # Copies of a row share one place and are counted, not listed, before the ranking.
    inside = (
        placed.withColumn("bucket", bucket)
        .join(F.broadcast(holders), "bucket")
        .groupBy("cut", "nth", "place")
        .agg(F.count("*").alias("rows"))
    )
    upto = Window.partitionBy("cut").orderBy("place")
    reached = inside.withColumn("upto", F.sum("rows").over(upto)).where(F.col("upto") >= F.col("nth"))
    found = [F.min(F.when(F.col("cut") == n, F.col("place"))).alias(n) for n in shares]
    return reached.agg(F.struct(*found)).scalar()


def class_weights(df: DataFrame, by: Sequence[str] = ("horizon_hours",)) -> DataFrame:
    """Negatives, positives and their ratio per group; the ratio is the weight of a
    positive row."""
    counted = df.groupBy(*by).agg(
        F.count_if(F.col("hazard") == 0).alias("negatives"),
        F.count_if(F.col("hazard") == 1).alias("positives"),
    )
    return counted.withColumn(
        "pos_weight", F.col("negatives") / F.greatest(F.col("positives"), F.lit(1))
    )
