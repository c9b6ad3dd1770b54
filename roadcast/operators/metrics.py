"""Scores of predicted probabilities against 0/1 outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadcast.functions.risk import HAZARD_AT

METRICS = ("auc", "average_precision", "brier", "accuracy")

# Scores are bucketed by log-odds, which for doubles strictly between 0 and 1 lie
# within -746..38. Coarse buckets: 1024 per unit, so fewer than 2**20 in all. A crowded
# one is cut into 2**16 fine ones, of which one spans at most some 2**27 distinct doubles.
_COARSE_STEPS = 1024
_FINE_BITS = 16
CROWDED = 1_000_000


def binary_metrics(
    scored: DataFrame, outcome: str = "y", score: str = "score", *, crowded: int = CROWDED
) -> DataFrame:
    """One row with AUC (ties count half), average precision (step sum), Brier score
    and accuracy at 0.5. With a single class the first two are 0.

    Rows are first added up per distinct score. The running counts that AUC and AP
    need are then taken within buckets of similar scores, on top of the totals of the
    higher buckets. A bucket with more than ``crowded`` distinct scores is cut further,
    so no task sees all scores, however closely they lie.
    """
    y, s = F.col(outcome).cast("bigint"), F.col(score).cast("double")
    per_score = (
        scored.select(y.alias("y"), s.alias("s"))
        .where(F.col("s").isNotNull())
        .groupBy("s")
        .agg(F.count("*").alias("n"), F.sum("y").alias("pos"))
        .withColumn("fine", _fine_bucket(F.col("s")))
        .withColumn("coarse", F.shiftright("fine", _FINE_BITS))
    )
    coarse = per_score.groupBy("coarse").agg(
        F.sum("n").alias("coarse_n"),
        F.sum("pos").alias("coarse_pos"),
        F.count("*").alias("scores"),
    )
    higher = Window.orderBy(F.desc("coarse")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # Fewer than 2**20 coarse buckets, so one task can run over them and they can be
    # broadcast at any input size.
    above = coarse.select(
        "coarse",
        _sum_or_zero("coarse_n", higher).alias("n_higher"),
        _sum_or_zero("coarse_pos", higher).alias("pos_higher"),
        F.sum("coarse_n").over(everything).alias("total"),
        F.sum("coarse_pos").over(everything).alias("total_pos"),
        (F.col("scores") > crowded).alias("crowded"),
    )
    whole = F.shiftleft("coarse", _FINE_BITS)
    # Every score has its bucket, so the left join matches always; an inner one would
    # add a filter below the aggregation above and spoil the reuse of its shuffle.
    parted = per_score.join(F.broadcast(above), "coarse", "left").withColumn(
        "part", F.when(F.col("crowded"), F.col("fine")).otherwise(whole)
    )
    higher_part = (
        Window.partitionBy("coarse")
        .orderBy(F.desc("part"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    within = (
        parted.where("crowded")
        .groupBy("coarse", "part")
        .agg(F.sum("n").alias("part_n"), F.sum("pos").alias("part_pos"))
        .select(
            "part",
            _sum_or_zero("part_n", higher_part).alias("n_within"),
            _sum_or_zero("part_pos", higher_part).alias("pos_within"),
        )
    )
    down = (
        Window.partitionBy("part")
        .orderBy(F.desc("s"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    zero = F.lit(0)
    running = parted.join(within, "part", "left").select(
        "s",
        "n",
        "pos",
        (F.col("n_higher") + F.coalesce("n_within", zero) + F.sum("n").over(down)).alias("n_down_to"),
        (F.col("pos_higher") + F.coalesce("pos_within", zero) + F.sum("pos").over(down)).alias(
            "pos_down_to"
        ),
        "total",
        "total_pos",
    )
    neg = F.col("n") - F.col("pos")
    wins = neg * (F.col("pos_down_to") - F.col("pos") + F.col("pos") / 2)
    precision = F.col("pos_down_to") / F.col("n_down_to")
    guess = (F.col("s") >= HAZARD_AT).cast("int")
    total, total_pos = F.max("total"), F.max("total_pos")
    total_neg = total - total_pos
    two_classes = (total_pos > 0) & (total_neg > 0)
    # Everything is per distinct score, so squared errors and hits are weighted sums.
    squared = F.col("pos") * F.pow(1 - F.col("s"), 2) + neg * F.pow(F.col("s"), 2)
    hits = F.when(guess == 1, F.col("pos")).otherwise(neg)
    return running.agg(
        F.when(two_classes, F.sum(wins) / (total_pos * total_neg.cast("double")))
        .otherwise(0.0)
        .alias("auc"),
        F.when(two_classes, F.sum(F.col("pos") * precision) / total_pos)
        .otherwise(0.0)
        .alias("average_precision"),
        (F.sum(squared) / total).alias("brier"),
        (F.sum(hits) / total).alias("accuracy"),
    )


def _sum_or_zero(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def _fine_bucket(score: Column) -> Column:
    """Bucket number that never falls as the score rises."""
    odds = F.floor(F.log(score / (1 - score)) * (_COARSE_STEPS << _FINE_BITS))
    beyond = F.lit(1 << 40).cast("bigint")
    return F.when(score <= 0, -beyond).when(score >= 1, beyond).otherwise(odds.cast("bigint"))
