"""Exact quantiles, the steps of features, and what a learner makes of them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from roadcast.operators.quantiles import steps_of
from roadcast.plans import training
from roadcast.plans.features import with_vector
from roadcast.plans.training import Settings, stepped


def columns(n=3000, seed=3):
    rng = random.Random(seed)
    even = [rng.random() * 100 - 50 for _ in range(n)]
    mostly_zero = [0.0 if rng.random() < 0.9 else rng.random() for _ in range(n)]
    few = [float(i % 7) if i else 99.0 for i in range(n)]
    return list(zip(even, mostly_zero, few))


def test_steps_are_for_as_many_rows_each(spark):
    rows = columns()
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE").repartition(5)
    steps = steps_of(df, list("abc"), 8)
    assert steps["c"] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 99.0]
    own = sorted(r[0] for r in rows)
    assert steps["a"] == [own[math.ceil((2 * i + 1) / 16 * len(own)) - 1] for i in range(8)]
    tail = sorted(r[1] for r in rows if r[1])
    assert steps["b"] == [0.0] + [tail[math.ceil((2 * i + 1) / 14 * len(tail)) - 1] for i in range(7)]


def test_steps_of_odd_values(spark):
    rows = [(float(i), 1.0 if i % 2 else float(-i), None) for i in range(100)]
    rows += [(math.inf, None, -0.0), (-math.inf, 1.0, 0.0), (None, 1.0, None)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE").repartition(3)
    steps = steps_of(df, list("abc"), 4)
    own = sorted(r[0] for r in rows if r[0] is not None)
    assert steps["a"] == [own[math.ceil((2 * i + 1) / 8 * len(own)) - 1] for i in range(4)]
    others = sorted(r[1] for r in rows if r[1] not in (None, 1.0))
    assert steps["b"] == [others[math.ceil((2 * i + 1) / 6 * len(others)) - 1] for i in range(3)] + [1.0]
    assert steps["c"] == [0.0]
    assert steps_of(df.limit(0), list("abc"), 4) == {"a": [], "b": [], "c": []}


def test_cuts_are_looked_for_in_all_rows(spark, monkeypatch):
    """One row in two thousand is beyond a cut that a sample of ten thousand seldom has."""
    n = 60_000
    rows = spark.range(n, numPartitions=4).select(
        (F.col("id") % 2000 == 7).cast("int").alias("hazard"),
        F.when(F.col("id") % 2000 == 7, 9.0 + F.col("id") / n).otherwise(F.lit(0.0)).alias("rare"),
        (F.xxhash64("id") % 1000 / 7.0).alias("noise"),
    )
    seen = {}

    class Watched(training.GBTClassifier):
        def fitMultiple(self, weighted, seeds):
            seen["bins"] = self.getMaxBins()
            return super().fitMultiple(weighted, seeds)

    monkeypatch.setattr(training, "GBTClassifier", Watched)
    names = ["rare", "noise"]
    df = stepped(rows, names)
    values = df.agg(*[F.count_distinct(c).alias(c) for c in names]).first()
    assert (values.rare, values.noise) == (31, 32) and df.columns == rows.columns
    (model,) = training.fit_members(with_vector(df, names), 1.0, Settings(members=1, trees=1, depth=1, parallelism=1))
    assert seen["bins"] ** 2 > n
    cuts = [float(line.split("<=")[1].strip(" )")) for line in model.toDebugString.splitlines() if "<=" in line]
    assert len(cuts) == 1 and 0 < cuts[0] < 9 and "feature 0" in model.toDebugString
    # Rows go the same way by their own values as by those fitted on.
    raw = [with_vector(of, names).select("hazard", "rare", "noise", "features") for of in (rows, df)]
    own, fitted = ([r.prediction for r in model.transform(of).collect()] for of in raw)
    assert own == fitted == [float(r.hazard) for r in raw[0].collect()]


def test_rows_go_the_same_way_by_own_values(spark):
    rows = spark.createDataFrame([(v, w, int(v + w > 20)) for v, w, _ in columns()], "a DOUBLE, b DOUBLE, hazard INT")
    names = ["a", "b"]
    (model,) = training.fit_members(
        with_vector(stepped(rows, names), names), 1.0, Settings(members=1, trees=2, depth=4, parallelism=1)
    )
    own = model.transform(with_vector(rows, names)).select("a", "b", "probability")
    raw = {(r.a, r.b): r.probability for r in own.collect()}
    both = with_vector(stepped(rows.withColumns({"x": F.col("a"), "y": F.col("b")}), names), names)
    assert all(raw[r.x, r.y] == r.probability for r in model.transform(both).collect())


def test_only_sampled_tables_are_stepped(spark, monkeypatch):
    run = F.timestamp_seconds(1_704_067_200 + F.col("id") * 3600)
    rows = spark.range(1000).select(
        F.lit(24).alias("horizon_hours"), F.col("id").alias("measurepoint_id"), run.alias("forecast_run_time"),
        run.alias("valid_time"), (F.col("id") % 3 == 0).cast("int").alias("hazard"),
        (F.col("id") * 1.5).alias("t_air_c"),
    )
    seen = []

    def fit(train, pos_weight, settings):
        seen.append(train.distinct().count())
        raise InterruptedError

    monkeypatch.setattr(training, "fit_members", fit)
    for most in (10_000, 100):
        monkeypatch.setattr(training, "SAMPLED_FROM", most)
        with pytest.raises(InterruptedError):
            training.train_horizon(rows, 24, ["t_air_c"], Settings(trees=1, members=1))
    assert seen[0] > 200 and seen[1] <= 64
