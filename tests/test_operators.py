"""Lags, dedup, splits, metrics, quantiles and serving against brute force."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadcast.operators.dedup import keep_last
from roadcast.operators.ensemble import ensemble_summary, long_ensemble_summary
from roadcast.operators.joins import dimension_join, skewproof_join
from roadcast.operators.labels import hourly_labels
from roadcast.operators.lag import LAG_ROWS, with_lags
from roadcast.operators.metrics import binary_metrics
from roadcast.operators.serving import (
    best_per_point,
    by_severity,
    key_figures,
    latest_run,
    numeric_ids,
    repair_schema,
    risk_buckets,
    timeline,
)
from roadcast.operators.splits import (
    class_weights,
    set_sizes,
    with_random_split,
    with_split,
    with_time_split,
)
from roadcast.sources.locations import default_locations

DAY = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)

# --- Lags -----------------------------------------------------------------------


def readings(spark, n=400, seed=1):
    """One hot point with many copies of one time, a few others, missing ids and times."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        point = rng.choice([1, 1, 1, 1, 2, 3, None])
        second = rng.choice([0, 0, 0, 5, 30, 61, 62, 3600, 90_000, rng.randrange(200_000), None])
        time = None if second is None else DAY + dt.timedelta(seconds=second)
        rows.append((point, time, rng.choice([None, float(seq)]), float(-seq), seq))
    return rows, spark.createDataFrame(
        rows, "measurepoint_id BIGINT, sample_time TIMESTAMP, surface_temp_c DOUBLE, air_rh DOUBLE, _seq BIGINT"
    )


@pytest.mark.parametrize(
    "ways",
    [{}, {"hot_rows": 1, "chunk_rows": 24}, {"hot_rows": 10, "chunk_rows": 30}, {"hot_rows": 60, "chunk_rows": 1000}],
)
def test_lags(spark, ways):
    rows, df = readings(spark)
    expected = {}
    for point in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == point), key=lambda r: (r[1] is None, r[1] or DAY, r[4]))
        for k, r in enumerate(own):
            for n in LAG_ROWS:
                back = own[k - n] if point is not None and k >= n else None
                expected[r[4], n] = (back[2], back[3]) if back else (None, None)
    out = with_lags(df, **ways)
    assert "air_temp_c_lag_1h" not in out.columns
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        for n in LAG_ROWS:
            assert (r[f"surface_temp_c_lag_{n}h"], r[f"air_rh_lag_{n}h"]) == expected[r._seq, n]


def test_lag_is_by_row_not_by_hour(spark):
    df = spark.createDataFrame(
        [(1, DAY, 1.0, 0), (1, DAY + dt.timedelta(hours=5), 2.0, 1)],
        "measurepoint_id BIGINT, sample_time TIMESTAMP, air_rh DOUBLE, _seq BIGINT",
    )
    assert with_lags(df).orderBy("_seq").collect()[1].air_rh_lag_1h == 1.0


def test_lags_need_columns_and_room(spark):
    df = spark.createDataFrame([(1, DAY, 0)], "measurepoint_id BIGINT, sample_time TIMESTAMP, _seq BIGINT")
    assert with_lags(df) is df
    with pytest.raises(ValueError):
        with_lags(df, chunk_rows=5)


# --- Dedup, labels, joins -----------------------------------------------------------


def test_keep_last(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 3), (1, "c", 2), (None, "d", 1), (None, None, 2)], "k INT, v STRING, _seq INT"
    )
    assert sorted((r.k or 0, r.v) for r in keep_last(df, ["k"]).collect()) == [(0, None), (1, "b")]
    with pytest.raises(ValueError):
        keep_last(df.drop("_seq"), ["k"])


def test_labels_skip_rows_without_key(spark):
    df = spark.createDataFrame(
        [(1, DAY, -1.0), (1, DAY + dt.timedelta(minutes=59), 5.0), (1, DAY + dt.timedelta(minutes=60), 5.0),
         (None, DAY, -1.0), (1, None, -1.0)],
        "measurepoint_id BIGINT, sample_time TIMESTAMP, surface_temp_c DOUBLE",
    )
    assert sorted(r.hazard for r in hourly_labels(df).collect()) == [0, 1]


def test_hot_key_is_split(spark):
    """With the right side grouped by the key, only the skew-proof form can be split."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(2_000_000)
        left = ids.select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50_000).alias("k"),
            F.col("id").alias("v"),
            F.rand(1).alias("x"),
        ).repartition(8)
        right = spark.range(500_000).groupBy((F.col("id") % 50_000).alias("k")).agg(F.max("id").alias("m"))
        for how in ("inner", "left"):
            run = skewproof_join(left, right, ["k"], how)._jdf.queryExecution()
            assert run.toRdd().count() == 2_000_000
            assert "SortMergeJoin(skew=true)" in run.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_dimension_join_either_way(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    small = dimension_join(left, dim, ["k"], "left")
    large = dimension_join(left, dim, ["k"], "left", max_rows=5)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(small) and "broadcast" not in plan(large)
    assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, large.collect()), key=repr)


# --- Splits -----------------------------------------------------------------------


def runs(spark, days):
    rows = [(i, None if d is None else DAY + dt.timedelta(days=d)) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "i INT, forecast_run_time TIMESTAMP")


def sets(df):
    return {r.i: r.split for r in df.collect()}


def test_time_split_boundaries(spark):
    out = sets(with_time_split(runs(spark, [40, 26, 25.5, 18.5, 18.4, None])))
    assert out == {0: "test", 1: "test", 2: "calibration", 3: "calibration", 4: "train", 5: None}


def test_split_falls_back(spark):
    df = runs(spark, [1 + i / 100 for i in range(100)])
    sizes = set_sizes(with_split(df, ["i"])).first().asDict()
    assert sizes == {"train": 65, "calibration": 15, "test": 20}
    missing = runs(spark, [None] * 20)
    assert set_sizes(with_split(missing, ["i"])).first().asDict() == {"train": 13, "calibration": 3, "test": 4}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_split_looks_for_its_boundaries_once(spark, kind):
    run = F.col("forecast_run_time").cast(kind)
    df = runs(spark, [1 + i / 7 for i in range(200)] + [None] * 3).withColumn("forecast_run_time", run)
    split = with_split(df, ["i"])
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan
    assert sets(split) == sets(with_time_split(df).where("split is not null"))


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 997])
def test_random_split_sizes(spark, n):
    df = spark.range(n).select(F.col("id").cast("int").alias("i"))
    out = with_random_split(df, ["i"])
    test, both = math.floor(n * 0.2), math.floor(n * 0.35)
    assert set_sizes(out).first().asDict() == {"train": n - both, "calibration": both - test, "test": test}
    assert sets(out) == sets(with_random_split(df.repartition(3), ["i"]))


def test_random_split_keeps_copies_together(spark):
    df = spark.range(900).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id")).cast("int").alias("i"))
    per_key = with_random_split(df, ["i"]).groupBy("i").agg(F.count_distinct("split").alias("n"))
    assert per_key.agg(F.max("n")).first()[0] == 1


def test_class_weights(spark):
    df = spark.createDataFrame([(24, 0), (24, 0), (24, 1), (48, 0)], "horizon_hours INT, hazard INT")
    rows = {r.horizon_hours: (r.negatives, r.positives, r.pos_weight) for r in class_weights(df).collect()}
    assert rows == {24: (2, 1, 2.0), 48: (1, 0, 1.0)}


# --- Metrics and quantiles ------------------------------------------------------------


def brute_metrics(y, s):
    y, s = np.asarray(y, float), np.asarray(s, float)
    pos, neg = s[y == 1], s[y == 0]
    auc = ap = 0.0
    if len(pos) and len(neg):
        auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
        for t in sorted(set(s), reverse=True):
            ap += y[s == t].sum() / y.sum() * y[s >= t].sum() / (s >= t).sum()
    return auc, ap, np.mean((s - y) ** 2), np.mean((s >= 0.5) == y)


@pytest.mark.parametrize("kind", ["ties", "distinct", "crowded", "edges", "one class"])
def test_metrics(spark, kind):
    rng = random.Random(3)
    y = [int(rng.random() < 0.3) for _ in range(200)]
    s = {
        "ties": [rng.randrange(10) / 10 for _ in y],
        "distinct": [rng.random() for _ in y],
        "crowded": [1e-9 + rng.random() * 1e-13 for _ in y],
        "edges": [rng.choice([0.0, 1.0, 0.5, 1e-300, 1 - 1e-16]) for _ in y],
        "one class": [rng.random() for _ in y],
    }[kind]
    if kind == "one class":
        y = [1] * len(y)
    df = spark.createDataFrame(list(zip(y, s)), "y INT, score DOUBLE")
    for crowded in (1_000_000, 3, 0):
        row = binary_metrics(df, crowded=crowded).first()
        assert tuple(row) == pytest.approx(brute_metrics(y, s), abs=1e-12)


def test_quantiles(spark):
    rng = random.Random(4)
    values = [[rng.random() for _ in range(10)] for _ in range(50)] + [[1.0, 2.0, 3.0] + [0.0] * 7]
    names = [f"p{i}" for i in range(10)]
    df = spark.createDataFrame([(k, *v) for k, v in enumerate(values)], "k INT, " + ", ".join(f"{n} DOUBLE" for n in names))
    wide = ensemble_summary(df, names).orderBy("k").collect()
    long = df.select("k", F.explode(F.array(*names)).alias("prob"))
    tall = long_ensemble_summary(long, ["k"]).orderBy("k").collect()
    for v, w, t in zip(values, wide, tall):
        want = (np.mean(v), np.quantile(v, 0.1), np.quantile(v, 0.9))
        assert tuple(w)[1:] == pytest.approx(want)
        assert tuple(t)[1:] == pytest.approx(want)
        assert w.risk_p10 <= w.risk_p90


def test_quantiles_of_few_members(spark):
    df = spark.createDataFrame([(1.0, 3.0, 2.0)], "a DOUBLE, b DOUBLE, c DOUBLE")
    assert tuple(ensemble_summary(df, ["a", "b", "c"]).first()) == pytest.approx((2.0, 1.2, 2.8))
    assert tuple(ensemble_summary(df, ["b"]).select("risk_mean", "risk_p10", "risk_p90").first()) == (3.0, 3.0, 3.0)


# --- Serving ------------------------------------------------------------------------


def test_latest_run_is_global(spark):
    df = spark.createDataFrame(
        [(1, DAY), (1, DAY + dt.timedelta(days=1)), (2, DAY)], "measurepoint_id INT, forecast_run_time TIMESTAMP"
    )
    assert [r.measurepoint_id for r in latest_run(df).collect()] == [1]
    none = df.withColumn("forecast_run_time", F.lit(None).cast("timestamp"))
    assert latest_run(none).count() == 3
    assert latest_run(df.drop("forecast_run_time")).count() == 3


def test_best_per_point_ties_and_nulls(spark):
    rows = [
        (1, DAY, 0.5, 0), (1, DAY, 0.5, 1), (1, None, 0.9, 2), (1, DAY, None, 3),
        (2, None, None, 4), (2, None, float("nan"), 5), (None, DAY, 0.1, 6), (None, DAY, 0.2, 7),
    ]
    df = spark.createDataFrame(rows, "measurepoint_id INT, valid_time TIMESTAMP, risk_mean DOUBLE, ingest_seq INT")
    assert sorted(r.ingest_seq for r in best_per_point(df).collect()) == [0, 4, 7]
    bare = df.select("risk_mean", "ingest_seq")
    assert best_per_point(bare).count() == 8


def test_severity_order(spark):
    df = spark.createDataFrame(
        [(0.3, 0), (None, 1), (0.9, 2), (0.5, 3), (0.9, 4), (0.71, 5)], "risk_mean DOUBLE, ingest_seq INT"
    )
    assert [r.ingest_seq for r in by_severity(df).collect()] == [2, 4, 5, 3, 0, 1]


def test_aliases(spark):
    df = spark.createDataFrame([(0, "MP001"), (1, "226"), (2, "x"), (3, None), (4, "9.7")], "i INT, measurepoint_id STRING")
    out = {r.i: r.measurepoint_id for r in numeric_ids(df, default_locations(spark)).collect()}
    assert out == {0: 243, 1: 226, 2: None, 3: None, 4: None}


def test_repair_and_reports(spark):
    df = spark.createDataFrame([(1, 0.7), (1, 0.71), (2, 0.4), (2, None)], "measurepoint_id INT, risk_probability DOUBLE")
    fixed = repair_schema(df)
    assert fixed.columns == ["measurepoint_id", "risk_probability", "risk_mean", "risk_p10", "risk_p90"]
    assert tuple(risk_buckets(fixed).first()) == (1, 1, 1)
    row = key_figures(fixed).first()
    assert (row.high_risk, row.points) == (1, 2)
    assert row.avg_risk_pct == pytest.approx(100 * (0.7 + 0.71 + 0.4) / 3)


def test_timeline_band(spark):
    df = spark.createDataFrame(
        [(1, DAY, 0.1, None), (1, DAY + dt.timedelta(hours=1), None, 0.9), (2, DAY, 0.1, None)],
        "measurepoint_id INT, valid_time TIMESTAMP, risk_p10 DOUBLE, risk_p90 DOUBLE",
    )
    assert [(r.measurepoint_id, r.has_band) for r in timeline(df).collect()] == [(1, True), (1, True), (2, False)]
    assert timeline(df, 2).count() == 1
