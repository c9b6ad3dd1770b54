"""Training, calibration, scoring, and what is saved of them."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadcast.operators.metrics import METRICS, binary_metrics
from roadcast.operators.splits import with_split
from roadcast.plans import scoring, training
from roadcast.plans.dataset import training_dataset
from roadcast.plans.scoring import predict, prediction_rows, store_predictions
from roadcast.plans.serving import current_predictions, recommendation_list
from roadcast.plans.training import (
    ISOTONIC,
    PLATT,
    Ensemble,
    Platt,
    Settings,
    append_metrics,
    bounded,
    fit_isotonic,
    fit_platt,
    load_ensemble,
    save_ensemble,
    score,
    train_all,
    with_calibrated,
)
from roadcast.queries.views import view
from roadcast.schemas import PREDICTION
from roadcast.sources.locations import default_locations
from roadcast.sources.tables import read_table

QUICK = Settings(members=2, trees=2, depth=2, parallelism=2)
NOW = dt.datetime(2024, 1, 28)


def noisy(n=300, seed=5):
    rng = random.Random(seed)
    scores = [rng.random() for _ in range(n)]
    return scores, [int(rng.random() < 0.2 + 0.6 * s) for s in scores]


def newton_platt(scores, y):
    p = np.clip(np.asarray(scores), 1e-6, 1 - 1e-6)
    x = np.column_stack([np.log(p / (1 - p)), np.ones(len(p))])
    y, w, ridge = np.asarray(y, float), np.zeros(2), np.diag([1.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + ridge, x.T @ (q - y) + ridge @ w)
    return w


def pooled(scores, y):
    """Isotonic fit by pooling neighbours, evaluated at the scores."""
    blocks = []
    for s in sorted(set(scores)):
        hits = [b for a, b in zip(scores, y) if a == s]
        blocks.append([[s], sum(hits), len(hits)])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2] + last[2]]
    return {s: b[1] / b[2] for b in blocks for s in b[0]}


def test_platt_like_newton(spark):
    scores, y = noisy()
    df = spark.createDataFrame(list(zip(scores, y)), "raw DOUBLE, hazard INT")
    fit = fit_platt(df, "raw")
    assert (fit.slope, fit.intercept) == pytest.approx(tuple(newton_platt(scores, y)), abs=1e-5)
    one = spark.createDataFrame([(0.2, 1), (0.9, 1)], "raw DOUBLE, hazard INT")
    assert fit_platt(one, "raw") is None


def test_isotonic_like_pooling(spark):
    scores, y = noisy()
    scores = [round(s, 2) for s in scores]
    df = spark.createDataFrame(list(zip(scores, y)), "raw DOUBLE, hazard INT")
    out, (name,) = with_calibrated(df.withColumn("score", F.col("raw")), ["raw"], [fit_isotonic(df, "raw")])
    want = pooled(scores, y)
    for row in out.collect():
        assert row[name] == pytest.approx(want[row.score], abs=1e-9)


def test_isotonic_in_many_partitions(spark, monkeypatch):
    scores, y = noisy()
    df = spark.createDataFrame(list(zip(scores, y)), "raw DOUBLE, hazard INT")
    parts, learner = [], training.IsotonicRegression

    class Watched(learner):
        def _fit(self, rows):
            parts.append(rows.rdd.getNumPartitions())
            return super()._fit(rows)

    monkeypatch.setattr(training, "IsotonicRegression", Watched)
    monkeypatch.setattr(training, "POOLED_ROWS", 40)
    out, (name,) = with_calibrated(df.withColumn("score", F.col("raw")), ["raw"], [fit_isotonic(df, "raw")])
    want = pooled(scores, y)
    assert parts == [8]
    assert all(row[name] == pytest.approx(want[row.score], abs=1e-9) for row in out.collect())


def test_calibrator_kinds(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "raw DOUBLE")
    out, (name,) = with_calibrated(df.withColumn("r", F.col("raw")), ["raw"], [None])
    assert [r[name] for r in out.orderBy("r").collect()] == [0.0, 0.5, 1.0]
    out, (name,) = with_calibrated(df.withColumn("r", F.col("raw")), ["raw"], [Platt(1.0, 0.0)])
    assert [r[name] for r in out.orderBy("r").collect()] == pytest.approx([1e-6, 0.5, 1 - 1e-6])


@pytest.fixture(scope="module")
def dataset(spark):
    directory = "/root/testdata/sf0.01"
    return training_dataset(view(spark, directory, "fc"), view(spark, directory, "obs"))


@pytest.fixture(scope="module")
def ensemble(dataset):
    return train_all(dataset, QUICK, horizons=(24, 7))


def test_metrics_read_stored_scores(ensemble, dataset, monkeypatch):
    """Without the members' expressions and the split's subqueries in their plan."""
    plans = []

    def watched(scored, *columns):
        plans.append(scored._jdf.queryExecution().optimizedPlan().toString())
        return binary_metrics(scored, *columns)

    monkeypatch.setattr(training, "binary_metrics", watched)
    test = with_split(dataset.where("horizon_hours = 24"), training.ROW_KEYS).where("split = 'test'")
    found = training.evaluate(ensemble[24], test)
    assert plans[0].startswith("Relation") and plans[0].count("\n") <= 1
    direct = binary_metrics(score(test, ensemble[24]), "hazard", "risk_mean").first()
    assert found == pytest.approx({m: direct[m] for m in METRICS})


def test_training(ensemble):
    assert set(ensemble) == {24}
    trained = ensemble[24]
    assert len(trained.models) == len(trained.calibrators) == 2
    assert "lat" not in trained.features and len(trained.features) == 18
    assert set(trained.metrics) == set(METRICS)
    assert all(0 <= v <= 1 for v in trained.metrics.values())
    assert {m.getOrDefault("seed") for m in trained.models} == {42, 43}


def test_scores_are_ordered_probabilities(dataset, ensemble):
    out = score(dataset.where("horizon_hours = 24"), ensemble[24])
    wrong = out.where("not (0 <= risk_p10 and risk_p10 <= risk_p90 and risk_p90 <= 1 and risk_mean between 0 and 1)")
    assert out.count() == 4483 and wrong.count() == 0
    assert not [c for c in out.columns if c.startswith("_")]


def test_saved_is_loaded(spark, dataset, ensemble, tmp_path):
    save_ensemble(spark, ensemble[24], str(tmp_path / "m"))
    loaded = load_ensemble(spark, str(tmp_path / "m"))
    assert (loaded.horizon, loaded.features, loaded.method) == (24, ensemble[24].features, PLATT)
    rows = dataset.where("horizon_hours = 24").select("measurepoint_id", "ingest_seq", *loaded.features)
    keyed = lambda e: sorted((r.ingest_seq, r.risk_mean, r.risk_p90) for r in score(rows, e).collect())
    assert keyed(loaded) == keyed(ensemble[24])


def test_isotonic_ensemble_is_saved(spark, dataset, tmp_path):
    fitted = train_all(dataset, Settings(members=1, trees=1, depth=2, method=ISOTONIC), (48,))[48]
    save_ensemble(spark, fitted, str(tmp_path / "m"))
    loaded = load_ensemble(spark, str(tmp_path / "m"))
    assert loaded.method == ISOTONIC
    assert loaded.calibrators[0].boundaries == fitted.calibrators[0].boundaries


def test_single_model_folder(spark, dataset, ensemble, tmp_path):
    ensemble[24].models[0].write().overwrite().save(str(tmp_path / "model"))
    (tmp_path / "features").write_text(json.dumps(ensemble[24].features))
    loaded = load_ensemble(spark, str(tmp_path))
    assert loaded.calibrators == [None] and loaded.method == PLATT
    out = score(dataset.where("horizon_hours = 24"), loaded)
    assert out.where("risk_p10 <> risk_p90").count() == 0


def test_single_model_folder_with_a_line(spark, ensemble, tmp_path):
    ensemble[24].models[0].write().overwrite().save(str(tmp_path / "model"))
    (tmp_path / "features").write_text(json.dumps(ensemble[24].features))
    (tmp_path / "platt").write_text('{"slope": 0.5, "intercept": -1}')
    loaded = load_ensemble(spark, str(tmp_path))
    assert loaded.calibrators == [Platt(0.5, -1.0)] and loaded.method == PLATT


def test_a_failed_save_leaves_the_last_one(spark, ensemble, tmp_path):
    path = str(tmp_path / "m")
    save_ensemble(spark, ensemble[24], path)
    broken = Ensemble(24, ["other"], PLATT, [*ensemble[24].models, None], ensemble[24].calibrators + [None])
    with pytest.raises(AttributeError):
        save_ensemble(spark, broken, path)
    assert load_ensemble(spark, path).features == ensemble[24].features


def test_bounded_rows(spark):
    rows = spark.range(20_000).selectExpr(
        "id as measurepoint_id", "timestamp_seconds(id) as forecast_run_time",
        "timestamp_seconds(id) as valid_time", "cast(id % 10 = 0 as int) as hazard",
    )
    by_class = {r.hazard: r for r in bounded(rows, 3000, by_class=True).groupBy("hazard").agg(
        F.count("*").alias("n"), F.sum("_stands_for").alias("weight")).collect()}
    assert by_class[1].n == by_class[1].weight == 2000
    assert abs(by_class[0].n - 3000) < 200 and abs(by_class[0].weight - 18_000) < 1200
    alike = bounded(rows, 3000, by_class=False)
    assert abs(alike.count() - 3000) < 200 and abs(alike.where("hazard = 1").count() - 300) < 70
    assert bounded(rows, 20_000, by_class=False).count() == 20_000
    assert bounded(rows.limit(0), 5, by_class=True).count() == 0


def test_metrics_table(spark, ensemble, tmp_path):
    for _ in range(2):
        append_metrics(spark, list(ensemble.values()), str(tmp_path / "metrics"))
    assert spark.read.parquet(str(tmp_path / "metrics")).count() == 2


def test_prediction_rows(spark):
    directory = "/root/testdata/sf0.01"
    fc, obs = view(spark, directory, "fc"), view(spark, directory, "obs")
    rows = prediction_rows(fc, obs, NOW)
    span = rows.agg(F.min("valid_time").cast("string"), F.max("valid_time").cast("string")).first()
    assert span[0] >= "2024-01-28 00:00:00" and span[1] <= "2024-01-31 00:00:00"
    twice = fc.unionByName(fc.withColumn("ingest_seq", F.col("ingest_seq") + 100_000))
    alone = prediction_rows(twice, obs.limit(0), NOW)
    assert alone.count() == rows.count()
    assert alone.where("obs_age_minutes <> 1e6").count() == 0


@pytest.mark.parametrize("days", [0, 1, 2, 100])
def test_reaching_back(spark, days):
    """One point was last seen long ago, one never, one only after the run."""
    utc = lambda day, hour=0: dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc)
    fc = spark.createDataFrame(
        [(p, utc(27), utc(28, h), 1.0, p) for p in (1, 2, 3, 4) for h in (0, 1)],
        "measurepoint_id BIGINT, forecast_run_time TIMESTAMP, valid_time TIMESTAMP, rh DOUBLE, ingest_seq BIGINT",
    )
    obs = spark.createDataFrame(
        [(1, utc(3), 1.0, 0), (1, utc(26, 23), 2.0, 1), (2, utc(2), 3.0, 2), (2, utc(4), 4.0, 3), (4, utc(27, 1), 5.0, 4),
         (9, utc(26), 6.0, 5)],
        "measurepoint_id BIGINT, sample_time TIMESTAMP, air_rh DOUBLE, ingest_seq BIGINT",
    )
    dated = obs.withColumn("event_date", F.col("sample_time").cast("date"))
    back = scoring.reaching_back(scoring.features_to_score(fc, NOW), dated, days)
    assert back.count() == {0: 5, 1: 5, 2: 5, 100: 6}[days]
    shown = lambda o: sorted(
        (r.measurepoint_id, str(r.obs_time), r.obs_air_rh or 0) for r in prediction_rows(fc, o, NOW).collect()
    )
    assert shown(back) == shown(obs) and len(shown(obs)) == 4


def test_predict_store_serve(spark, ensemble, tmp_path, monkeypatch):
    directory = "/root/testdata/sf0.01"
    spark.sql(f"DROP TABLE IF EXISTS {PREDICTION.table}")
    rows = prediction_rows(view(spark, directory, "fc"), view(spark, directory, "obs"), NOW)
    predictions = predict(rows, ensemble)
    assert predictions.columns == [f.name for f in PREDICTION.schema]
    stored = store_predictions(spark, predictions)
    table = read_table(spark, PREDICTION)
    assert stored == table.count() == rows.where("horizon_hours = 24").count()
    shown = current_predictions(table, default_locations(spark), NOW).withColumn("ingest_seq", F.lit(0))
    listed = recommendation_list(shown, default_locations(spark)).collect()
    assert 1 <= len(listed) <= 5 and listed[0].point_name

    def fail(*_args, **_kwargs):
        raise OSError("no catalog")

    monkeypatch.setattr(scoring, "upsert", fail)
    path = str(tmp_path / "csv")
    assert store_predictions(spark, predictions, path) is None
    assert spark.read.option("header", True).csv(path).count() == stored
    with pytest.raises(OSError):
        store_predictions(spark, predictions)


def test_no_ensembles(spark):
    with pytest.raises(ValueError):
        predict(spark.range(1), {})


def test_training_rows_are_kept_before_members_ask_for_them(spark, monkeypatch):
    rows = spark.range(400).select(
        F.lit(24).alias("horizon_hours"), F.col("id").alias("measurepoint_id"),
        F.timestamp_seconds(1_704_067_200 + F.col("id") * 6 * 3600).alias("forecast_run_time"),
        F.timestamp_seconds(1_704_067_200 + F.col("id") * 6 * 3600 + 86_400).alias("valid_time"),
        (F.col("id") % 3 == 0).cast("int").alias("hazard"), (F.col("id") % 10).cast("double").alias("t_air_c"),
    )
    seen = []

    def fit(train, pos_weight, settings):
        stored = spark.sparkContext._jsc.sc().getRDDStorageInfo()
        seen.append(sum(s.numCachedPartitions() == s.numPartitions() for s in stored))
        raise InterruptedError

    before = sum(s.numCachedPartitions() > 0 for s in spark.sparkContext._jsc.sc().getRDDStorageInfo())
    monkeypatch.setattr(training, "fit_members", fit)
    with pytest.raises(InterruptedError):
        training.train_horizon(rows, 24, ["t_air_c"], QUICK)
    assert seen == [before + 1]


def _half_days(spark, n):
    run = F.timestamp_seconds(1_704_067_200 + F.col("id") * 6 * 3600)
    return spark.range(n).select(
        F.lit(24).alias("horizon_hours"), F.col("id").alias("measurepoint_id"), run.alias("forecast_run_time"),
        (run + F.expr("interval 1 day")).alias("valid_time"),
        (F.col("id") % 3 == 0).cast("int").alias("hazard"), (F.col("id") % 10).cast("double").alias("t_air_c"),
    )


def test_every_row_is_trained_and_calibrated_on(spark, monkeypatch):
    rows = _half_days(spark, 400)
    sizes = {r.split: r["count"] for r in with_split(rows, training.ROW_KEYS).groupBy("split").count().collect()}
    seen = {}

    def leave_out(rows, *_args, **_kwargs):
        return rows.limit(1).withColumn("_stands_for", F.lit(1.0))

    def fit(train, pos_weight, settings):
        seen["train"] = train.count()
        return []

    def calibrate(calibration, models, method):
        seen["calibration"] = calibration.count()
        raise InterruptedError

    for name, step in (("bounded", leave_out), ("fit_members", fit), ("fit_calibrators", calibrate)):
        monkeypatch.setattr(training, name, step)
    with pytest.raises(InterruptedError):
        training.train_horizon(rows, 24, ["t_air_c"], QUICK)
    assert seen == {name: sizes[name] for name in ("train", "calibration")}
    assert not {"train_rows", "calibration_rows"} & set(vars(Settings()))
