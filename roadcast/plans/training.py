"""Per-horizon ensembles: fit, calibrate, evaluate, save, load."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadcast.functions.calibration import logit, platt
from roadcast.operators.audit import counting_coverage
from roadcast.operators.ensemble import ensemble_summary
from roadcast.operators.metrics import METRICS, binary_metrics
from roadcast.operators.quantiles import steps_of
from roadcast.operators.splits import class_weights, with_split
from roadcast.plans.dataset import complete_rows
from roadcast.plans.features import available_features, filled_features, with_vector
from roadcast.schemas import HORIZONS
from roadcast.session import (
    path_exists,
    read_note,
    remove_path,
    scratch_path,
    use_checkpoints,
    write_note,
)

PLATT, ISOTONIC = "platt", "isotonic"
NEWTON_STEPS = 30
# Values of a feature between which a tree may cut, and the rows from which on the learner
# would look for cuts in a sample of them.
STEPS, SAMPLED_FROM = 32, 10_000
# Scores that an isotonic fit holds in a task.
POOLED_ROWS = 500_000
ROW_KEYS = ("measurepoint_id", "forecast_run_time", "valid_time")

CURRENT = "current"
MANIFEST_COLUMNS = """
  horizon_hours INT, member INT, model STRING, method STRING, slope DOUBLE,
  intercept DOUBLE, calibrator STRING, features ARRAY<STRING>
"""


@dataclass(frozen=True)
class Settings:
    """What a training run may vary; the defaults are the usual run (fixed values)."""

    members: int = 10
    trees: int = 200
    depth: int = 5
    rate: float = 0.08
    subsample: float = 0.85
    columns: float = 0.85
    seed: int = 42
    method: str = PLATT
    # Members of one horizon fitted at the same time. Each is many small jobs, so a few
    # at once keep the executors busy.
    parallelism: int = 4
    test_days: int = 14
    calibration_days: int = 7


@dataclass(frozen=True)
class Platt:
    slope: float
    intercept: float


@dataclass
class Ensemble:
    """Members with their calibrators (``Platt``, an isotonic model, or None) and
    the feature order they were fitted on."""

    horizon: int
    features: list[str]
    method: str
    models: list[GBTClassificationModel]
    calibrators: list[Platt | IsotonicRegressionModel | None]
    metrics: dict[str, float] = field(default_factory=dict)


# --- Fitting ------------------------------------------------------------------


def bounded(rows: DataFrame, most: int, *, by_class: bool) -> DataFrame:
    """About ``most`` rows, or as many of each class, chosen by a hash of their key, with
    ``_stands_for``: how many rows each stands for. All rows where they are no more.
    For trials by hand: no training run leaves out a row."""
    counted = rows.groupBy("hazard").count().collect()  # two rows
    total = sum(r["count"] for r in counted)
    place = F.pmod(F.xxhash64(*ROW_KEYS, F.lit("bounded")), F.lit(1 << 30))
    share = F.lit(min(1.0, most / max(total, 1)))
    if by_class:
        share = F.lit(1.0)
        for r in counted:
            share = F.when(F.col("hazard") == r.hazard, min(1.0, most / r["count"])).otherwise(share)
    return rows.where(place < share * (1 << 30)).withColumn("_stands_for", 1.0 / share)


def stepped(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """The features, filled, with at most ``STEPS`` values each, found from all rows: every
    value becomes the nearest of them. The learner cuts halfway between two values it sees, so
    trees fitted on these send a row the same way by its own values."""
    df = filled_features(train, features)
    splits, nearest = {}, {}
    for name, found in steps_of(df, features, STEPS).items():
        values, edges = found[:1], []
        for value in found[1:]:
            # A row on the cut goes left. Neighbouring doubles have no room for a cut.
            edge = math.nextafter((values[-1] + value) / 2.0, math.inf)
            if values[-1] < edge <= value and (not edges or edge > edges[-1]):
                values.append(value)
                edges.append(edge)
        if edges:
            splits[name] = [-math.inf, *edges, math.inf]
            nearest[name] = F.get(F.array(*[F.lit(v) for v in values]), F.col(f"_step_{name}").cast("int"))
    if not splits:
        return df
    places = [f"_step_{name}" for name in splits]
    placed = Bucketizer(splitsArray=list(splits.values()), inputCols=list(splits), outputCols=places).transform(df)
    return placed.withColumns(nearest).drop(*places)


def fit_members(train: DataFrame, pos_weight: float, settings: Settings) -> list:
    """Boosted-tree members that differ in their seed. ``train`` has ``features`` and
    ``hazard``, and all its rows are fitted on. Beyond ``SAMPLED_FROM`` rows a feature has at
    most ``STEPS`` values (see ``stepped``)."""
    # No negatives gives weight 0, which would leave no rows to fit on.
    weight = pos_weight if pos_weight > 0 else 1.0
    rows = train.count()
    use_checkpoints(train.sparkSession)
    weighted = train.select(
        "features",
        F.col("hazard").cast("double").alias("label"),
        F.when(F.col("hazard") == 1, weight).otherwise(1.0).alias("weight"),
    )
    boosted = GBTClassifier(
        weightCol="weight",
        maxDepth=settings.depth,
        # The learner looks for cuts in as many rows as this squared, if more than in any case.
        # There are no more cuts than values.
        maxBins=math.isqrt(rows) + 1 if rows > SAMPLED_FROM else STEPS,
        stepSize=settings.rate,
        maxIter=settings.trees,
        subsamplingRate=settings.subsample,
        featureSubsetStrategy=str(settings.columns),
        # Cuts the lineage of the running errors; written to the shared folder.
        checkpointInterval=10,
    )
    seeds = [{boosted.seed: settings.seed + i} for i in range(settings.members)]
    fits = boosted.fitMultiple(weighted, seeds)
    models: list = [None] * settings.members
    fit_next = inheritable_thread_target(train.sparkSession)(lambda _: next(fits))
    with ThreadPool(min(settings.parallelism, settings.members)) as pool:
        for index, model in pool.imap_unordered(fit_next, range(settings.members)):
            models[index] = model
    return models


def with_raw_scores(df: DataFrame, models: Sequence) -> tuple[DataFrame, list[str]]:
    """Add one uncalibrated probability column per member; row by row, no shuffle."""
    names = [f"_raw_{i}" for i in range(len(models))]
    for name, model in zip(names, models):
        quiet = model.copy()
        quiet.setRawPredictionCol("").setPredictionCol("").setProbabilityCol("_vector")
        df = quiet.transform(df).withColumn(name, vector_to_array("_vector")[1]).drop("_vector")
    return df, names


def fit_platt(scored: DataFrame, raw: str, outcome: str = "hazard") -> Platt | None:
    """Sigmoid calibration by a logistic fit on the clipped log-odds, with the usual
    unit ridge on the slope. None when there is but one class to fit on."""
    return fit_platts(scored, [raw], outcome)[0]


def fit_platts(scored: DataFrame, raws: Sequence[str], outcome: str = "hazard") -> list[Platt | None]:
    """The same for several scores of the same rows, all in the same passes.

    Newton's method: each step is one pass that adds up five numbers for every score that
    has not converged yet.
    """
    y = F.col(outcome).cast("double")
    # A row without outcome or score takes part in none of that score's sums.
    rows = scored.select(y.alias("y"), *[F.when(y.isNotNull(), logit(F.col(r))).alias(f"x{i}") for i, r in enumerate(raws)])
    members = range(len(raws))
    classes = rows.agg(
        *[F.count(f"x{i}").alias(f"n{i}") for i in members],
        *[F.sum(F.when(F.col(f"x{i}").isNotNull(), F.col("y"))).alias(f"pos{i}") for i in members],
    ).first()
    lines = {i: (0.0, 0.0) for i in members if classes[f"n{i}"] and 0.0 < classes[f"pos{i}"] < classes[f"n{i}"]}
    going = set(lines)
    for _ in range(NEWTON_STEPS):
        if not going:
            break
        order = sorted(going)
        scores = rows.select(
            "y",
            *[f"x{i}" for i in order],
            *[(1.0 / (1.0 + F.exp(-(lines[i][0] * F.col(f"x{i}") + lines[i][1])))).alias(f"p{i}") for i in order],
        )
        sums = []
        for i in order:
            x, p = F.col(f"x{i}"), F.col(f"p{i}")
            curved = p * (1.0 - p)
            terms = {"gx": (p - F.col("y")) * x, "g": p - F.col("y"), "hxx": curved * x * x, "hx": curved * x, "h": curved}
            sums += [F.sum(term).alias(f"{name}{i}") for name, term in terms.items()]
        row = scores.agg(*sums).first()
        for i in order:
            gx, g, hxx, hx, h = (row[f"{name}{i}"] for name in ("gx", "g", "hxx", "hx", "h"))
            slope, intercept = lines[i]
            gx, hxx = gx + slope, hxx + 1.0
            determinant = hxx * h - hx * hx
            if determinant <= 0:
                going.discard(i)
                continue
            steps = ((h * gx - hx * g) / determinant, (hxx * g - hx * gx) / determinant)
            lines[i] = (slope - steps[0], intercept - steps[1])
            if max(map(abs, steps)) < 1e-11:
                going.discard(i)
    return [Platt(*lines[i]) if i in lines else None for i in members]


def fit_isotonic(scored: DataFrame, raw: str, outcome: str = "hazard") -> IsotonicRegressionModel:
    """Monotone calibration. Equal scores are averaged first, which gives the same
    fit and leaves one row per distinct score. The learner holds a partition at a time,
    so the number of partitions grows with the scores, pools neighbours within it, and
    only the pooled steps reach the driver, which also holds the model. Steps rise, so they
    are means of whole numbers that all differ: n rows of a partition leave n ** (2/3) of
    them at most, about, and with noisy outcomes few."""
    per_score = scored.groupBy(F.col(raw).alias("score")).agg(
        F.avg(F.col(outcome).cast("double")).alias("label"),
        F.count("*").cast("double").alias("weight"),
    )
    parts = -(-scored.count() // POOLED_ROWS)
    if parts > 1:
        per_score = per_score.repartition(parts, "score")
    return IsotonicRegression(featuresCol="score", weightCol="weight").fit(per_score)


def fit_calibrators(calibration: DataFrame, models: Sequence, method: str) -> list:
    """One calibrator per member. All members score the rows in one pass, kept in
    the shared folder for the fits that follow."""
    scored, raws = with_raw_scores(calibration, models)
    path = scratch_path(calibration.sparkSession, "calibration")
    try:
        scored.select("hazard", *raws).write.parquet(path)
        kept = calibration.sparkSession.read.parquet(path)
        if method == ISOTONIC:
            return [fit_isotonic(kept, raw) for raw in raws]
        return fit_platts(kept, raws)
    finally:
        remove_path(calibration.sparkSession, path)


# --- Scoring ------------------------------------------------------------------


def with_calibrated(
    df: DataFrame, raws: Sequence[str], calibrators: Sequence
) -> tuple[DataFrame, list[str]]:
    """Replace each raw score by its calibrated one; no calibrator leaves it as is."""
    names = [f"_p_{i}" for i in range(len(raws))]
    for raw, name, calibrator in zip(raws, names, calibrators):
        if calibrator is None:
            df = df.withColumn(name, F.col(raw))
        elif isinstance(calibrator, Platt):
            df = df.withColumn(name, platt(F.col(raw), calibrator.slope, calibrator.intercept))
        else:
            applied = calibrator.copy()
            applied.setFeaturesCol(raw).setPredictionCol(name)
            df = applied.transform(df)
    return df.drop(*raws), names


def score(df: DataFrame, ensemble: Ensemble) -> DataFrame:
    """Add ``risk_mean``, ``risk_p10`` and ``risk_p90``. Features the frame lacks
    count as 0."""
    scored, raws = with_raw_scores(with_vector(df, ensemble.features), ensemble.models)
    calibrated, members = with_calibrated(scored, raws, ensemble.calibrators)
    return ensemble_summary(calibrated.drop("features"), members)


def evaluate(ensemble: Ensemble, test: DataFrame) -> dict[str, float]:
    """Metrics of the test rows' scores, which are kept in the shared folder first: the
    metrics look at them several times, and each look would carry all members' expressions
    and the split's subqueries through the planner."""
    spark = test.sparkSession
    scored = score(test, ensemble).select("hazard", "risk_mean")
    path = scratch_path(spark, "test-scores")
    try:
        scored.write.parquet(path)
        kept = spark.read.schema(scored.schema).parquet(path)
        row = binary_metrics(kept, "hazard", "risk_mean").first()
    finally:
        remove_path(spark, path)
    return {m: float(row[m]) if row[m] is not None else 0.0 for m in METRICS}


# --- The training job -----------------------------------------------------------


def train_horizon(
    rows: DataFrame, horizon: int, features: Sequence[str], settings: Settings
) -> Ensemble:
    """Split, weigh, fit, calibrate and evaluate on one horizon's rows."""
    split = with_split(
        rows, ROW_KEYS, test_days=settings.test_days, calibration_days=settings.calibration_days
    )
    train = split.where(F.col("split") == "train")
    weight = class_weights(train).first()
    if weight and weight.negatives + weight.positives > SAMPLED_FROM:
        train = stepped(train, features)
    # Every boosting round reads these again; a lost executor's share is recomputed
    # from the dataset in the shared folder.
    kept = with_vector(train, features).select("features", "hazard").persist()
    try:
        # Filled before several members ask for it: they would wait for each other's blocks,
        # and their tasks hold the cores meanwhile.
        kept.count()
        models = fit_members(kept, weight.pos_weight if weight else 1.0, settings)
    finally:
        kept.unpersist()
    calibration = with_vector(split.where(F.col("split") == "calibration"), features)
    calibrators = fit_calibrators(calibration, models, settings.method)
    ensemble = Ensemble(horizon, list(features), settings.method, models, calibrators)
    ensemble.metrics = evaluate(ensemble, split.where(F.col("split") == "test"))
    return ensemble


def train_all(
    dataset: DataFrame,
    settings: Settings = Settings(),
    horizons: Sequence[int] = HORIZONS,
    coverage: str | None = None,
) -> dict[int, Ensemble]:
    """One ensemble per horizon that has rows. How many rows found an observation is
    appended to the ``coverage`` table, if one is given.

    The dataset comes from several joins and is read many times, so it is written
    to the shared folder once, partitioned by horizon.
    """
    spark = dataset.sparkSession
    features = available_features(dataset)
    path = scratch_path(spark, "training")
    # The learner samples rows by their place, and reads them thousands of times. A fixed
    # layout makes runs repeat, whatever way the joins before took, and is even. (By a
    # hash of the keys: by the keys themselves, Spark would drop the step where the rows
    # come partitioned that way, and then merge the partitions.)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid_out = complete_rows(dataset).repartition(parts, F.xxhash64(*ROW_KEYS))

    def train(horizon: int) -> Ensemble | None:
        rows = stored.where(F.col("horizon_hours") == horizon)
        return None if rows.isEmpty() else train_horizon(rows, horizon, features, settings)

    try:
        sorted_rows, counted = counting_coverage(laid_out.sortWithinPartitions("horizon_hours", *ROW_KEYS))
        sorted_rows.write.partitionBy("horizon_hours").parquet(path)
        stored = spark.read.parquet(path)
        if coverage:
            counted(spark).write.mode("append").parquet(coverage)
        # The horizons do not depend on each other, and most of their jobs are small.
        with ThreadPool(len(horizons)) as pool:
            trained = pool.map(inheritable_thread_target(spark)(train), horizons)
    finally:
        remove_path(spark, path)
    return {h: e for h, e in zip(horizons, trained) if e is not None}


# --- Saving and loading ---------------------------------------------------------


def save_ensemble(spark: SparkSession, ensemble: Ensemble, path: str) -> None:
    """Members and calibrators, with a manifest of one row per member, in a fresh folder
    under ``path``; a note naming that folder comes last, so that what is loaded is
    always whole."""
    folder = f"ensemble-{uuid.uuid4().hex}"
    _save(spark, ensemble, f"{path}/{folder}")
    write_note(spark, f"{path}/{CURRENT}", folder)


def _save(spark: SparkSession, ensemble: Ensemble, path: str) -> None:
    entries = []
    for i, (model, calibrator) in enumerate(zip(ensemble.models, ensemble.calibrators)):
        model.write().overwrite().save(f"{path}/model_{i}")
        saved = None
        if calibrator is not None and not isinstance(calibrator, Platt):
            saved = f"calibrator_{i}"
            calibrator.write().overwrite().save(f"{path}/{saved}")
        line = calibrator if isinstance(calibrator, Platt) else None
        entries.append(
            (
                ensemble.horizon,
                i,
                f"model_{i}",
                ensemble.method,
                line.slope if line else None,
                line.intercept if line else None,
                saved,
                ensemble.features,
            )
        )
    manifest = spark.createDataFrame(entries, MANIFEST_COLUMNS).coalesce(1)
    manifest.write.mode("overwrite").parquet(f"{path}/manifest")


def load_ensemble(spark: SparkSession, path: str) -> Ensemble:
    """Read what ``save_ensemble`` wrote. A folder without it holds a single ``model``,
    the ``features`` list as JSON text, and optionally a calibrator: ``calibrator`` with
    an isotonic model, or ``platt``, a JSON text of its slope and intercept."""
    current = read_note(spark, f"{path}/{CURRENT}")
    if current:
        path = f"{path}/{current}"
    elif not path_exists(spark, f"{path}/manifest"):
        def text(name: str):
            return json.loads(spark.read.text(f"{path}/{name}", wholetext=True).first().value)

        features, calibrator, method = text("features"), None, PLATT
        if path_exists(spark, f"{path}/calibrator"):
            calibrator = IsotonicRegressionModel.load(f"{path}/calibrator")
            method = ISOTONIC
        elif path_exists(spark, f"{path}/platt"):
            line = text("platt")
            calibrator = Platt(float(line["slope"]), float(line["intercept"]))
        model = GBTClassificationModel.load(f"{path}/model")
        return Ensemble(0, features, method, [model], [calibrator])
    # One row per member, so small.
    entries = spark.read.parquet(f"{path}/manifest").orderBy("member").collect()
    calibrators: list = []
    for entry in entries:
        if entry.calibrator is not None:
            calibrators.append(IsotonicRegressionModel.load(f"{path}/{entry.calibrator}"))
        elif entry.slope is not None:
            calibrators.append(Platt(entry.slope, entry.intercept))
        else:
            calibrators.append(None)
    return Ensemble(
        entries[0].horizon_hours,
        list(entries[0].features),
        entries[0].method or PLATT,
        [GBTClassificationModel.load(f"{path}/{e.model}") for e in entries],
        calibrators,
    )


def append_metrics(
    spark: SparkSession, ensembles: Sequence[Ensemble], path: str, run_id: str | None = None
) -> DataFrame:
    """Append one row per horizon to the metrics table, under the run's id, a new one
    unless given; returns the rows added."""
    run_id = run_id or uuid.uuid4().hex
    rows = spark.createDataFrame(
        [(run_id, e.horizon, *[e.metrics[m] for m in METRICS]) for e in ensembles],
        "run_id STRING, horizon_hours INT, " + ", ".join(f"{m} DOUBLE" for m in METRICS),
    )
    rows.write.mode("append").parquet(path)
    return rows
