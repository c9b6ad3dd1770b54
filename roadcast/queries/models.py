"""Training, calibration and scoring queries. The trees' scores have no counterpart in
SQL; it tells their keys and what must hold of them."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import functions as F

from roadcast import schemas
from roadcast.operators.metrics import METRICS
from roadcast.plans.dataset import training_dataset
from roadcast.plans.scoring import predict, prediction_rows, union_by_name
from roadcast.plans.training import (
    ISOTONIC,
    Settings,
    append_metrics,
    fit_isotonic,
    fit_platt,
    load_ensemble,
    save_ensemble,
    score,
    train_all,
    with_calibrated,
)
from roadcast.queries.registry import comparable, query
from roadcast.queries.views import ctes, read_and_forget, table, view
from roadcast.session import scratch_path
from roadcast.sources.tables import ensure_table, upsert

# The usual run but for the number of trees: with 2 trees, the 60 boosting rounds of 10
# members and 3 horizons took 46 s of small jobs on 8 cores over 10,000 events, so 200 trees
# would take more than an hour.
QUICK = Settings(trees=2)
NOW = dt.datetime(2024, 1, 28)


def _ensembles(spark, sf_dir, settings=QUICK):
    dataset = training_dataset(view(spark, sf_dir, "fc"), view(spark, sf_dir, "obs"))
    return train_all(dataset, settings)


# The keys of the rows to score.
_SCORED_KEYS = (
    ctes("fc")
    + """
select distinct measurepoint_id, forecast_run_time, valid_time, cast(h as bigint) as horizon_hours
from (select *, round_even((epoch_us(valid_time) - epoch_us(forecast_run_time)) / 3.6e9, 0) as h from fc)
where h in (24, 48, 72) and valid_time between timestamp '2024-01-28' and timestamp '2024-01-31'
"""
)


@query(
    "ensemble_train_score",
    f"""
select cast(measurepoint_id as bigint) as measurepoint_id, forecast_run_time, valid_time,
  horizon_hours, true as in_range, true as band_holds, true as decision_agrees, true as advice_agrees
from ({_SCORED_KEYS})
""",
)
def ensemble_train_score(spark, sf_dir):
    """Train for each horizon, save, load, score the coming 72 hours, store, read. Scores
    differ from any other learner's; shown are the keys and what must hold of the scores."""
    loaded = {}
    for horizon, ensemble in _ensembles(spark, sf_dir).items():
        path = scratch_path(spark, f"ensemble-{horizon}")
        save_ensemble(spark, ensemble, path)
        loaded[horizon] = load_ensemble(spark, path)
    rows = prediction_rows(view(spark, sf_dir, "fc"), view(spark, sf_dir, "obs"), NOW)
    spec = replace(schemas.PREDICTION, name=f"prediction_{uuid.uuid4().hex}")
    ensure_table(spark, spec, location=scratch_path(spark, spec.table))
    upsert(spark, spec, predict(rows, loaded), order=())
    mean, high = F.col("risk_mean"), F.col("risk_p90")
    level = (
        F.when((mean >= 0.7) | (high >= 0.85), "HIGH")
        .when((mean >= 0.4) | (high >= 0.6), "MODERATE")
        .otherwise("LOW")
    )
    return comparable(
        read_and_forget(spark, spec).select(
            "measurepoint_id",
            "forecast_run_time",
            "valid_time",
            "horizon_hours",
            (mean.between(0, 1) & F.col("risk_p10").between(0, 1) & high.between(0, 1)).alias("in_range"),
            (F.col("risk_p10") <= high).alias("band_holds"),
            (F.col("hazard_predicted") == (mean >= 0.5).cast("int")).alias("decision_agrees"),
            F.col("recommendation").startswith(level).alias("advice_agrees"),
        )
    )


@query(
    "ensemble_metrics",
    """
select unnest([24, 48, 72])::int as horizon_hours, true as in_range, cast(2 as bigint) as runs
""",
)
def ensemble_metrics(spark, sf_dir):
    """Held-out metrics per horizon, appended twice to a metrics table and read back."""
    path = scratch_path(spark, "metrics")
    trained = list(_ensembles(spark, sf_dir).values())
    for _ in range(2):
        append_metrics(spark, trained, path)
    found = spark.read.parquet(path)
    in_range = reduce(lambda a, b: a & b, [F.col(m).between(0, 1) for m in METRICS])
    return found.groupBy("horizon_hours").agg(
        F.every(in_range).alias("in_range"),
        F.count_distinct("run_id").alias("runs"),
    )


_TRAINING_KEYS = (
    ctes("fc", "obs")
    + """
select distinct f.measurepoint_id, forecast_run_time, f.valid_time, cast(h as bigint) as horizon_hours
from (select *, round_even((epoch_us(valid_time) - epoch_us(forecast_run_time)) / 3.6e9, 0) as h from fc) f
join (select distinct measurepoint_id, date_trunc('hour', sample_time) as valid_time from obs) l
  on f.measurepoint_id = l.measurepoint_id and f.valid_time = l.valid_time
where h in (24, 48, 72)
"""
)


@query(
    "ensemble_isotonic",
    f"""
select cast(measurepoint_id as bigint) as measurepoint_id, forecast_run_time, valid_time,
  horizon_hours, true as in_range, true as band_holds
from ({_TRAINING_KEYS})
""",
)
def ensemble_isotonic(spark, sf_dir):
    """Isotonically calibrated ensembles over all their feature rows."""
    ensembles = _ensembles(spark, sf_dir, replace(QUICK, method=ISOTONIC))
    dataset = training_dataset(view(spark, sf_dir, "fc"), view(spark, sf_dir, "obs"))
    scored = [
        score(dataset.where(F.col("horizon_hours") == horizon), ensemble)
        for horizon, ensemble in ensembles.items()
    ]
    ordered = (F.col("risk_p10") <= F.col("risk_p90")).alias("band_holds")
    return comparable(
        union_by_name(scored).select(
            "measurepoint_id",
            "forecast_run_time",
            "valid_time",
            "horizon_hours",
            F.col("risk_mean").between(0, 1).alias("in_range"),
            ordered,
        )
    )


_RAW_SQL = """
select event_id, value / (value + 40) as raw, (case when value + event_id % 37 > 45 then 1 else 0 end) as hazard
from events
"""


def _raw_scores(spark, sf_dir):
    """Uncalibrated scores and outcomes that lean the same way."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        (F.col("value") / (F.col("value") + 40)).alias("raw"),
        F.when(F.col("value") + F.col("event_id") % 37 > 45, 1).otherwise(0).alias("hazard"),
    )


def _fit_by_newton() -> str:
    """The logistic fit with a unit ridge on the slope, as one CTE per step."""
    steps = ["f0 as (select 0e0 as w, 0e0 as b)"]
    for i in range(12):
        steps.append(f"""
s{i} as (
  select w, b, sum((p - y) * x) + w as gx, sum(p - y) as g, sum(p * (1 - p) * x * x) + 1 as hxx,
    sum(p * (1 - p) * x) as hx, sum(p * (1 - p)) as h
  from (select w, b, x, y, 1 / (1 + exp(-(w * x + b))) as p from points, f{i}) group by w, b),
f{i + 1} as (
  select w - (h * gx - hx * g) / (hxx * h - hx * hx) as w, b - (hxx * g - hx * gx) / (hxx * h - hx * hx) as b
  from s{i})""")
    return ",\n".join(steps)


@query(
    "isotonic_calibration",
    f"""
with scores as (select event_id, round(raw, 2) as raw, hazard from ({_RAW_SQL})),
levels as (
  select raw, row_number() over (order by raw) as k, sum(n) over (order by raw) as n, sum(pos) over (order by raw) as pos
  from (select raw, count(*) as n, sum(hazard) as pos from scores group by raw)),
means as (
  select i.k as i, j.k as j, (j.pos - coalesce(p.pos, 0)) / (j.n - coalesce(p.n, 0))::double as mean
  from levels i join levels j on i.k <= j.k left join levels p on p.k = i.k - 1),
fitted as (
  select k, max(least) as value from (
    select l.k, m.i, min(m.mean) as least from levels l join means m on m.i <= l.k and m.j >= l.k
    group by l.k, m.i) group by k)
select event_id, round(value, 6) as calibrated
from scores join levels using (raw) join fitted using (k)
""",
)
def isotonic_calibration(spark, sf_dir):
    """Of scores to two places. The SQL says it as the largest, over all beginnings, of
    the least mean from there to any end."""
    scores = _raw_scores(spark, sf_dir).withColumn("raw", F.round("raw", 2))
    calibrated, (name,) = with_calibrated(scores, ["raw"], [fit_isotonic(scores, "raw")])
    return comparable(calibrated.select("event_id", F.col(name).alias("calibrated")))


@query(
    "platt_calibration",
    f"""
with points as (
  select event_id, ln(c / (1 - c)) as x, hazard as y
  from (select *, least(greatest(raw, 1e-6), 1 - 1e-6) as c from ({_RAW_SQL}))),
{_fit_by_newton()}
select event_id, round(1 / (1 + exp(-(w * x + b))), 6) as calibrated from points, f12
""",
)
def platt_calibration(spark, sf_dir):
    scores = _raw_scores(spark, sf_dir)
    calibrated, (name,) = with_calibrated(scores, ["raw"], [fit_platt(scores, "raw")])
    return comparable(calibrated.select("event_id", F.col(name).alias("calibrated")))
