"""Risk, serving, ensemble, metric and calibration queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from roadcast.functions.calibration import platt
from roadcast.functions.risk import (
    hazard_predicted,
    recommendation,
    risk_colour,
    risk_level,
    severity,
)
from roadcast.functions.times import in_valid_window
from roadcast.operators.ensemble import ensemble_summary, long_ensemble_summary
from roadcast.operators.metrics import binary_metrics
from roadcast.operators.serving import (
    at_horizon,
    best_per_point,
    by_severity,
    key_figures,
    latest_run,
    map_points,
    numeric_ids,
    repair_schema,
    risk_buckets,
    timeline,
    with_point_name,
)
from roadcast.plans.serving import current_predictions, recommendation_list
from roadcast.queries.registry import comparable, query
from roadcast.queries.views import ctes, table, view
from roadcast.sources.locations import default_locations

NOW = dt.datetime(2024, 1, 15, 10, 30)

PRED_COLUMNS = """
  cast(measurepoint_id as bigint) as measurepoint_id, forecast_run_time, valid_time,
  cast(horizon_hours as bigint) as horizon_hours, round(risk_mean, 6) as risk_mean,
  round(risk_p10, 6) as risk_p10, round(risk_p90, 6) as risk_p90, ingest_seq
"""

LOCATIONS_CTE = """,
locations as (select * from (values
  ('MP001', 'E4 Norrtull', 59.357e0, 18.05e0, 243), ('MP002', 'E4 Häggvik', 59.433e0, 17.933e0, 226),
  ('MP003', 'E18 Jakobsberg', 59.422e0, 17.833e0, 232),
  ('MP004', 'E20 Essingeleden', 59.327e0, 18.0e0, 237),
  ('MP005', 'Rv73 Nynäsvägen', 59.267e0, 18.083e0, 215)) v(id, name, lat, lon, tv_id))
"""


def predictions(spark, sf_dir):
    df = view(spark, sf_dir, "pred")
    return df.withColumns(
        {c: F.col(c).cast("bigint") for c in ("measurepoint_id", "horizon_hours")}
    )


# --- Decisions ------------------------------------------------------------------


@query(
    "risk_level",
    ctes("pred")
    + """
select ingest_seq,
  case when risk_mean > 0.7 then 'HIGH' when risk_mean > 0.4 then 'MEDIUM' else 'LOW' end
    as risk_level,
  case when risk_mean > 0.7 then '#FF0000' when risk_mean > 0.4 then '#FFA500' else '#00CC00' end
    as risk_colour
from pred
""",
)
def risk_levels(spark, sf_dir):
    risk = F.col("risk_mean")
    return predictions(spark, sf_dir).select(
        "ingest_seq", risk_level(risk).alias("risk_level"), risk_colour(risk).alias("risk_colour")
    )


@query(
    "recommendation",
    ctes("pred")
    + """
select ingest_seq,
  case when risk_mean >= 0.7 or coalesce(risk_p90, risk_mean) >= 0.85
         then 'HIGH: Salting recommended within 2 hours'
       when risk_mean >= 0.4 or coalesce(risk_p90, risk_mean) >= 0.6
         then 'MODERATE: Standby for salting, prepare equipment'
       else 'LOW: Normal operations, continue monitoring' end as recommendation
from pred
""",
)
def recommendations(spark, sf_dir):
    return predictions(spark, sf_dir).select(
        "ingest_seq", recommendation(F.col("risk_mean"), F.col("risk_p90")).alias("recommendation")
    )


@query(
    "hazard_decision",
    ctes("pred")
    + "select ingest_seq, cast(risk_mean >= 0.5 as int) as hazard_predicted from pred",
)
def hazard_decision(spark, sf_dir):
    return predictions(spark, sf_dir).select(
        "ingest_seq", hazard_predicted(F.col("risk_mean")).alias("hazard_predicted")
    )


# --- Selection -------------------------------------------------------------------


@query(
    "latest_run_predictions",
    ctes("pred")
    + f"select {PRED_COLUMNS} from pred"
    + " where forecast_run_time = (select max(forecast_run_time) from pred)",
)
def latest_run_predictions(spark, sf_dir):
    return comparable(latest_run(predictions(spark, sf_dir)))


@query(
    "valid_window",
    ctes("pred")
    + f"""
select {PRED_COLUMNS} from pred
where valid_time between timestamp '2024-01-15 10:00:00' and timestamp '2024-01-18 10:00:00'
""",
)
def valid_window(spark, sf_dir):
    return comparable(in_valid_window(predictions(spark, sf_dir), NOW))


@query(
    "schema_repair",
    ctes("pred")
    + """
select ingest_seq, round(risk_mean, 6) as risk_probability, round(risk_p10, 6) as risk_p10,
  round(risk_mean, 6) as risk_mean, cast(null as double) as risk_p90
from pred
""",
)
def schema_repair(spark, sf_dir):
    older = predictions(spark, sf_dir).select(
        "ingest_seq", F.col("risk_mean").alias("risk_probability"), "risk_p10"
    )
    return comparable(repair_schema(older))


@query(
    "horizon_choice",
    ctes("pred") + f"select {PRED_COLUMNS} from pred where horizon_hours = 48",
)
def horizon_choice(spark, sf_dir):
    return comparable(at_horizon(predictions(spark, sf_dir), 48))


_ALIASED = """
case when ingest_seq % 3 = 0 then cast(measurepoint_id as {text})
     when ingest_seq % 3 = 1 and measurepoint_id = 243 then 'MP001'
     when ingest_seq % 3 = 1 and measurepoint_id = 226 then 'MP002'
     when ingest_seq % 3 = 1 and measurepoint_id = 232 then 'MP003'
     when ingest_seq % 3 = 1 and measurepoint_id = 237 then 'MP004'
     when ingest_seq % 3 = 1 then 'MP005' else 'somewhere' end
"""


def _aliased(spark, sf_dir):
    df = predictions(spark, sf_dir)
    return df.withColumn("measurepoint_id", F.expr(_ALIASED.format(text="string")))


@query(
    "alias_ids",
    ctes("pred")
    + """
select ingest_seq, cast(case when ingest_seq % 3 = 2 then null else measurepoint_id end as bigint)
  as measurepoint_id
from pred
""",
)
def alias_ids(spark, sf_dir):
    """Identifiers come as numbers, aliases and unknown text."""
    numbered = numeric_ids(_aliased(spark, sf_dir), default_locations(spark))
    return numbered.select("ingest_seq", "measurepoint_id")


@query(
    "current_predictions",
    ctes("pred")
    + f"""
select {PRED_COLUMNS.replace("cast(measurepoint_id as bigint)",
        "cast(case when ingest_seq % 3 = 2 then null else measurepoint_id end as bigint)")}
from pred
where forecast_run_time = (select max(forecast_run_time) from pred)
  and valid_time between timestamp '2024-01-31 08:00:00' and timestamp '2024-02-03 08:00:00'
""",
)
def current_prediction_rows(spark, sf_dir):
    return comparable(
        current_predictions(
            _aliased(spark, sf_dir), default_locations(spark), dt.datetime(2024, 1, 31, 8, 59)
        )
    )


# --- Dimension lookups --------------------------------------------------------------

_SOME_UNKNOWN = "case when ingest_seq % 4 = 0 then 999 else measurepoint_id end"


def _some_unknown(spark, sf_dir):
    return predictions(spark, sf_dir).select(
        "ingest_seq",
        F.expr(_SOME_UNKNOWN).cast("bigint").alias("measurepoint_id"),
        "risk_mean",
    )


@query(
    "dimension_lookup",
    ctes("pred")
    + LOCATIONS_CTE
    + f"""
select p.ingest_seq, cast(p.mp as bigint) as measurepoint_id, round(risk_mean, 6) as risk_mean,
  coalesce(l.name, cast(p.mp as varchar)) as point_name
from (select *, {_SOME_UNKNOWN} as mp from pred) p left join locations l on l.tv_id = p.mp
""",
)
def dimension_lookup(spark, sf_dir):
    return comparable(with_point_name(_some_unknown(spark, sf_dir), default_locations(spark)))


@query(
    "map_points",
    ctes("pred")
    + LOCATIONS_CTE
    + f"""
select p.ingest_seq, cast(p.mp as bigint) as measurepoint_id, round(risk_mean, 6) as risk_mean,
  l.lat, l.lon, l.name as point_name
from (select *, {_SOME_UNKNOWN} as mp from pred) p join locations l on l.tv_id = p.mp
""",
)
def map_point_rows(spark, sf_dir):
    return comparable(map_points(_some_unknown(spark, sf_dir), default_locations(spark)))


# --- Reports ---------------------------------------------------------------------


@query(
    "serving_kpis",
    ctes("pred")
    + """
select count(*) filter (where risk_mean > 0.7) as high_risk,
  round(avg(risk_mean) * 100, 6) as avg_risk_pct, count(distinct measurepoint_id) as points
from pred
""",
)
def serving_kpis(spark, sf_dir):
    return comparable(key_figures(predictions(spark, sf_dir)))


@query(
    "risk_buckets",
    ctes("pred")
    + """
select count(*) filter (where risk_mean > 0.7) as high,
  count(*) filter (where risk_mean > 0.4 and risk_mean <= 0.7) as medium,
  count(*) filter (where risk_mean <= 0.4) as low
from pred
""",
)
def risk_bucket_counts(spark, sf_dir):
    return risk_buckets(predictions(spark, sf_dir))


@query(
    "top_recommendation_per_point",
    ctes("pred")
    + LOCATIONS_CTE
    + f"""
select cast(measurepoint_id as bigint) as measurepoint_id, forecast_run_time, valid_time,
  cast(horizon_hours as bigint) as horizon_hours, round(risk_mean, 6) as risk_mean,
  round(risk_p10, 6) as risk_p10, round(risk_p90, 6) as risk_p90, ingest_seq,
  coalesce(l.name, cast(measurepoint_id as varchar)) as point_name,
  case when risk_mean > 0.7 then 'HIGH' when risk_mean > 0.4 then 'MEDIUM' else 'LOW' end
    as risk_level,
  case when risk_mean > 0.7 then '#FF0000' when risk_mean > 0.4 then '#FFA500' else '#00CC00' end
    as risk_colour
from (select * from pred qualify row_number() over (partition by measurepoint_id
        order by valid_time desc nulls last, risk_mean desc nulls last, ingest_seq) = 1) p
left join locations l on l.tv_id = p.measurepoint_id
order by risk_mean desc
""",
)
def top_recommendation_per_point(spark, sf_dir):
    return comparable(recommendation_list(predictions(spark, sf_dir), default_locations(spark)))


@query(
    "best_row_per_run",
    ctes("pred")
    + f"""
select {PRED_COLUMNS} from (
  select * from (select *, measurepoint_id || '@' || horizon_hours as name from pred)
  qualify row_number() over (partition by name
    order by valid_time desc nulls last, risk_p90 desc nulls last, ingest_seq) = 1)
""",
)
def best_row_per_run(spark, sf_dir):
    """Another key and score name, and scores that may be missing."""
    df = predictions(spark, sf_dir)
    named = df.select(
        F.concat_ws("@", "measurepoint_id", "horizon_hours").alias("name"),
        F.col("measurepoint_id").alias("mp"),
        "forecast_run_time",
        "valid_time",
        "horizon_hours",
        F.col("risk_mean").alias("mean"),
        "risk_p10",
        F.col("risk_p90").alias("score"),
        "ingest_seq",
    )
    best = best_per_point(named).drop("name")
    return comparable(
        best.withColumnsRenamed({"mp": "measurepoint_id", "mean": "risk_mean", "score": "risk_p90"})
    )


_SEVERITY = "case when risk_mean > 0.7 then 2 when risk_mean > 0.4 then 1 else 0 end"


@query(
    "severity_order",
    ctes("pred")
    + f"""
select ingest_seq, round(risk_mean, 6) as risk_mean, {_SEVERITY} as severity
from (select ingest_seq, case when ingest_seq % 10 = 0 then null else risk_mean end as risk_mean
      from pred)
order by {_SEVERITY} desc, risk_mean desc nulls last, ingest_seq
""",
)
def severity_order(spark, sf_dir):
    df = predictions(spark, sf_dir).select(
        "ingest_seq", F.when(F.col("ingest_seq") % 10 != 0, F.col("risk_mean")).alias("risk_mean")
    )
    return comparable(by_severity(df.withColumn("severity", severity(df))))


@query(
    "point_timeline",
    ctes("pred")
    + f"""
select {PRED_COLUMNS},
  bool_or(risk_p10 is not null) over (partition by measurepoint_id)
    and bool_or(risk_p90 is not null) over (partition by measurepoint_id) as has_band
from (select * replace (case when measurepoint_id = 226 then null else risk_p90 end as risk_p90)
      from pred)
order by measurepoint_id, valid_time
""",
)
def point_timeline(spark, sf_dir):
    """All points at once; one of them has no upper band."""
    df = predictions(spark, sf_dir)
    df = df.withColumn("risk_p90", F.when(F.col("measurepoint_id") != 226, F.col("risk_p90")))
    return comparable(timeline(df))


# --- Ensembles, metrics, calibration ----------------------------------------------

_QUANTILES_SQL = ctes("member") + """
select event_id, round(avg(prob), 6) as risk_mean,
  round(quantile_cont(prob, 0.1), 6) as risk_p10, round(quantile_cont(prob, 0.9), 6) as risk_p90
from member group by event_id
"""


@query("ensemble_quantiles", _QUANTILES_SQL)
def ensemble_quantiles(spark, sf_dir):
    """Members as columns, as scoring has them."""
    events = table(spark, sf_dir, "events")
    names = [f"p{i}" for i in range(10)]
    base = (F.col("event_id") * 7919 % 1000) / F.lit(1000.0)
    members = {n: F.least(F.lit(1.0), base + F.lit(i) * F.lit(0.01)) for i, n in enumerate(names)}
    return comparable(ensemble_summary(events.select("event_id").withColumns(members), names))


@query("ensemble_quantiles_long", _QUANTILES_SQL)
def ensemble_quantiles_long(spark, sf_dir):
    """Members as rows."""
    return comparable(long_ensemble_summary(view(spark, sf_dir, "member"), ["event_id"]))


_METRICS_SQL = """,
per_score as (select score, count(*) as n, cast(sum(y) as bigint) as pos from {source} group by score),
run as (select *, sum(n) over w as n_down, sum(pos) over w as pos_down,
               sum(n) over () as total, sum(pos) over () as total_pos
        from per_score window w as (order by score desc))
select
  round(sum((n - pos) * (pos_down - pos + pos / 2e0)) / max(total_pos * (total - total_pos)), 6)
    as auc,
  round(sum(pos * (pos_down / n_down)) / max(total_pos), 6) as average_precision,
  round(sum(pos * (1 - score) * (1 - score) + (n - pos) * score * score) / max(total), 6) as brier,
  round(cast(sum(case when score >= 0.5 then pos else n - pos end) as double) / max(total), 6)
    as accuracy
from run
"""


@query("binary_metrics", ctes("scored") + _METRICS_SQL.format(source="scored"))
def label_metrics(spark, sf_dir):
    return comparable(binary_metrics(view(spark, sf_dir, "scored")))


_EVENT_SCORES = """
select case when event_type in ('error', 'purchase') then 1 else 0 end as y,
       value / (value + 40e0) as score
from {events}
"""


@query(
    "binary_metrics_events",
    "with scores as (" + _EVENT_SCORES.format(events="events") + ")"
    + _METRICS_SQL.format(source="scores"),
)
def event_metrics(spark, sf_dir):
    """Continuous scores, almost all of them distinct."""
    scores = spark.sql(
        _EVENT_SCORES.format(events="{events}"), events=table(spark, sf_dir, "events")
    )
    return comparable(binary_metrics(scores))


@query(
    "platt_apply",
    ctes("pred")
    + """
select ingest_seq, round(1 / (1 + exp(-(1.3e0 * ln(p / (1 - p)) + -0.4e0))), 6) as calibrated
from (select ingest_seq, least(greatest(risk_mean, 1e-6), 1 - 1e-6) as p from pred)
""",
)
def platt_apply(spark, sf_dir):
    calibrated = platt(F.col("risk_mean"), 1.3, -0.4)
    return comparable(
        predictions(spark, sf_dir).select("ingest_seq", calibrated.alias("calibrated"))
    )
