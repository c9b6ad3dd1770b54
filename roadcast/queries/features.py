"""Cleaning, calendar, horizon, as-of, label, lag and dataset queries."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadcast.functions.clean import (
    feature_flag,
    keep_columns,
    label_flag,
    utc_timestamp,
    with_measurepoint_id,
)
from roadcast.functions.risk import hazard
from roadcast.functions.times import age_minutes, at_horizons, calendar_features
from roadcast.operators.asof import attach_latest_observation, observation_features
from roadcast.operators.audit import attach_coverage, join_audit
from roadcast.operators.dedup import keep_last
from roadcast.operators.labels import hourly_labels
from roadcast.operators.lag import LAG_COLUMNS, LAG_ROWS, with_lags
from roadcast.operators.splits import (
    class_weights,
    set_sizes,
    with_random_split,
    with_time_split,
)
from roadcast.plans.dataset import complete_rows, training_dataset
from roadcast.plans.features import (
    filled_features,
    forecast_features,
    run_or_fallback,
    with_horizon,
)
from roadcast.plans.incremental import FIRST_TIMES, TRAINING_ROWS, update_training_rows
from roadcast.plans.lagged import WEATHER_LAGGED, upsert_with_lags
from roadcast.plans.scoring import union_by_name
from roadcast.queries.registry import comparable, query
from roadcast.queries.views import ctes, read_and_forget, table, view
from roadcast import schemas
from roadcast.schemas import FEATURES, HORIZONS
from roadcast.session import scratch_path
from roadcast.sources.tables import ensure_table, read_table, upsert

HORIZON_SQL = """
cast(round_even((epoch_us(valid_time) - epoch_us(forecast_run_time)) / 3.6e9, 0) as bigint)
"""

CALENDAR_SQL = """
cast(hour({t}) as int) as hour, cast(isodow({t}) - 1 as int) as day_of_week,
cast(month({t}) as int) as month,
cast(coalesce(hour({t}) in (7, 8, 9, 16, 17, 18), false) as int) as is_rush_hour,
cast(coalesce(isodow({t}) >= 6, false) as int) as is_weekend
"""

HAZARD_SQL = """
cast(coalesce(surface_temp_c < 0, false) or coalesce(surface_ice, false)
     or coalesce(surface_snow, false) or coalesce(surface_grip < 0.5, false) as int)
"""


def _rounded(*columns: str, prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{c}, 6) as {c}" for c in columns)


FC_VALUES = ("t_air_c", "precip_mm", "wind_ms", "rh")

# --- Cleaning ---------------------------------------------------------------

_MESSY = """
select event_id,
  case event_id % 9 when 0 then cast(user_id as {text}) when 1 then user_id || '.9'
       when 2 then ' ' || user_id || ' ' when 3 then user_id || 'e1' when 4 then user_id || 'd'
       when 5 then 'nan' when 6 then null when 7 then '-' || user_id else 'P' || user_id end
    as measurepoint_id,
  case event_id % 8 when 0 then 'true' when 1 then 'True' when 2 then '1' when 3 then '0'
       when 4 then 'false' when 5 then '2.7' when 6 then 'yes' else null end as text_flag,
  case event_id % 4 when 0 then 0e0 when 1 then 1e0 when 2 then 2.7e0 else null end as number_flag,
  case event_id % 3 when 0 then true when 1 then false else null end as boolean_flag,
  case event_id % 6 when 0 then {iso} || '+01:00' when 1 then {iso} || 'Z'
       when 2 then {minute} when 3 then {iso} || '.250-02:30' when 4 then 'x' else '' end
    as time_text,
  ts
from {events}
"""


def messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with identifiers, flags and times in the spellings sources use."""
    sql = _MESSY.format(
        text="string",
        iso="date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")",
        minute="date_format(ts, 'yyyy-MM-dd HH:mm')",
        events="{events}",
    )
    return spark.sql(sql, events=table(spark, sf_dir, "events"))


MESSY_CTE = "with messy as (" + _MESSY.format(
    text="varchar",
    iso="strftime(ts, '%Y-%m-%dT%H:%M:%S')",
    minute="strftime(ts, '%Y-%m-%d %H:%M')",
    events="events",
) + ")"


@query(
    "id_coerce",
    MESSY_CTE
    + """
select event_id, cast(trunc(cast(trim(measurepoint_id) as double)) as bigint) as measurepoint_id
from messy
where regexp_full_match(measurepoint_id, '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*')
""",
)
def id_coerce(spark, sf_dir):
    return with_measurepoint_id(messy(spark, sf_dir)).select("event_id", "measurepoint_id")


@query(
    "flag_normalise",
    MESSY_CTE
    + """
select event_id,
  cast(case text_flag when 'true' then 1 when 'True' then 1 when '1' then 1 when '2.7' then 2
       else 0 end as int) as text_feature,
  cast(text_flag is not distinct from 'true' as int) as text_label,
  cast(coalesce(trunc(number_flag), 0) as int) as number_feature,
  cast(coalesce(number_flag = 1, false) as int) as number_label,
  cast(coalesce(boolean_flag, false) as int) as boolean_feature,
  cast(coalesce(boolean_flag, false) as int) as boolean_label
from messy
""",
)
def flag_normalise(spark, sf_dir):
    df = messy(spark, sf_dir)
    return df.select(
        "event_id",
        *[
            column
            for kind in ("text", "number", "boolean")
            for column in (
                feature_flag(df, f"{kind}_flag").alias(f"{kind}_feature"),
                label_flag(df, f"{kind}_flag").alias(f"{kind}_label"),
            )
        ],
    )


@query(
    "utc_normalise",
    MESSY_CTE
    + """
select event_id,
  case event_id % 6
    when 0 then date_trunc('second', ts) - interval '1' hour
    when 1 then date_trunc('second', ts)
    when 2 then date_trunc('minute', ts)
    when 3 then date_trunc('second', ts) + interval '250' millisecond + interval '150' minute
    else null end as utc_time
from messy
""",
)
def utc_normalise(spark, sf_dir):
    df = messy(spark, sf_dir)
    return comparable(df.select("event_id", utc_timestamp(df, "time_text").alias("utc_time")))


@query(
    "observation_projection",
    ctes("obs")
    + """
select cast(measurepoint_id as bigint) as measurepoint_id, sample_time,
  round(surface_temp_c, 6) as surface_temp_c, round(surface_grip, 6) as surface_grip,
  round(air_temp_c, 6) as air_temp_c, cast(null as double) as air_rh,
  round(dewpoint_c, 6) as dewpoint_c, cast(surface_ice as int) as surface_ice,
  cast(surface_snow as int) as surface_snow, cast(surface_water as int) as surface_water,
  ingest_seq
from obs
""",
)
def observation_projection(spark, sf_dir):
    """One column is left out of the input and must come back as null."""
    return comparable(observation_features(view(spark, sf_dir, "obs").drop("air_rh")))


@query(
    "schema_align",
    ctes("obs")
    + """
select sample_time, round(surface_temp_c, 6) as surface_temp_c, ingest_seq from obs
""",
)
def schema_align(spark, sf_dir):
    stored = ["ingest_seq", "surface_temp_c", "sample_time", "not_in_the_frame"]
    return comparable(keep_columns(view(spark, sf_dir, "obs"), stored))


# --- Calendar, horizon, features ----------------------------------------------


@query(
    "calendar_features",
    "with times as (select event_id, case when event_id % 13 = 0 then null else ts end as t"
    " from events) select event_id, " + CALENDAR_SQL.format(t="t") + " from times",
)
def calendar(spark, sf_dir):
    """Every thirteenth time is missing: its parts are null, its flags 0."""
    events = table(spark, sf_dir, "events")
    times = events.select("event_id", F.when(F.col("event_id") % 13 != 0, F.col("ts")).alias("t"))
    return calendar_features(times, "t").drop("t")


@query(
    "horizon_filter",
    ctes("fc")
    + f"""
select cast(measurepoint_id as bigint) as measurepoint_id, forecast_run_time, valid_time,
  {HORIZON_SQL} as horizon_hours
from fc where {HORIZON_SQL} in (24, 48, 72)
""",
)
def horizon_filter(spark, sf_dir):
    kept = at_horizons(with_horizon(view(spark, sf_dir, "fc")))
    return comparable(
        kept.select(
            F.col("measurepoint_id").cast("bigint").alias("measurepoint_id"),
            "forecast_run_time",
            "valid_time",
            "horizon_hours",
        )
    )


_GAPS = """
select ingest_seq,
  case when ingest_seq % 3 = 0 then null else forecast_run_time end as forecast_run_time,
  case when ingest_seq % 6 = 0 then null
       else forecast_run_time + interval '2' minute end as ingested_at,
  valid_time
from {fc}
"""


@query(
    "run_time_fallback",
    ctes("fc")
    + ", gaps as ("
    + _GAPS.format(fc="fc")
    + """)
select ingest_seq, valid_time,
       coalesce(forecast_run_time, ingested_at, valid_time) as forecast_run_time
from gaps
""",
)
def run_time_fallback(spark, sf_dir):
    gaps = spark.sql(_GAPS.format(fc="{fc}"), fc=view(spark, sf_dir, "fc"))
    return comparable(
        gaps.select("ingest_seq", "valid_time", run_or_fallback(gaps).alias("forecast_run_time"))
    )


@query(
    "forecast_features",
    ctes("fc")
    + f"""
select cast(measurepoint_id as bigint) as measurepoint_id, forecast_run_time, valid_time,
  {_rounded(*FC_VALUES)}, ingest_seq, {HORIZON_SQL} as horizon_hours,
  {CALENDAR_SQL.format(t="valid_time")}
from fc
""",
)
def forecast_feature_rows(spark, sf_dir):
    return comparable(forecast_features(view(spark, sf_dir, "fc")))


@query(
    "hazard_flag",
    ctes("obs") + f"select ingest_seq, {HAZARD_SQL} as hazard from obs",
)
def hazard_flag(spark, sf_dir):
    obs = view(spark, sf_dir, "obs")
    return obs.select("ingest_seq", hazard(obs).alias("hazard"))


@query(
    "hourly_hazard_label",
    ctes("obs")
    + f"""
select cast(measurepoint_id as bigint) as measurepoint_id,
       date_trunc('hour', sample_time) as valid_time, max({HAZARD_SQL}) as hazard
from obs group by all
""",
)
def hourly_hazard_label(spark, sf_dir):
    obs = with_measurepoint_id(view(spark, sf_dir, "obs"))
    return comparable(hourly_labels(obs))


# --- As-of --------------------------------------------------------------------

_UNIQUE = """,
obs1 as (select * from obs qualify row_number() over
  (partition by measurepoint_id, sample_time order by ingest_seq desc) = 1),
fc1 as (select * from fc qualify row_number() over
  (partition by measurepoint_id, forecast_run_time, valid_time order by ingest_seq desc) = 1)
"""
_ATTACHED = """,
attached as (
  select f.*, o.sample_time as obs_time, o.surface_temp_c as obs_surface_temp_c,
    o.surface_grip as obs_surface_grip, o.air_temp_c as obs_air_temp_c, o.air_rh as obs_air_rh,
    o.dewpoint_c as obs_dewpoint_c, cast(o.surface_ice as int) as obs_surface_ice,
    cast(o.surface_snow as int) as obs_surface_snow,
    cast(o.surface_water as int) as obs_surface_water,
    coalesce((epoch_us(f.forecast_run_time) - epoch_us(o.sample_time)) / 6e7, 1e6)
      as obs_age_minutes
  from fc1 f asof left join obs1 o
    on f.measurepoint_id = o.measurepoint_id and f.forecast_run_time >= o.sample_time)
"""
_OBS_COLUMNS = """
  obs_time, round(obs_surface_temp_c, 6) as obs_surface_temp_c,
  round(obs_surface_grip, 6) as obs_surface_grip, round(obs_air_temp_c, 6) as obs_air_temp_c,
  round(obs_air_rh, 6) as obs_air_rh, round(obs_dewpoint_c, 6) as obs_dewpoint_c,
  obs_surface_ice, obs_surface_snow, obs_surface_water,
  obs_age_minutes
"""
_ASOF_SQL = ctes("obs", "fc") + _UNIQUE + _ATTACHED + f"""
select cast(measurepoint_id as bigint) as measurepoint_id, forecast_run_time, valid_time,
  {_rounded(*FC_VALUES)}, ingest_seq, {_OBS_COLUMNS}
from attached
"""


@query("asof_latest_observation", _ASOF_SQL)
def asof_latest_observation(spark, sf_dir):
    return comparable(
        attach_latest_observation(view(spark, sf_dir, "fc"), view(spark, sf_dir, "obs"))
    )


@query("asof_bucketed", _ASOF_SQL)
def asof_bucketed(spark, sf_dir):
    """Every point is treated as hot, so all rows take the way by time blocks."""
    return comparable(
        attach_latest_observation(
            view(spark, sf_dir, "fc"), view(spark, sf_dir, "obs"), hot_rows=0, grain="hour"
        )
    )


@query(
    "observation_age",
    ctes("obs")
    + """
select ingest_seq, coalesce((epoch_us(date_trunc('day', sample_time) + interval '1' day)
  - epoch_us(case when ingest_seq % 4 = 0 then null else sample_time end)) / 6e7, 1e6)
  as obs_age_minutes
from obs
""",
)
def observation_age(spark, sf_dir):
    obs = view(spark, sf_dir, "obs")
    run = F.date_trunc("day", "sample_time") + F.expr("interval 1 day")
    seen = F.when(F.col("ingest_seq") % 4 != 0, F.col("sample_time"))
    return comparable(obs.select("ingest_seq", age_minutes(seen, run).alias("obs_age_minutes")))


@query(
    "join_audit",
    ctes("obs", "fc")
    + """,
late as (select *, case when ingest_seq % 17 = 0 then null else forecast_run_time end as run from fc),
twice as (select * from obs union all select * from obs where surface_ice)
select 'forecast' as side, cast(sum(n) as bigint) as rows,
  cast(coalesce(sum(n) filter (where t is null), 0) as bigint) as null_times,
  cast(coalesce(sum(n - 1) filter (where t is not null), 0) as bigint) as duplicates,
  min(t) as min_time, max(t) as max_time
from (select measurepoint_id, run as t, valid_time, count(*) as n from late group by all)
union all
select 'observation', cast(sum(n) as bigint), 0, cast(sum(n - 1) as bigint), min(t), max(t)
from (select measurepoint_id, sample_time as t, count(*) as n from twice group by all)
""",
)
def join_audit_rows(spark, sf_dir):
    """Some run times are missing and icy observations come twice."""
    fc, obs = view(spark, sf_dir, "fc"), view(spark, sf_dir, "obs")
    late = fc.withColumn(
        "forecast_run_time", F.when(F.col("ingest_seq") % 17 != 0, F.col("forecast_run_time"))
    )
    return comparable(join_audit(late, obs.unionByName(obs.where("surface_ice"))))


@query(
    "attach_coverage",
    ctes("obs", "fc")
    + _UNIQUE
    + _ATTACHED
    + "select count(*) as rows, count(obs_time) as matched from attached",
)
def attach_coverage_counts(spark, sf_dir):
    return attach_coverage(
        attach_latest_observation(view(spark, sf_dir, "fc"), view(spark, sf_dir, "obs"))
    )


# --- Lags and dedup -------------------------------------------------------------

_LAGS_SQL = ctes("obs") + """
select ingest_seq, cast(measurepoint_id as bigint) as measurepoint_id, {lags}
from obs window w as (partition by measurepoint_id order by sample_time, ingest_seq)
""".format(
    lags=", ".join(
        f"round(lag({c}, {n}) over w, 6) as {c}_lag_{n}h" for c in LAG_COLUMNS for n in LAG_ROWS
    )
)
_LAG_NAMES = [f"{c}_lag_{n}h" for c in LAG_COLUMNS for n in LAG_ROWS]


@query("lag_features", _LAGS_SQL)
def lag_features(spark, sf_dir):
    obs = with_measurepoint_id(view(spark, sf_dir, "obs"))
    lagged = with_lags(obs, seq="ingest_seq")
    return comparable(lagged.select("ingest_seq", "measurepoint_id", *_LAG_NAMES))


@query("lag_features_chunked", _LAGS_SQL)
def lag_features_chunked(spark, sf_dir):
    """Every point is treated as hot and cut into small chunks."""
    obs = with_measurepoint_id(view(spark, sf_dir, "obs"))
    lagged = with_lags(obs, seq="ingest_seq", hot_rows=1, chunk_rows=100)
    return comparable(lagged.select("ingest_seq", "measurepoint_id", *_LAG_NAMES))


# The readings come in three batches: two spans of time, and then those that came late.
_BATCHES = ("ingest_seq % 10 <> 3 and day(sample_time) <= 15", "ingest_seq % 10 <> 3 and day(sample_time) > 15",
            "ingest_seq % 10 = 3")


@query(
    "lags_across_batches",
    ctes("obs")
    + f""",
last as (select * from obs qualify row_number() over (
  partition by measurepoint_id, sample_time order by ingest_seq desc) = 1)
select cast(measurepoint_id as bigint) as measurepoint_id, sample_time, {", ".join(
    f"round(lag({c}, {n}) over w, 6) as {c}_lag_{n}h" for c in LAG_COLUMNS for n in LAG_ROWS)}
from last window w as (partition by measurepoint_id order by sample_time)
""",
)
def lags_across_batches(spark, sf_dir):
    """The stored lags after all batches: those of the union."""
    spec = replace(WEATHER_LAGGED, name=f"{WEATHER_LAGGED.name}_{uuid.uuid4().hex}")
    obs = view(spark, sf_dir, "obs").withColumn("ingested_at", F.timestamp_seconds("ingest_seq"))
    place = scratch_path(spark, spec.table)
    for batch in _BATCHES:
        upsert_with_lags(spark, obs.where(batch), spec, location=place)
    return comparable(read_and_forget(spark, spec).select("measurepoint_id", "sample_time", *_LAG_NAMES))


_LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_ORDER = [
    "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
]


@query(
    "dedup_keep_last",
    f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity, 6) as l_quantity,
  round(l_extendedprice, 6) as l_extendedprice, round(l_discount, 6) as l_discount,
  round(l_tax, 6) as l_tax, l_returnflag, l_linestatus, l_shipdate
from lineitem
qualify row_number() over (partition by {", ".join(_LINE_KEY)}
  order by {", ".join(c + " desc" for c in _LINE_ORDER)}) = 1
""",
)
def dedup_keep_last(spark, sf_dir):
    return comparable(keep_last(table(spark, sf_dir, "lineitem"), _LINE_KEY, _LINE_ORDER))


# --- Dataset, splits, weights -----------------------------------------------------

_DATASET = _UNIQUE + _ATTACHED + f""",
labels1 as (
  select measurepoint_id, date_trunc('hour', sample_time) as valid_time,
         max({HAZARD_SQL}) as hazard
  from obs group by all),
dataset as (
  select a.*, {HORIZON_SQL} as horizon_hours, hazard
  from attached a join labels1 using (measurepoint_id, valid_time)
  where {HORIZON_SQL} in (24, 48, 72))
"""


@query(
    "training_dataset",
    ctes("obs", "fc")
    + _DATASET
    + f"""
select cast(measurepoint_id as bigint) as measurepoint_id, valid_time, forecast_run_time,
  {_rounded(*FC_VALUES)}, ingest_seq, horizon_hours, {_OBS_COLUMNS}, hazard,
  {CALENDAR_SQL.format(t="valid_time")}
from dataset
""",
)
def training_rows(spark, sf_dir):
    return comparable(training_dataset(view(spark, sf_dir, "fc"), view(spark, sf_dir, "obs")))


@query(
    "training_rows_incremental",
    ctes("obs", "fc")
    + _DATASET
    + f"""
select cast(measurepoint_id as bigint) as measurepoint_id, valid_time, forecast_run_time,
  {_rounded(*FC_VALUES)}, horizon_hours, {_OBS_COLUMNS}, hazard, {CALENDAR_SQL.format(t="valid_time")}
from dataset
""",
)
def training_rows_incremental(spark, sf_dir):
    """The stored training rows after an update that followed a late forecast, late
    observations and a correction: those of the full build."""
    suffix, place = f"_{uuid.uuid4().hex}", scratch_path(spark, "training-rows")
    specs = [
        replace(s, name=s.name + suffix)
        for s in (schemas.POINT_FORECAST, schemas.WEATHER_OBSERVATION, TRAINING_ROWS, FIRST_TIMES)
    ]
    for spec in specs[:2]:
        ensure_table(spark, spec, location=f"{place}/{spec.table}")
    fc, obs = (view(spark, sf_dir, v).withColumn("ingested_at", F.timestamp_seconds("ingest_seq")) for v in ("fc", "obs"))
    late = F.col("ingest_seq") % 29 == 3
    wrong = obs.where(~late).withColumn(
        "surface_temp_c", F.when(F.col("ingest_seq") % 31 == 4, -9.0).otherwise(F.col("surface_temp_c"))
    )
    upsert(spark, specs[0], fc.where(~late))
    upsert(spark, specs[1], wrong)
    update_training_rows(spark, *specs, location=place)
    upsert(spark, specs[0], fc.where(late))
    upsert(spark, specs[1], obs.where(late | (F.col("ingest_seq") % 31 == 4)))
    update_training_rows(spark, *specs, location=place)
    stored = read_table(spark, specs[2])
    for spec in specs:
        spark.sql(f"DROP TABLE {spec.table}")
    return comparable(stored.drop("lat", "lon", "ingested_at"))


@query(
    "training_summary",
    ctes("obs", "fc")
    + _DATASET
    + """
select horizon_hours, count(*) as rows, cast(sum(hazard) as bigint) as hazards,
  count(obs_time) as with_observation, round(sum(obs_age_minutes), 3) as age_minutes
from dataset group by horizon_hours
""",
)
def training_summary(spark, sf_dir):
    """Rows, hazards and observation coverage per horizon."""
    rows = training_dataset(view(spark, sf_dir, "fc"), view(spark, sf_dir, "obs"))
    return rows.groupBy("horizon_hours").agg(
        F.count("*").alias("rows"),
        F.sum(F.col("hazard").cast("bigint")).alias("hazards"),
        F.count("obs_time").alias("with_observation"),
        F.round(F.sum("obs_age_minutes"), 3).alias("age_minutes"),
    )


def _dataset(spark, sf_dir):
    return training_dataset(view(spark, sf_dir, "fc"), view(spark, sf_dir, "obs"))


_FILLED = ", ".join(
    f"round(coalesce(cast({c} as double), 0), 6) as {c}"
    for c in FEATURES
    if c not in ("lat", "lon", "obs_age_minutes")
)


@query(
    "feature_vector",
    ctes("obs", "fc")
    + _DATASET
    + f"""
select cast(measurepoint_id as bigint) as measurepoint_id, forecast_run_time, valid_time,
  {_FILLED}, obs_age_minutes, 0e0 as lat, 0e0 as lon
from (select *, {CALENDAR_SQL.format(t="valid_time")} from dataset)
""",
)
def feature_vector(spark, sf_dir):
    """All twenty features as filled doubles; the input has no position columns."""
    filled = filled_features(_dataset(spark, sf_dir), FEATURES)
    return comparable(
        filled.select("measurepoint_id", "forecast_run_time", "valid_time", *FEATURES)
    )


@query(
    "drop_incomplete",
    ctes("fc")
    + f""",
gaps as (
  select ingest_seq, valid_time,
    case when ingest_seq % 3 = 0 then null else {HORIZON_SQL} end as horizon_hours,
    case when rh >= 60 then 1 when rh >= 50 then 0 else null end as hazard
  from fc)
select * from gaps where hazard is not null and horizon_hours is not null
""",
)
def drop_incomplete(spark, sf_dir):
    fc = with_horizon(view(spark, sf_dir, "fc"))
    gaps = fc.select(
        "ingest_seq",
        "valid_time",
        F.when(F.col("ingest_seq") % 3 != 0, F.col("horizon_hours")).alias("horizon_hours"),
        F.when(F.col("rh") >= 60, 1).when(F.col("rh") >= 50, 0).alias("hazard"),
    )
    return comparable(complete_rows(gaps))


@query(
    "time_split_counts",
    ctes("fc")
    + """,
c1 as (select max(forecast_run_time) - interval '14' day as test_from from fc),
c2 as (select max(forecast_run_time) - interval '7' day as calibration_from
       from fc, c1 where forecast_run_time < test_from)
select count(*) filter (where forecast_run_time < calibration_from) as train,
  count(*) filter (where forecast_run_time >= calibration_from and forecast_run_time < test_from)
    as calibration,
  count(*) filter (where forecast_run_time >= test_from) as test
from fc, c1, c2
""",
)
def time_split_counts(spark, sf_dir):
    return set_sizes(with_time_split(view(spark, sf_dir, "fc")))


@query(
    "random_split_sizes",
    ctes("fc")
    + """
select count(*) - cast(floor(count(*) * 0.35e0) as bigint) as train,
  cast(floor(count(*) * 0.35e0) as bigint) - cast(floor(count(*) * 0.2e0) as bigint) as calibration,
  cast(floor(count(*) * 0.2e0) as bigint) as test
from fc
""",
)
def random_split_sizes(spark, sf_dir):
    keys = ["measurepoint_id", "forecast_run_time", "valid_time", "ingest_seq"]
    return set_sizes(with_random_split(view(spark, sf_dir, "fc"), keys))


@query(
    "class_weights",
    ctes("obs", "fc")
    + _DATASET
    + """
select horizon_hours, count(*) filter (where hazard = 0) as negatives,
  count(*) filter (where hazard = 1) as positives,
  round(count(*) filter (where hazard = 0)
        / greatest(count(*) filter (where hazard = 1), 1), 6) as pos_weight
from dataset group by horizon_hours
""",
)
def class_weight_rows(spark, sf_dir):
    return comparable(class_weights(_dataset(spark, sf_dir)))


@query(
    "union_horizons",
    ctes("fc")
    + f"""
select cast(measurepoint_id as bigint) as measurepoint_id, forecast_run_time, valid_time,
  {HORIZON_SQL} as horizon_hours,
  case when {HORIZON_SQL} = 72 then null else round(rh, 6) end as rh
from fc where {HORIZON_SQL} in (24, 48, 72)
""",
)
def union_horizons(spark, sf_dir):
    """One frame per horizon, one of them without humidity, put back together."""
    fc = with_measurepoint_id(with_horizon(view(spark, sf_dir, "fc"))).select(
        "measurepoint_id", "forecast_run_time", "valid_time", "horizon_hours", "rh"
    )
    parts = [fc.where(F.col("horizon_hours") == h) for h in HORIZONS]
    return comparable(union_by_name([*parts[:-1], parts[-1].drop("rh")]))
