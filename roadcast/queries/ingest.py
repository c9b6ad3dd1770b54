"""Payload extraction, landing, tables, refresh and streaming queries.

Payload text is built from the events, one payload per event, so the work grows with
the table and the expected rows can be told from the events directly.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from roadcast import schemas
from roadcast.operators.audit import zones_join_audit
from roadcast.operators.dedup import keep_last
from roadcast.plans import jobs
from roadcast.plans.refresh import landing_feeds, refresh, total_rows
from roadcast.plans.scoring import with_decision
from roadcast.queries.registry import comparable, query
from roadcast.queries.serving import LOCATIONS_CTE, PRED_COLUMNS, predictions
from roadcast.queries.views import ctes, read_and_forget, table
from roadcast.session import scratch_path
from roadcast.sources import extract
from roadcast.sources.forecasts import location_errors, location_forecasts
from roadcast.sources.landing import quarantined, read_landing
from roadcast.sources.ledger import read_ledger
from roadcast.sources.locations import all_entries, default_locations, locations
from roadcast.sources.tables import (
    align_to_table,
    ensure_table,
    merged,
    read_table,
    table_columns,
    table_versions,
    table_zones,
    upsert,
    write_csv,
)
from roadcast.streaming.landing import stream_landing, stream_to_table

_ISO = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
_POINT = """case user_id % 5 when 0 then 243 when 1 then 226 when 2 then 232
            when 3 then 237 else 215 end"""
_ALIAS = """case user_id % 5 when 0 then 'MP001' when 1 then 'MP002' when 2 then 'MP003'
            when 3 then 'MP004' else 'MP005' end"""


def _landed(spark: SparkSession, sf_dir: str, body: str, *extra: str) -> DataFrame:
    """One payload per event, with the body given as an SQL expression."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.expr(body).alias("body"),
        F.col("event_id").cast("string").alias("payload_id"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
        *[F.expr(e) for e in extra],
    )


# --- Payload bodies ---------------------------------------------------------------

# Two observations: one from the event, and one with nothing but an unreadable time.
# Some identifiers are fractional.
WEATHER_BODY = f"""
to_json(named_struct('RESPONSE', named_struct('RESULT', array(named_struct(
  'WeatherObservation', array(
    named_struct(
      'Measurepoint', named_struct(
        'Id', case when event_id % 13 = 0 then '243.5' else cast({_POINT} as string) end,
        'Name', concat('P', user_id), 'Geometry', named_struct('WGS84', 'POINT (18.05 59.357)')),
      'Sample', concat({_ISO}, '+01:00'),
      'Surface', named_struct(
        'Temperature', named_struct('Value', value / 10 - 2), 'Water', event_id % 5 = 0,
        'Ice', event_type = 'error', 'Snow', event_type = 'signup',
        'Grip', named_struct('Value', case when event_id % 7 = 0 then null
                                           else 0.3e0 + (event_id * 37 % 70) / 100e0 end)),
      'Air', named_struct(
        'Temperature', named_struct('Value', value / 10 - 1),
        'RelativeHumidity', named_struct('Value', 40e0 + event_id % 60),
        'Dewpoint', named_struct('Value', value / 10 - 4))),
    named_struct(
      'Measurepoint', null, 'Sample', 'bad', 'Surface', null, 'Air', null)))))))
"""

# One to three deviations; every seventh situation has none.
SITUATION_BODY = f"""
to_json(named_struct('RESPONSE', named_struct('RESULT', array(named_struct(
  'Situation', array(named_struct(
    'Id', concat('S', user_id), 'PublicationTime', concat({_ISO}, 'Z'),
    'VersionTime', concat({_ISO}, 'Z'),
    'Deviation', case when event_id % 7 = 0 then null else
      transform(sequence(0, cast(event_id % 3 as int)), i -> named_struct(
        'MessageType', event_type, 'MessageTypeValue', concat(event_type, i),
        'SeverityCode', i, 'StartTime', concat({_ISO}, '+02:00'),
        'Suspended', event_id % 2 = 0,
        'Geometry', named_struct('Point', named_struct('WGS84', concat('POINT (', i, ' 59)')))))
      end)))))))
"""

# Up to three readings, the first two at one depth.
FROST_BODY = f"""
to_json(named_struct('RESPONSE', named_struct('RESULT', array(named_struct(
  'FrostDepthObservation', array(named_struct(
    'Measurepoint', named_struct('Id', {_POINT}, 'Name', concat('P', user_id)),
    'FrostDepth', named_struct('Sample', concat({_ISO}, 'Z'), 'Temperature',
      transform(filter(sequence(0, 2), i -> i < event_id % 4), i -> named_struct(
        'SensorName', concat('s', i), 'Depth', case when i < 2 then 10 else 20 end,
        'Value', value / 100 + i))))))))))
"""

# Two steps. "t" comes twice, "ws" is empty, "pmean" is missing; the run time is in
# the first field, the second, or unreadable.
FORECAST_BODY = f"""
to_json(named_struct(
  'approvedTime', case event_id % 4 when 0 then '' when 1 then concat({_ISO}, 'Z')
                                    when 2 then 'unreadable' else null end,
  'referenceTime', concat({_ISO}, '-01:00'),
  'timeSeries', transform(array(24, 48), h -> named_struct(
    'validTime', date_format(date_trunc('hour', ts) + make_interval(0, 0, 0, 0, h),
                             "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    'parameters', array(
      named_struct('name', 't', 'values', array(-50e0)),
      named_struct('name', 't', 'values', array(value / 10 - 3 + h)),
      named_struct('name', 'ws', 'values', array()),
      named_struct('name', 'r', 'values', array(40e0 + event_id % 60, 1e0)))))))
"""

# --- Extraction ---------------------------------------------------------------------

_WEATHER_VALUES = """
  round(value / 10 - 2, 6) as surface_temp_c,
  case when event_id % 5 = 0 then 'true' else 'false' end as surface_water,
  case when event_type = 'error' then 'true' else 'false' end as surface_ice,
  case when event_type = 'signup' then 'true' else 'false' end as surface_snow,
  case when event_id % 7 = 0 then null else round(0.3e0 + (event_id * 37 % 70) / 100e0, 6) end
    as surface_grip,
  round(value / 10 - 1, 6) as air_temp_c, 40e0 + event_id % 60 as air_rh,
  round(value / 10 - 4, 6) as dewpoint_c
"""


@query(
    "weather_extract",
    f"""
select cast({_POINT} as bigint) as measurepoint_id, 'P' || user_id as measurepoint_name,
  'POINT (18.05 59.357)' as wgs84, ts - interval '1' hour as sample_time, {_WEATHER_VALUES},
  ts as ingested_at, cast(event_id as varchar) as payload_id, cast(0 as bigint) as _seq
from events where event_id % 13 <> 0
union all
select null, null, null, null, null, null, null, null, null, null, null, null,
  ts, cast(event_id as varchar), 1
from events
""",
)
def weather_extract(spark, sf_dir):
    return comparable(extract.weather_observations(_landed(spark, sf_dir, WEATHER_BODY)))


@query(
    "fractional_ids",
    """
select '243.5' as measurepoint_id, cast(event_id as varchar) as payload_id, ts as ingested_at,
  cast(0 as bigint) as _seq
from events where event_id % 13 = 0
""",
)
def fractional_ids(spark, sf_dir):
    """Rows that extraction holds back for the quarantine table."""
    return comparable(extract.fractional_ids(_landed(spark, sf_dir, WEATHER_BODY)))


_SITUATIONS = """
select 'S' || user_id as situation_id, ts as publication_time, ts as version_time,
  event_type as message_type, event_type || i as message_type_value,
  cast(null as varchar) as message_code, cast(null as varchar) as message_code_value,
  cast(i as varchar) as severity_code, ts - interval '2' hour as start_time,
  cast(null as timestamp) as end_time, event_id % 2 = 0 as suspended,
  'POINT (' || i || ' 59)' as wgs84, ts as ingested_at,
  cast(event_id as varchar) as payload_id, cast(i as bigint) as _seq
from (select *, unnest(range(0, event_id % 3 + 1)) as i from events where event_id % 7 <> 0)
"""


@query("situation_extract", _SITUATIONS)
def situation_extract(spark, sf_dir):
    return comparable(extract.situations(_landed(spark, sf_dir, SITUATION_BODY)))


@query(
    "situation_last_deviation",
    f"""
select * from ({_SITUATIONS})
qualify row_number() over (partition by situation_id, version_time
  order by ingested_at desc, payload_id desc, _seq desc) = 1
""",
)
def situation_last_deviation(spark, sf_dir):
    """What the key leaves of a situation with several deviations: the last."""
    rows = extract.situations(_landed(spark, sf_dir, SITUATION_BODY))
    return comparable(keep_last(rows, schemas.SITUATION.primary_key))


@query(
    "frost_extract",
    f"""
select cast({_POINT} as bigint) as measurepoint_id, 'P' || user_id as measurepoint_name,
  cast(null as varchar) as wgs84, ts as sample_time, 's' || i as sensor_name,
  case when i < 2 then 10e0 else 20e0 end as depth_cm, round(value / 100 + i, 6) as temp_c,
  ts as ingested_at, cast(event_id as varchar) as payload_id, cast(i as bigint) as _seq
from (select *, unnest(range(0, event_id % 4)) as i from events)
""",
)
def frost_extract(spark, sf_dir):
    return comparable(extract.frost_depths(_landed(spark, sf_dir, FROST_BODY)))


_FORECAST_RUN = """
case event_id % 4 when 1 then ts when 2 then ts else ts + interval '1' hour end
"""
_FORECASTS = f"""
select cast(l.tv_id as bigint) as measurepoint_id, l.lat, l.lon,
  {_FORECAST_RUN} as forecast_run_time,
  date_trunc('hour', ts) + interval '1' hour * h as valid_time,
  round(value / 10 - 3 + h, 6) as t_air_c, cast(null as double) as precip_mm,
  cast(null as double) as wind_ms, 40e0 + event_id % 60 as rh, ts as ingested_at,
  cast(event_id as varchar) as payload_id, cast(case when h = 24 then 0 else 1 end as bigint) as _seq
from (select *, unnest([24, 48]) as h, {{alias}} as alias from events {{where}}) e
join locations l on l.id = e.alias
"""
_SOME_ELSEWHERE = f"case when event_id % 11 = 0 then 'MP999' else {_ALIAS} end"


@query(
    "point_forecast_extract",
    "with" + LOCATIONS_CTE.lstrip(",") + _FORECASTS.format(alias=_SOME_ELSEWHERE, where=""),
)
def point_forecast_extract(spark, sf_dir):
    landed = _landed(spark, sf_dir, FORECAST_BODY, f"{_SOME_ELSEWHERE} as location_id")
    return comparable(extract.point_forecasts(landed, default_locations(spark)))


@query(
    "props_json_extract",
    "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events",
)
def props_json_extract(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    parsed = F.from_json("props", "k STRING")["k"]
    return events.select("event_id", parsed.try_cast("bigint").alias("k"))


# --- Landing, locations ----------------------------------------------------------------

_BODIES = """
case event_id % 6 when 0 then '' when 1 then '   ' when 2 then '<html>busy</html>'
  when 3 then '{"k": ' when 4 then null else props end
"""


@query(
    "landing_quarantine",
    f"""
with landed as (
  select 'e' || event_id as payload_id, {_BODIES} as body,
    case when event_id % 7 = 0 then 503 else 200 end as status,
    case when event_id % 11 = 0 then 'text/html' else 'Application/JSON; charset=utf-8' end
      as content_type
  from events
  union all select 'p' || page_id, html, 200, 'application/json' from pages),
judged as (
  select *, case when status >= 400 then 'error status'
    when not contains(lower(content_type), 'json') then 'content type is not JSON'
    when trim(coalesce(body, '')) = '' then 'empty body'
    when not json_valid(body) then 'not JSON' end as reject_reason
  from landed)
select payload_id, status, content_type, reject_reason,
  body
from judged where reject_reason is not null
""",
)
def landing_quarantine(spark, sf_dir):
    """Event bodies of every kind, and whole web pages that claim to be JSON."""
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), "event_id").alias("payload_id"),
        F.expr(_BODIES).alias("body"),
        F.when(F.col("event_id") % 7 == 0, 503).otherwise(200).alias("status"),
        F.when(F.col("event_id") % 11 == 0, "text/html")
        .otherwise("Application/JSON; charset=utf-8")
        .alias("content_type"),
    )
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), "page_id").alias("payload_id"),
        F.col("html").alias("body"),
        F.lit(200).alias("status"),
        F.lit("application/json").alias("content_type"),
    )
    return quarantined(events.unionByName(pages))


# Payloads with good and bad parts side by side. What each event's is made of follows
# from its number.
_MIXED_ITEM = f"""
to_json(named_struct('Measurepoint', named_struct('Id', cast({_POINT} as string)),
  'Sample', concat({_ISO}, 'Z'), 'Air', named_struct('Temperature', named_struct('Value', value))))
"""
MIXED_BODY = f"""
case event_id % 8
  when 0 then concat('{{"RESPONSE":{{"RESULT":[{{"WeatherObservation":[', {_MIXED_ITEM}, ',"bad"]}}]}}}}')
  when 1 then concat('{{"RESPONSE":{{"RESULT":[7,{{"WeatherObservation":[null,', {_MIXED_ITEM}, ']}}]}}}}')
  when 2 then '{{"RESPONSE":"oops"}}'
  when 3 then concat('{{"RESPONSE":{{"RESULT":{{"WeatherObservation":[', {_MIXED_ITEM}, ']}}}}}}')
  when 4 then concat('{{"RESPONSE":{{"RESULT":[{{"WeatherObservation":', {_MIXED_ITEM}, '}}]}}}}')
  when 5 then '{{"RESPONSE":{{"RESULT":[{{"WeatherObservation":null}},{{}}]}}}}'
  when 6 then concat('{{"RESPONSE":null}}', case when event_id % 16 < 8 then '] trailing junk' else '],[{{"b":2}}' end)
  else concat('{{"RESPONSE":{{"RESULT":[{{"WeatherObservation":[[], ', {_MIXED_ITEM}, ', ', {_MIXED_ITEM}, ']}}]}}}}')
end
"""


@query(
    "payload_shape_errors",
    f"""
with faults as (
  select event_id, '{{"Measurepoint":{{"Id":"' || {_POINT} || '"}},"Sample":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
    || 'Z","Air":{{"Temperature":{{"Value":0}}}}}}' as item, unnest(case event_id % 8
    when 0 then ['an item of WeatherObservation is not an object']
    when 1 then ['an item of RESULT is not an object', 'an item of WeatherObservation is not an object']
    when 2 then ['RESPONSE is not an object'] when 3 then ['RESULT is not an array']
    when 4 then ['WeatherObservation is not an array'] when 6 then ['not JSON']
    when 7 then ['an item of WeatherObservation is not an object'] else [] end) as reject_reason
  from events)
select cast(event_id as varchar) as payload_id, reject_reason,
  case when reject_reason = 'not JSON' then case when event_id % 16 < 8
           then '{{"RESPONSE":null}}] trailing junk' else '{{"RESPONSE":null}}],[{{"b":2}}' end
       when event_id % 8 = 3 then '{{"WeatherObservation":[' || item || ']}}' when event_id % 8 = 4 then item
       when event_id % 8 = 0 then 'bad' when event_id % 8 = 2 then 'oops'
       when event_id % 8 = 7 then '[]' when reject_reason like '%RESULT is not an object' then '7'
       when event_id % 8 = 1 then 'null' end as body
from faults
""",
)
def payload_shape_errors(spark, sf_dir):
    """What the quarantine gets of payloads that are partly of the wrong shape, whole. The
    two engines write the one number in it differently, so it is shown as 0."""
    found = quarantined(_landed(spark, sf_dir, MIXED_BODY), schemas.WEATHER_SHAPE)
    body = F.regexp_replace("body", '"Value":[-0-9.E]+', '"Value":0')
    return found.select("payload_id", "reject_reason", body.alias("body"))


@query(
    "weather_of_mixed_payloads",
    f"""
select cast({_POINT} as bigint) as measurepoint_id, ts as sample_time, round(value, 6) as air_temp_c,
  cast(event_id as varchar) as payload_id, cast(place as bigint) as _seq
from (select *, unnest(case event_id % 8 when 0 then [0] when 1 then [2147483649] when 7 then [1, 2]
                       else [] end) as place from events)
""",
)
def weather_of_mixed_payloads(spark, sf_dir):
    """The good items of the same payloads."""
    rows = extract.weather_observations(_landed(spark, sf_dir, MIXED_BODY))
    return comparable(rows.select("measurepoint_id", "sample_time", "air_temp_c", "payload_id", "_seq"))


_ENTRIES = """
to_json(map(concat('L', s_suppkey), named_struct(
  'id', concat('L', s_suppkey), 'name', case when s_suppkey % 3 = 0 then null else s_name end,
  'latitude', 59 + s_acctbal / 10000, 'longitude', 18 - s_acctbal / 10000,
  'municipality', concat('N', s_nationkey),
  'tv_measurepoint_id', case s_suppkey % 5 when 0 then null when 1 then 'none'
                        when 2 then concat(s_suppkey, '.5') else cast(s_suppkey as string) end)))
"""


@query(
    "location_load",
    """
select 'L' || s_suppkey as id,
  case when s_suppkey % 3 = 0 then cast(s_suppkey as varchar) else s_name end as name,
  cast(null as varchar) as road, round(59 + s_acctbal / 10000, 6) as latitude,
  round(18 - s_acctbal / 10000, 6) as longitude, 'N' || s_nationkey as municipality,
  s_suppkey as tv_measurepoint_id
from supplier where s_suppkey % 5 not in (0, 1)
""",
)
def location_load(spark, sf_dir):
    """One location object per supplier; some have no usable identifier or no name."""
    text = table(spark, sf_dir, "supplier").select(F.expr(_ENTRIES).alias("value"))
    return comparable(locations(text))


_NATION_PLACES = """
to_json(map(concat('MP', n_nationkey), named_struct(
  'id', concat('MP', n_nationkey), 'name', n_name, 'latitude', 59e0, 'longitude', 18e0,
  'tv_measurepoint_id', case when n_nationkey % 5 = 0 then null else n_nationkey end)))
"""


def _places_and_payloads(spark, sf_dir):
    text = table(spark, sf_dir, "nation").select(F.expr(_NATION_PLACES).alias("value"))
    body = f"case when event_id % 6 = 0 then '<html>' else {FORECAST_BODY} end"
    alias = "concat('MP', case when user_id % 30 = 7 then 99 else user_id % 30 end) as location_id"
    return _landed(spark, sf_dir, body, alias), all_entries(text)


_NATION_ALIAS = "'MP' || (case when user_id % 30 = 7 then 99 else user_id % 30 end)"


@query(
    "location_forecasts",
    "with locations as (select 'MP' || n_nationkey as id, n_nationkey as tv_id, 59e0 as lat,"
    " 18e0 as lon from nation where n_nationkey % 5 <> 0)"
    + _FORECASTS.format(alias=_NATION_ALIAS, where="where event_id % 6 <> 0"),
)
def location_forecast_rows(spark, sf_dir):
    """All places at once: unusable bodies and places without identifier yield nothing."""
    return comparable(location_forecasts(*_places_and_payloads(spark, sf_dir)))


@query(
    "location_forecast_errors",
    f"""
with places as (select 'MP' || n_nationkey as id, n_nationkey % 5 <> 0 as numbered from nation),
landed as (select event_id % 6 = 0 as bad, {_NATION_ALIAS} as location_id from events)
select location_id, 'not JSON' as error from landed
  join places on id = location_id where bad and numbered
union all select id, 'no measurement point identifier' from places where not numbered
union all select id, 'no payload' from places
  where numbered and id not in (select location_id from landed)
union all select distinct location_id, 'unknown location' from landed
  where location_id not in (select id from places)
""",
)
def location_forecast_errors(spark, sf_dir):
    return location_errors(*_places_and_payloads(spark, sf_dir))


# --- Keyed tables ------------------------------------------------------------------------

_STORED = """,
stored as (
  select * from pred qualify row_number() over (
    partition by measurepoint_id, forecast_run_time, valid_time, horizon_hours
    order by {newest}) = 1)
"""


@query(
    "upsert_latest_wins",
    ctes("pred")
    + _STORED.format(newest="risk_mean >= 0.5 desc, ingest_seq desc")
    + f"select {PRED_COLUMNS} from stored",
)
def upsert_latest_wins(spark, sf_dir):
    """The rows of lower risk are stored first, then the others arrive."""
    df = predictions(spark, sf_dir)
    keys = schemas.PREDICTION.primary_key
    first = keep_last(df.where(F.col("risk_mean") < 0.5), keys)
    second = keep_last(df.where(F.col("risk_mean") >= 0.5), keys)
    return comparable(merged(first, second, keys))


def _fresh(spec: schemas.TableSpec) -> schemas.TableSpec:
    return replace(spec, name=f"{spec.name}_{uuid.uuid4().hex}")


@query(
    "table_upserts",
    ctes("pred")
    + _STORED.format(newest="risk_mean >= 0.5 desc, ingest_seq desc")
    + """
select cast(measurepoint_id as bigint) as measurepoint_id, valid_time,
  cast(horizon_hours as bigint) as horizon_hours, round(risk_mean, 6) as risk_mean,
  round(risk_p10, 6) as risk_p10, round(risk_p90, 6) as risk_p90,
  cast(risk_mean >= 0.5 as int) as hazard_predicted,
  case when risk_mean >= 0.7 or coalesce(risk_p90, risk_mean) >= 0.85
         then 'HIGH: Salting recommended within 2 hours'
       when risk_mean >= 0.4 or coalesce(risk_p90, risk_mean) >= 0.6
         then 'MODERATE: Standby for salting, prepare equipment'
       else 'LOW: Normal operations, continue monitoring' end as recommendation,
  forecast_run_time
from stored
""",
)
def table_upserts(spark, sf_dir):
    """Two writes to a stored table, the second one repeated, then a read."""
    spec = _fresh(schemas.PREDICTION)
    ensure_table(spark, spec, location=scratch_path(spark, spec.table))
    df = with_decision(predictions(spark, sf_dir))
    upsert(spark, spec, df.where(F.col("risk_mean") < 0.5))
    for _ in range(2):
        upsert(spark, spec, df.where(F.col("risk_mean") >= 0.5))
    return comparable(read_and_forget(spark, spec))


# A reading is landed twice: by the event itself, and by one that came a day later but
# was ingested a day earlier for every third event.
_LATE = """
select {point} as measurepoint_id, 'P' as measurepoint_name, cast(null as {text}) as wgs84,
  {ts} as sample_time, cast(event_id as {text}) as sensor_name, cast(event_id % 4 as double) as depth_cm,
  value + {shift} as temp_c, {ts} + interval '1' day * {days} as ingested_at
from events
"""


@query(
    "late_payload_upsert",
    "with first as ("
    + _LATE.format(point=f"cast({_POINT} as bigint)", text="varchar", ts="ts", shift=0, days=1)
    + "), second as ("
    + _LATE.format(
        point=f"cast({_POINT} as bigint)", text="varchar", ts="ts", shift=100,
        days="(case when event_id % 3 = 0 then 0 when event_id % 3 = 1 then 1 else 2 end)",
    )
    + """),
written as (select *, 1 as step from first union all select *, 2 from second),
last as (select * from written qualify row_number() over (
  partition by step, measurepoint_id, sample_time, depth_cm order by ingested_at desc, sensor_name desc) = 1)
select * exclude (step) replace (round(temp_c, 6) as temp_c) from last qualify row_number() over (
  partition by measurepoint_id, sample_time, depth_cm order by ingested_at desc, step desc) = 1
""",
)
def late_payload_upsert(spark, sf_dir):
    """Two writes: of each key the row ingested last stays, and of two ingested at the
    same time the one written last."""
    spec = _fresh(schemas.FROST_DEPTH)
    ensure_table(spark, spec, location=scratch_path(spark, spec.table))

    def readings(shift, days):
        sql = _LATE.format(
            point=f"cast({_POINT} as bigint)", text="string", ts="cast(ts as timestamp)",
            shift=shift, days=days,
        )
        return spark.sql(sql.replace("from events", "from {events}"), events=table(spark, sf_dir, "events"))

    order = ("ingested_at", "sensor_name")
    upsert(spark, spec, readings(0, 1), order=order)
    late = "(case when event_id % 3 = 0 then 0 when event_id % 3 = 1 then 1 else 2 end)"
    upsert(spark, spec, readings(100, late), order=order)
    return comparable(read_and_forget(spark, spec))


@query(
    "table_time_travel",
    ctes("pred")
    + """
select 1 as version, cast(measurepoint_id as bigint) as measurepoint_id, forecast_run_time, valid_time,
  cast(horizon_hours as bigint) as horizon_hours, round(risk_mean, 6) as risk_mean
from pred where risk_mean < 0.5 qualify row_number() over (
  partition by measurepoint_id, forecast_run_time, valid_time, horizon_hours order by ingest_seq desc) = 1
union all
select 2, measurepoint_id, forecast_run_time, valid_time, horizon_hours, round(risk_mean, 6)
from pred qualify row_number() over (
  partition by measurepoint_id, forecast_run_time, valid_time, horizon_hours
  order by risk_mean >= 0.5 desc, ingest_seq desc) = 1
""",
)
def table_time_travel(spark, sf_dir):
    """Two writes to a stored table and both of its versions, read after the second."""
    spec = _fresh(schemas.PREDICTION)
    ensure_table(spark, spec, location=scratch_path(spark, spec.table))
    df = with_decision(predictions(spark, sf_dir))
    early = F.col("risk_mean") < 0.5
    for rows in (df.where(early), df.where(~early)):
        upsert(spark, spec, rows)
    both = [read_table(spark, spec, version=n).withColumn("version", F.lit(n)) for n in table_versions(spark, spec)]
    spark.sql(f"DROP TABLE {spec.table}")
    columns = ("version", "measurepoint_id", "forecast_run_time", "valid_time", "horizon_hours", "risk_mean")
    return comparable(both[0].unionByName(both[1]).select(*columns))


@query(
    "zone_join_audit",
    ctes("pred")
    + _STORED.format(newest="ingest_seq desc")
    + """,
run_side as (select count(*) as n, count(*) - count(forecast_run_time) as missing, min(forecast_run_time) as a,
  max(forecast_run_time) as b from stored),
time_side as (select count(*) as n, min(valid_time) as a, max(valid_time) as b from stored)
select 'forecast' as side, n as rows, missing as null_times, cast(0 as bigint) as duplicates, a as min_time,
  b as max_time from run_side
union all select 'observation', n, 0, 0, a, b from time_side
""",
)
def zone_join_audit(spark, sf_dir):
    """The audit of a join of stored tables, told by their manifests; one table stands
    for both sides."""
    spec = _fresh(schemas.PREDICTION)
    ensure_table(spark, spec, location=scratch_path(spark, spec.table))
    df = with_decision(predictions(spark, sf_dir))
    for rows in (df.where("ingest_seq % 2 = 0"), df.where("ingest_seq % 2 = 1"), df):
        upsert(spark, spec, rows)
    zones = table_zones(spark, spec)
    spark.sql(f"DROP TABLE {spec.table}")
    return comparable(zones_join_audit(zones, zones))


@query(
    "table_zones",
    ctes("pred")
    + _STORED.format(newest="risk_mean >= 0.5 desc, ingest_seq desc")
    + """
select cast(valid_time as date) as event_date, count(*) as rows, min(valid_time) as first_valid,
  max(valid_time) as last_valid, min(forecast_run_time) as first_run, max(forecast_run_time) as last_run
from stored group by all
""",
)
def table_zone_rows(spark, sf_dir):
    """What a table's manifest tells of its dates after two writes, one of which replaced
    rows, without a row being read."""
    spec = _fresh(schemas.PREDICTION)
    ensure_table(spark, spec, location=scratch_path(spark, spec.table))
    df = with_decision(predictions(spark, sf_dir))
    upsert(spark, spec, df.where(F.col("risk_mean") < 0.5))
    upsert(spark, spec, df.where(F.col("risk_mean") >= 0.5))
    zones = table_zones(spark, spec)
    spark.sql(f"DROP TABLE {spec.table}")
    return comparable(zones.select(
        "event_date", "rows", F.col("first").alias("first_valid"), F.col("last").alias("last_valid"), "first_run", "last_run"
    ))


@query(
    "table_schema_align",
    ctes("pred")
    + _STORED.format(newest="ingest_seq desc")
    + """
select column_name, stored from (
  select unnest(['measurepoint_id', 'valid_time', 'horizon_hours', 'risk_mean', 'risk_p10', 'risk_p90',
                 'hazard_predicted', 'recommendation', 'forecast_run_time']) as column_name, true as stored
  union all select unnest(['extra', 'ingest_seq']), false)
cross join (select count(*) as n from stored) where n > 0
""",
)
def table_schema_align(spark, sf_dir):
    """A frame with unknown columns cut to those of a stored table, as the table lists
    them, and written to it; the columns are then read off the table."""
    spec = _fresh(schemas.PREDICTION)
    ensure_table(spark, spec, location=scratch_path(spark, spec.table))
    df = with_decision(predictions(spark, sf_dir)).withColumn("extra", F.lit("x"))
    kept, dropped = align_to_table(spark, df, spec)
    upsert(spark, spec, keep_last(df, spec.primary_key).select(*kept.columns), order=())
    rows = [(c, True) for c in table_columns(spark, spec)] + [(c, False) for c in dropped]
    names = spark.createDataFrame(rows, "column_name STRING, stored BOOLEAN")
    any_row = read_and_forget(spark, spec).agg(F.count("*").alias("n")).where("n > 0")
    return names.crossJoin(any_row).drop("n")


@query("csv_sink", ctes("pred") + f"select {PRED_COLUMNS} from pred")
def csv_sink(spark, sf_dir):
    """Written as CSV with a header and read back."""
    df = predictions(spark, sf_dir)
    path = scratch_path(spark, "predictions-csv")
    write_csv(df, path)
    return comparable(spark.read.option("header", True).schema(df.schema).csv(path))


# --- Jobs ----------------------------------------------------------------------------------


def _write_lines(df: DataFrame, label: str, *partitions: str, packed: bool = False) -> str:
    """Land the bodies as text, one payload per line. ``packed`` lands compressed files,
    which a read cannot split, so none gets many payloads."""
    path = scratch_path(df.sparkSession, label)
    writer = df.select("body", *partitions).write.partitionBy(*partitions)
    if packed:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", PACKED_PAYLOADS)
    writer.text(path)
    return path


# Payloads of a compressed file, some 100 MB of text.
PACKED_PAYLOADS = 200_000

# The files' own time, which stands in for an unreadable run time, is not known beforehand.
LANDED_AT = "2000-01-01 00:00:00"


def _forecast_lines(spark, sf_dir):
    landed = _landed(spark, sf_dir, FORECAST_BODY, f"{_ALIAS} as location_id")
    path = _write_lines(landed, "forecast", "location_id", packed=True)
    lines = read_landing(spark, path, json_lines=True)
    return lines.withColumn("ingested_at", F.lit(LANDED_AT).cast("timestamp"))


def _usual_feeds(spark, sf_dir, suffix):
    def lines(label, body):
        path = _write_lines(_landed(spark, sf_dir, body), label, packed=True)
        return read_landing(spark, path, json_lines=True)

    return landing_feeds(
        weather=lines("weather", WEATHER_BODY),
        situations=lines("situation", f"case when event_id % 50 = 1 then '<html>' else {SITUATION_BODY} end"),
        frost=lines("frost", FROST_BODY),
        forecasts=_forecast_lines(spark, sf_dir),
        locations=default_locations(spark),
        suffix=suffix,
    )


_STORED_FORECASTS = f"""
select distinct {_POINT} as mp,
  case event_id % 4 when 1 then ts when 2 then timestamp '{LANDED_AT}' else ts + interval '1' hour end as run,
  date_trunc('hour', ts) + interval '1' hour * h as valid_time
from (select *, unnest([24, 48]) as h from events)
"""


def _refreshed_and_forgotten(spark, feeds):
    """The report; the tables go from the catalog."""
    report = refresh(spark, feeds, location=scratch_path(spark, "refresh"))
    for feed in feeds:
        spark.sql(f"DROP TABLE IF EXISTS {feed.spec.table}")
    return report


@query(
    "refresh_report",
    f"""
with weather as (select distinct mp, t from (
  select {_POINT} as mp, ts - interval '1' hour as t from events where event_id % 13 <> 0
  union all select null, null from events)),
situations as (
  select distinct user_id, ts from events where event_id % 7 <> 0 and event_id % 50 <> 1),
frost as (select distinct {_POINT} as mp, ts, i // 2 as depth
  from (select *, unnest(range(0, event_id % 4)) as i from events)),
forecast as ({_STORED_FORECASTS})
select 'weather' as source, count(*) as rows, cast(null as varchar) as error from weather
union all select 'situations', count(*), null from situations
union all select 'frost_depth', count(*), null from frost
union all select 'forecast', count(*), null from forecast
union all select 'situations', null, 'not JSON' from events where event_id % 50 = 1
""",
)
def refresh_report(spark, sf_dir):
    """All four feeds from landed text to keyed tables; one has unusable payloads."""
    return _refreshed_and_forgotten(spark, _usual_feeds(spark, sf_dir, f"_{uuid.uuid4().hex}"))


# Payloads land in two waves. The second has the rest of the events, and once more, with
# other values, those of every third, which so replace the stored ones.
_FIRST, _SECOND = "event_id % 3 <> 0", "event_id % 3 <> 1"
_WAVE_BODY = f"case when event_id % 50 = 1 then '<html>' else {WEATHER_BODY} end"


def _two_waves(spark, sf_dir):
    """Runs over both waves, and one with nothing new: reports and ledgers by run, and the
    table."""
    root, suffix = scratch_path(spark, "waves"), f"_{uuid.uuid4().hex}"
    spec = replace(schemas.WEATHER_OBSERVATION, name=schemas.WEATHER_OBSERVATION.name + suffix)
    reports = []
    for wave, body in ((_FIRST, _WAVE_BODY), (_SECOND, _WAVE_BODY.replace("value", "(value + 100)")), (None, None)):
        if wave:
            landed = _landed(spark, sf_dir, body).where(wave.replace("event_id", "cast(payload_id as bigint)"))
            landed.select("body").write.mode("append").text(f"{root}/landing/weather")
        reports.append(jobs.daily(spark, f"{root}/landing", json_lines=True, tables=f"{root}/tables", suffix=suffix))
    return reports, read_ledger(spark, f"{root}/tables/_ingest_ledger"), read_and_forget(spark, spec)


@query(
    "refresh_incremental",
    f"""
with waves as (
  select 1 as run, * from events where {_FIRST} union all select 2, * from events where {_SECOND}),
stored as (select distinct run, mp, t from (
  select run, {_POINT} as mp, ts - interval '1' hour as t from waves where event_id % 13 <> 0 and event_id % 50 <> 1
  union all select run, null, null from waves where event_id % 50 <> 1)),
taken as (select run, count(*) as payloads, count(*) filter (event_id % 50 = 1) as rejected from waves group by run)
select run, count(*) as rows, any_value(payloads) as payloads, any_value(rejected) as rejected,
  any_value(rejected) as errors
from stored join taken using (run) group by run
union all select 3, 0, 0, 0, 0
""",
)
def refresh_incremental(spark, sf_dir):
    """What daily runs over a growing landing store, read and reject: each reads what the
    ones before did not."""
    reports, ledger, _ = _two_waves(spark, sf_dir)
    runs = ledger.groupBy("run").agg(
        F.min("modified").alias("at"), F.sum("payloads").alias("payloads"), F.sum("rejected").alias("rejected")
    )
    nth = F.row_number().over(Window.orderBy("at"))  # a row per run
    taken = runs.select(nth.alias("run"), "payloads", "rejected")
    told = None
    for n, report in enumerate(reports, 1):
        own = report.agg(F.sum("rows").alias("rows"), F.count("error").alias("errors")).withColumn("run", F.lit(n))
        told = own if told is None else told.unionByName(own)
    return told.join(taken, "run", "left").select(
        "run", "rows", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("payloads", "rejected")], "errors"
    )


@query(
    "incremental_weather_table",
    f"""
with waves as (
  select 1 as run, * from events where {_FIRST}
  union all select 2, * replace (value + 100 as value) from events where {_SECOND}),
last as (select * from waves where event_id % 13 <> 0 and event_id % 50 <> 1
  qualify rank() over (partition by {_POINT}, ts order by run desc) = 1)
select cast({_POINT} as bigint) as measurepoint_id, ts - interval '1' hour as sample_time,
  count(distinct value) as spellings, round(min(value) / 10 - 2, 6) as least_surface_temp_c,
  round(max(value) / 10 - 2, 6) as greatest_surface_temp_c
from last group by all
union all select null, null, 0, null, null
""",
)
def incremental_weather_table(spark, sf_dir):
    """The table after both waves: the values of the second replace those of the first.
    Where one wave has a key several times the files' order decides, which is not known
    beforehand; the stored value is then compared with the bounds of that wave's values."""
    _, _, stored = _two_waves(spark, sf_dir)
    events = table(spark, sf_dir, "events").where("event_id % 13 <> 0 and event_id % 50 <> 1")
    waves = events.where(_SECOND).select("*", F.lit(2).alias("run")).withColumn("value", F.expr("value + 100"))
    waves = waves.unionByName(events.where(_FIRST).withColumn("run", F.lit(1)))
    landed = waves.select(
        F.expr(f"cast({_POINT} as bigint)").alias("measurepoint_id"),
        F.expr("cast(ts as timestamp) - interval '1' hour").alias("sample_time"), "run", "value",
    )
    key = Window.partitionBy("measurepoint_id", "sample_time")
    last = landed.withColumn("newest", F.max("run").over(key)).where("run = newest")
    bounds = last.groupBy("measurepoint_id", "sample_time").agg(
        F.count_distinct("value").alias("spellings"),
        F.expr("round(min(value) / 10 - 2, 6)").alias("least_surface_temp_c"),
        F.expr("round(max(value) / 10 - 2, 6)").alias("greatest_surface_temp_c"),
    )
    found = stored.select("measurepoint_id", "sample_time", F.round("surface_temp_c", 6).alias("t"))
    joined = found.join(bounds, ["measurepoint_id", "sample_time"], "left")
    fits = F.col("t").between(F.col("least_surface_temp_c"), F.col("greatest_surface_temp_c"))
    # A stored value that is none of its wave's shows as such.
    return comparable(
        joined.select(
            "measurepoint_id", "sample_time",
            F.when(F.coalesce(fits, F.col("t").isNull()), F.coalesce("spellings", F.lit(0))).otherwise(-1).cast("long").alias("spellings"),
            "least_surface_temp_c", "greatest_surface_temp_c",
        )
    )


@query(
    "refresh_total",
    f"select cast(count(*) as bigint) as total_rows from ({_STORED_FORECASTS})",
)
def refresh_total(spark, sf_dir):
    """The forecast feed alone."""
    feeds = landing_feeds(
        forecasts=_forecast_lines(spark, sf_dir),
        locations=default_locations(spark),
        suffix=f"_{uuid.uuid4().hex}",
    )
    return total_rows(_refreshed_and_forgotten(spark, feeds))


@query(
    "stream_weather_table",
    f"""
select cast({_POINT} as bigint) as measurepoint_id, 'P' || user_id as measurepoint_name,
  'POINT (18.05 59.357)' as wgs84, ts - interval '1' hour as sample_time,
  round(value / 10 - 2, 6) as surface_temp_c, event_id % 5 = 0 as surface_water,
  event_type = 'error' as surface_ice, event_type = 'signup' as surface_snow,
  case when event_id % 7 = 0 then null else round(0.3e0 + (event_id * 37 % 70) / 100e0, 6) end
    as surface_grip,
  round(value / 10 - 1, 6) as air_temp_c, 40e0 + event_id % 60 as air_rh,
  round(value / 10 - 4, 6) as dewpoint_c
from events where event_id % 13 <> 0
union all
select null, null, null, null, null, null, null, null, null, null, null, null
""",
)
def stream_weather_table(spark, sf_dir):
    """Landed text streamed into a keyed table in several batches. The rows that have
    neither identifier nor time share one key."""
    path = _write_lines(_landed(spark, sf_dir, WEATHER_BODY), "stream-weather")
    spec = _fresh(schemas.WEATHER_OBSERVATION)
    place = scratch_path(spark, spec.table)
    landed = stream_landing(spark, path, max_files=4, json_lines=True)
    progress = scratch_path(spark, "stream-progress")
    stream_to_table(
        landed, spec, extract.weather_observations, progress, json_lines=True, location=place
    ).awaitTermination()
    return comparable(read_and_forget(spark, spec).drop("ingested_at"))
