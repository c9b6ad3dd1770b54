"""The operators' inputs, derived from the whole of the driver's tables.

Each view is one SELECT that both engines can run; only the spelling of a few
types differs, which ``{ts}`` and the like stand for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadcast.schemas import TableSpec
from roadcast.session import use_utc
from roadcast.sources.tables import read_table

_POINT = """case user_id % 5 when 0 then 243 when 1 then 226 when 2 then 232
            when 3 then 237 else 215 end as measurepoint_id"""

OBS = f"""
select {_POINT},
       {{ts}} as sample_time,
       case when event_id % 11 = 0 then null else value / 10 - 2 end as surface_temp_c,
       event_id % 5 = 0 as surface_water,
       event_type = 'error' as surface_ice,
       (event_type = 'signup' and event_id % 3 = 0) as surface_snow,
       case when event_id % 7 = 0 then null
            else 0.3e0 + (event_id * 37 % 70) / 100e0 end as surface_grip,
       value / 10 - 1 as air_temp_c, 40e0 + event_id % 60 as air_rh,
       value / 10 - 4 as dewpoint_c, event_id as ingest_seq
from events
"""

FC = f"""
select {_POINT},
       {{ts}} as forecast_run_time,
       date_trunc('hour', {{ts}}) + interval '1' hour * h as valid_time,
       value / 10 - 3 as t_air_c, (event_id % 9) / 10e0 as precip_mm,
       (event_id % 13) * 1e0 as wind_ms, 40e0 + event_id % 60 as rh,
       event_id as ingest_seq
from (select *, {{hours}} as h from events) runs
"""

PRED = f"""
select {_POINT},
       date_trunc('day', {{ts}}) as forecast_run_time,
       date_trunc('day', {{ts}}) + interval '1' hour * (24 * (1 + event_id % 3)) as valid_time,
       24 * (1 + event_id % 3) as horizon_hours,
       (event_id * 7919 % 1000) / 1000e0 as risk_mean,
       greatest(0e0, (event_id * 7919 % 1000) / 1000e0 - 0.1e0) as risk_p10,
       case when event_id % 10 = 0 then null
            else least(1e0, (event_id * 7919 % 1000) / 1000e0 + 0.1e0) end as risk_p90,
       event_id as ingest_seq
from events
"""

# Ten calibrated member probabilities per event.
MEMBER = """
select event_id, m as member,
       least(1e0, (event_id * 7919 % 1000) / 1000e0 + m * 0.01e0) as prob
from (select *, {members} as m from events) wide
"""

SCORED = """
select doc_id, quality as y, (doc_id * 37 % 101) / 101e0 as score from labels
"""

VIEWS = {"obs": OBS, "fc": FC, "pred": PRED, "member": MEMBER, "scored": SCORED}

_SPARK = {
    "ts": "cast(ts as timestamp)",
    "hours": "explode(array(12, 24, 48, 72, 96))",
    "members": "explode(sequence(0, 9))",
}
_DUCKDB = {
    "ts": "ts",
    "hours": "unnest([12, 24, 48, 72, 96])",
    "members": "unnest(range(0, 10))",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = "labels" if name == "scored" else "events"
    sql = VIEWS[name].format(**_SPARK).replace(f"from {source}", "from {source}")
    return spark.sql(sql, source=table(spark, sf_dir, source))


def ctes(*names: str) -> str:
    """The views as the WITH clause of a DuckDB statement."""
    return "with " + ",\n".join(f"{n} as ({VIEWS[n].format(**_DUCKDB)})" for n in names)


def read_and_forget(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """The table's rows; the table itself goes from the catalog."""
    rows = read_table(spark, spec)
    spark.sql(f"DROP TABLE {spec.table}")
    return rows
