"""The measurement-point dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadcast import schemas
from roadcast.functions.clean import truncated_id
from roadcast.session import path_exists

# --- Fixed values: the points used when no location file can be read --------
DEFAULT_LOCATIONS = (
    ("MP001", "E4 Norrtull", "E4", 59.357, 18.05, "Stockholm", 243),
    ("MP002", "E4 Häggvik", "E4", 59.433, 17.933, "Sollentuna", 226),
    ("MP003", "E18 Jakobsberg", "E18", 59.422, 17.833, "Järfälla", 232),
    ("MP004", "E20 Essingeleden", "E20", 59.327, 18.0, "Stockholm", 237),
    ("MP005", "Rv73 Nynäsvägen", "Rv73", 59.267, 18.083, "Stockholm", 215),
)
LOCATION_COLUMNS = """
  id STRING, name STRING, road STRING, latitude DOUBLE, longitude DOUBLE,
  municipality STRING, tv_measurepoint_id BIGINT
"""


def default_locations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DEFAULT_LOCATIONS), LOCATION_COLUMNS)


def all_entries(text: DataFrame, column: str = "value") -> DataFrame:
    """Every entry of JSON objects that map an alias to a location."""
    entries = text.select(F.explode(F.from_json(column, schemas.LOCATION_ENTRIES)).alias("k", "v"))
    rows = entries.select("k", "v.*")
    return rows.withColumns(
        {
            "tv_measurepoint_id": truncated_id(rows, "tv_measurepoint_id"),
            "id": F.coalesce("id", "k"),
        }
    ).drop("k")


def locations(text: DataFrame, column: str = "value") -> DataFrame:
    """Entries that have a numeric measurement-point identifier. A missing name is
    replaced by that identifier."""
    kept = all_entries(text, column).where(F.col("tv_measurepoint_id").isNotNull())
    return kept.withColumn("name", F.coalesce("name", F.col("tv_measurepoint_id").cast("string")))


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """Locations of a JSON file, or the built-in points when there is none in it or no
    such file."""
    if not path_exists(spark, path):
        return default_locations(spark)
    found = locations(spark.read.text(path, wholetext=True))
    return default_locations(spark) if found.isEmpty() else found
