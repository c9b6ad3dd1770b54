"""Nested payloads to flat rows.

Each extractor takes a landed frame (see ``landing``) and explodes its arrays. It has two
halves: a parser, which reads each body once and adds what is in it and what is wrong with
it, and a flattener of that. A job that needs rows and faults keeps the parsed payloads.
A body
that is not one JSON object yields no rows, nor does an item that is no object; the
quarantine lists both. ``_seq`` keeps a row's place within its
payload; together with ``ingested_at`` and ``payload_id`` it gives "the last one wins" a
total order that survives shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from roadcast import schemas
from roadcast.functions.clean import number_from_text, utc_from_text, whole_from_text
from roadcast.functions.payload import has_gaps, object_in, objects_in, with_document
from roadcast.operators.joins import dimension_join
from roadcast.sources.landing import with_faults

ORDER = ("ingested_at", "payload_id", "_seq")


def _fractional_id(value: Column) -> Column:
    number = number_from_text(value)
    return F.coalesce(number != F.floor(number), F.lit(False))


def _explode(df: DataFrame, array: str, item: str, place: str) -> DataFrame:
    """Explode with position, keeping every other column; no rows for a missing array.

    The outer form, filtered afterwards: for the inner one the optimizer adds a test
    of the array below the projection that parses it, and so parses it again.
    """
    exploded = df.select("*", F.posexplode_outer(array).alias(place, item))
    return exploded.where(F.col(place).isNotNull())


def _items(df: DataFrame, array: str, item: str, place: str) -> DataFrame:
    """Explode an array with position, without the items that are no objects."""
    return _explode(df, array, item, place).where(F.col(item).isNotNull())


def _place(*positions: str) -> Column:
    """Positions of up to three nested arrays as one number that sorts the same way,
    whatever the arrays' sizes: 31 bits each, as no array has more items."""
    place = F.lit(0).cast("decimal(38,0)")
    for name in positions:
        place = (place * (1 << 31) + F.col(name)).cast("decimal(38,0)")
    return place.alias("_seq")


def _results(
    landed: DataFrame, field: str, item: str, parse: Callable[[Column], Column], shape: tuple
) -> DataFrame:
    """Parsed payloads: ``_results``, structs with their ``field``, an array of ``item``
    structs, and ``_faults``. ``parse`` makes such a struct of the text of an object with
    something of another shape."""

    def careful(result: Column) -> Column:
        texts = F.from_json(result, f"{field} ARRAY<STRING>")[field]
        return F.struct(objects_in(texts, parse).alias(field))

    documents = with_document(
        landed,
        f"RESPONSE: STRUCT<RESULT: ARRAY<STRUCT<{field}: ARRAY<{schemas.struct(item)}>>>>",
        F.col("_doc.RESPONSE.RESULT"),
        objects_in(object_in("body", schemas.RESPONSE)["RESPONSE"]["RESULT"], careful),
        "_results",
        fine="_fine",
    )
    gaps = F.coalesce(
        F.exists("_results", lambda r: r.isNull() | has_gaps(r, shape[2:])), F.lit(False)
    )
    return with_faults(documents, shape, gaps).drop("body", "_fine")


def _result_items(parsed: DataFrame) -> DataFrame:
    """One row per result of parsed payloads."""
    return _items(parsed.drop("_faults", "_answered"), "_results", "_result", "_r").drop("_results")


def parsed_weather(landed: DataFrame) -> DataFrame:
    item = schemas.WEATHER_ITEM
    return _results(
        landed, "WeatherObservation", item, lambda t: F.from_json(t, schemas.struct(item)),
        schemas.WEATHER_SHAPE,
    )


def parsed_situations(landed: DataFrame) -> DataFrame:
    deviation = schemas.struct(schemas.DEVIATION)

    def parse(text: Column) -> Column:
        found = F.from_json(text, schemas.struct(schemas.situation_item("STRING")))
        parts = objects_in(found["Deviation"], lambda t: F.from_json(t, deviation))
        head = [found[c].alias(c) for c in ("Id", "PublicationTime", "VersionTime")]
        return F.struct(*head, parts.alias("Deviation"))

    item = schemas.situation_item(deviation)
    return _results(landed, "Situation", item, parse, schemas.SITUATION_SHAPE)


def parsed_frost(landed: DataFrame) -> DataFrame:
    reading = schemas.struct(schemas.READING)

    def parse(text: Column) -> Column:
        found = F.from_json(text, schemas.struct(schemas.frost_item("STRING")))
        parts = objects_in(found["FrostDepth"]["Temperature"], lambda t: F.from_json(t, reading))
        depth = F.struct(found["FrostDepth"]["Sample"].alias("Sample"), parts.alias("Temperature"))
        return F.struct(found["Measurepoint"].alias("Measurepoint"), depth.alias("FrostDepth"))

    item = schemas.frost_item(reading)
    return _results(landed, "FrostDepthObservation", item, parse, schemas.FROST_SHAPE)


def _weather_items(parsed: DataFrame) -> DataFrame:
    return _items(_result_items(parsed), "_result.WeatherObservation", "_item", "_o")


def _situation_items(parsed: DataFrame) -> DataFrame:
    return _items(_result_items(parsed), "_result.Situation", "_item", "_s")


def _frost_items(parsed: DataFrame) -> DataFrame:
    return _items(_result_items(parsed), "_result.FrostDepthObservation", "_item", "_o")


def weather_observations(landed: DataFrame) -> DataFrame:
    """One row per observation. Flags stay text, as sent. Rows with a fractional
    identifier are left to ``fractional_ids``."""
    return weather_rows(parsed_weather(landed))


def weather_rows(parsed: DataFrame) -> DataFrame:
    items = _weather_items(parsed).where(~_fractional_id(F.col("_item.Measurepoint.Id")))
    return items.select(
        whole_from_text(F.col("_item.Measurepoint.Id")).alias("measurepoint_id"),
        F.col("_item.Measurepoint.Name").alias("measurepoint_name"),
        F.col("_item.Measurepoint.Geometry.WGS84").alias("wgs84"),
        utc_from_text(F.col("_item.Sample")).alias("sample_time"),
        number_from_text(F.col("_item.Surface.Temperature.Value")).alias("surface_temp_c"),
        F.col("_item.Surface.Water").alias("surface_water"),
        F.col("_item.Surface.Ice").alias("surface_ice"),
        F.col("_item.Surface.Snow").alias("surface_snow"),
        number_from_text(F.col("_item.Surface.Grip.Value")).alias("surface_grip"),
        number_from_text(F.col("_item.Air.Temperature.Value")).alias("air_temp_c"),
        number_from_text(F.col("_item.Air.RelativeHumidity.Value")).alias("air_rh"),
        number_from_text(F.col("_item.Air.Dewpoint.Value")).alias("dewpoint_c"),
        "ingested_at",
        "payload_id",
        _place("_r", "_o"),
    )


def situations(landed: DataFrame) -> DataFrame:
    """One row per deviation of each situation version."""
    return situation_rows(parsed_situations(landed))


def situation_rows(parsed: DataFrame) -> DataFrame:
    parts = _items(_situation_items(parsed), "_item.Deviation", "_part", "_d")
    return parts.select(
        F.col("_item.Id").alias("situation_id"),
        utc_from_text(F.col("_item.PublicationTime")).alias("publication_time"),
        utc_from_text(F.col("_item.VersionTime")).alias("version_time"),
        F.col("_part.MessageType").alias("message_type"),
        F.col("_part.MessageTypeValue").alias("message_type_value"),
        F.col("_part.MessageCode").alias("message_code"),
        F.col("_part.MessageCodeValue").alias("message_code_value"),
        F.col("_part.SeverityCode").alias("severity_code"),
        utc_from_text(F.col("_part.StartTime")).alias("start_time"),
        utc_from_text(F.col("_part.EndTime")).alias("end_time"),
        F.col("_part.Suspended").try_cast("boolean").alias("suspended"),
        F.col("_part.Geometry.Point.WGS84").alias("wgs84"),
        "ingested_at",
        "payload_id",
        _place("_r", "_s", "_d"),
    )


def frost_depths(landed: DataFrame) -> DataFrame:
    """One row per sensor reading."""
    return frost_rows(parsed_frost(landed))


def frost_rows(parsed: DataFrame) -> DataFrame:
    items = _frost_items(parsed).where(~_fractional_id(F.col("_item.Measurepoint.Id")))
    parts = _items(items, "_item.FrostDepth.Temperature", "_part", "_t")
    return parts.select(
        whole_from_text(F.col("_item.Measurepoint.Id")).alias("measurepoint_id"),
        F.col("_item.Measurepoint.Name").alias("measurepoint_name"),
        F.col("_item.Measurepoint.Geometry.WGS84").alias("wgs84"),
        utc_from_text(F.col("_item.FrostDepth.Sample")).alias("sample_time"),
        F.col("_part.SensorName").alias("sensor_name"),
        number_from_text(F.col("_part.Depth")).alias("depth_cm"),
        number_from_text(F.col("_part.Value")).alias("temp_c"),
        "ingested_at",
        "payload_id",
        _place("_r", "_o", "_t"),
    )


def fractional_ids(landed: DataFrame, *, frost: bool = False) -> DataFrame:
    """Observations whose identifier is a number but not a whole one, for the
    quarantine table."""
    return fractional_rows(parsed_frost(landed) if frost else parsed_weather(landed), frost=frost)


def fractional_rows(parsed: DataFrame, *, frost: bool = False) -> DataFrame:
    items = _frost_items(parsed) if frost else _weather_items(parsed)
    return items.where(_fractional_id(F.col("_item.Measurepoint.Id"))).select(
        F.col("_item.Measurepoint.Id").alias("measurepoint_id"),
        "payload_id",
        "ingested_at",
        _place("_r", "_o"),
    )


def point_forecasts(landed: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per valid time. Position and identifier come from the location the
    payload was fetched for (``location_id``), not from the payload."""
    places = _places(locations)
    # Joined before anything is parsed: what is not asked for costs nothing further.
    asked = dimension_join(landed, places, ["location_id"], "inner")
    return _forecast_rows(parsed_forecasts(asked))


def _places(locations: DataFrame) -> DataFrame:
    return locations.select(
        F.col("id").alias("location_id"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        F.col("tv_measurepoint_id").alias("measurepoint_id"),
    )


def forecast_rows(parsed: DataFrame, locations: DataFrame) -> DataFrame:
    """The same of parsed payloads."""
    return _forecast_rows(dimension_join(parsed, _places(locations), ["location_id"], "inner"))


def parsed_forecasts(landed: DataFrame) -> DataFrame:
    """Parsed payloads: ``_forecast``, a struct of its times and steps, and ``_faults``."""
    parameter = schemas.struct(schemas.PARAMETER)
    step = schemas.struct(schemas.forecast_step(parameter))

    def careful(text: Column) -> Column:
        found = F.from_json(text, schemas.struct(schemas.forecast_step("STRING")))
        named = objects_in(found["parameters"], lambda t: F.from_json(t, parameter))
        return F.struct(found["validTime"].alias("validTime"), named.alias("parameters"))

    texts = object_in("body", schemas.forecast("STRING"))
    apart = F.struct(
        texts["approvedTime"].alias("approvedTime"),
        texts["referenceTime"].alias("referenceTime"),
        objects_in(texts["timeSeries"], careful).alias("timeSeries"),
    )
    whole = F.struct(*[F.col(f"_doc.{c}").alias(c) for c in ("approvedTime", "referenceTime", "timeSeries")])
    parsed = with_document(landed, schemas.forecast(step), whole, apart, "_forecast", fine="_fine")
    gaps = has_gaps(F.col("_forecast"), schemas.FORECAST_SHAPE)
    return with_faults(parsed, schemas.FORECAST_SHAPE, gaps).drop("body", "_fine")


def _forecast_rows(parsed: DataFrame) -> DataFrame:
    # The first field that is not empty is taken, and only then parsed: an
    # unreadable first field gives the ingest time, not the second field.
    raw_run = F.coalesce(
        F.nullif(F.col("_forecast.approvedTime"), F.lit("")),
        F.nullif(F.col("_forecast.referenceTime"), F.lit("")),
    )
    run = F.coalesce(utc_from_text(raw_run), F.col("ingested_at"))
    steps = _items(parsed.drop("_faults", "_answered").withColumn("forecast_run_time", run), "_forecast.timeSeries", "_step", "_t")
    named = steps.drop("_forecast")
    return named.select(
        "measurepoint_id",
        "lat",
        "lon",
        "forecast_run_time",
        utc_from_text(F.col("_step.validTime")).alias("valid_time"),
        _parameter("t").alias("t_air_c"),
        _parameter("pmean").alias("precip_mm"),
        _parameter("ws").alias("wind_ms"),
        _parameter("r").alias("rh"),
        "ingested_at",
        "payload_id",
        _place("_t"),
    )


def _parameter(name: str) -> Column:
    """First value of the last parameter of that name; null when missing or empty."""
    named = F.filter("_step.parameters", lambda p: p["name"] == name)
    last = F.try_element_at(named, F.lit(-1))
    return number_from_text(F.get(last["values"], F.lit(0)))
