"""Landed payload text: reading it, and telling good bodies from bad.

A landed frame has one payload per row: ``body`` (whole text), ``payload_id`` and
``ingested_at``, plus whatever partition columns the folder carries (such as
``location_id``). Parsing happens downstream, so a bad body costs its own row only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadcast.functions.payload import is_object, shape_faults


def read_landing(
    spark: SparkSession, path: str, *, json_lines: bool = False, only: Column | None = None
) -> DataFrame:
    """One row per file, or one per line with ``json_lines`` (which splits large
    files across tasks). ``only`` is a condition on ``_metadata`` that files must meet;
    the others are not opened."""
    text = spark.read.text(path, wholetext=not json_lines)
    landed = as_landed(text if only is None else text.where(only))
    return with_line_order(landed) if json_lines else landed


def landed_file() -> Column:
    """The file a payload came in, from its identifier."""
    return F.substring_index("payload_id", "#", 1)


def as_landed(text: DataFrame) -> DataFrame:
    """Name the columns of a text read; works on batch and streaming reads alike.

    The ingest time is the file's modification time, not the clock, so reading the
    same files again gives the same rows.
    """
    others = [c for c in text.columns if c != "value"]
    return text.select(
        F.col("value").alias("body"),
        F.col("_metadata.file_path").alias("payload_id"),
        F.col("_metadata.file_block_start").alias("_block_start"),
        F.col("_metadata.file_modification_time").alias("ingested_at"),
        *others,
    )


def with_line_order(landed: DataFrame) -> DataFrame:
    """Tell the lines of one file apart, in file order: by the start of the file
    block and then by the order in which its one task reads it."""
    padded = [
        F.lpad(n.cast("string"), 20, "0")
        for n in (F.col("_block_start"), F.monotonically_increasing_id())
    ]
    return landed.withColumn("payload_id", F.concat_ws("#", "payload_id", *padded)).drop(
        "_block_start"
    )


def _bad_answer(landed: DataFrame) -> Column:
    """Reason to reject a payload without parsing it, or null. ``status`` and
    ``content_type`` are checked where the landing recorded them."""
    blank = ~F.coalesce(F.col("body").rlike(r"\S"), F.lit(False))
    reason = F.when(blank, "empty body")
    if "content_type" in landed.columns:
        typed = F.lower(F.coalesce(F.col("content_type"), F.lit("")))
        reason = F.when(~typed.contains("json"), "content type is not JSON").otherwise(reason)
    if "status" in landed.columns:
        reason = F.when(F.col("status") >= 400, "error status").otherwise(reason)
    return reason


def answered(landed: DataFrame) -> DataFrame:
    """Payloads that came with a good answer. Extraction parses each of them and
    takes no rows from one that is not JSON, so nothing is parsed twice."""
    return landed.where(_bad_answer(landed).isNull())


def with_verdict(landed: DataFrame) -> DataFrame:
    """Add ``reject_reason``: null for a payload that can be used."""
    reason = F.coalesce(_bad_answer(landed), F.when(~is_object(), "not JSON"))
    return landed.withColumn("reject_reason", reason)


def quarantined(landed: DataFrame, shape: Sequence[tuple[str, bool]] = ()) -> DataFrame:
    """Rejected payloads and, of others, the parts that are not of the ``shape`` (see
    ``shape_faults``), each with its whole text as ``body``, for the quarantine table."""
    kept = [c for c in landed.columns if c != "body"]
    whole = F.struct(F.col("reject_reason").alias("reason"), F.col("body").alias("body"))
    faults = F.when(F.col("reject_reason").isNotNull(), F.array(whole)).otherwise(
        shape_faults(F.col("body"), shape)
    )
    return listed_faults(with_verdict(landed).select(*kept, faults.alias("_faults")))


def with_faults(parsed: DataFrame, shape: Sequence[tuple[str, bool]], gaps: Column) -> DataFrame:
    """Add ``_faults``, what `quarantined` lists of a payload, and ``_answered``, whether
    it came with a good answer, to payloads that were parsed, as ``_fine`` tells. Of a
    fine one nothing is parsed again, unless it has ``gaps``."""
    none, faults = shape_faults(F.col("body"), ()), shape_faults(F.col("body"), shape)

    def whole(reason: Column) -> Column:
        return F.array(F.struct(reason.alias("reason"), F.col("body").alias("body")))

    bad = _bad_answer(parsed)
    careful = F.when(~is_object(), whole(F.lit("not JSON"))).otherwise(faults)
    of_fine = F.when(gaps, faults).otherwise(none)
    found = F.when(bad.isNotNull(), whole(bad)).when(F.col("_fine"), of_fine).otherwise(careful)
    return parsed.withColumns({"_faults": found, "_answered": bad.isNull()})


def listed_faults(parsed: DataFrame) -> DataFrame:
    """A row per fault of parsed payloads, as `quarantined` gives them."""
    kept = [c for c in parsed.columns if not c.startswith("_") or c == "_block_start"]
    judged = parsed.select(*kept, F.explode("_faults").alias("_fault"))
    return judged.select(*kept, F.col("_fault.reason").alias("reject_reason"), "_fault.body")
