"""Exact deduplication: 128-bit content hashes, checked byte for byte.

Two texts are equal when they are identical after dropping ASCII white space. Rows are
grouped by the MD5 of what is left, which moves a few bytes a row. Only rows whose hash
occurs more than once are then compared with the text of their group's representative;
one that differs from it leaves the group and forms another with its like. A bitmap of
those rows' ids keeps the texts of all others from being shuffled, or hashed again. Joins
by hash let a group that holds many rows be split over tasks.

Defined results: a null text counts as empty, and all empty texts are equal. A null id
sorts behind the others. Rows that repeat an id and text are one document several times:
each counts in ``group_size`` and all of them show the same ``kept``; `keep_first`
leaves one of them. Columns other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadcast.llm.bitmaps import bitmap, maybe_in, surely_out
from roadcast.llm.tables import settle
from roadcast.operators.joins import skewproof_join

SPACE = " \t\n\x0b\x0c\r"


def squeezed(text: Column) -> Column:
    """The text without its ASCII white space."""
    for blank in SPACE:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def content_hash(text: Column) -> Column:
    """128 bits of it."""
    return F.unhex(F.md5(text))


def _rank() -> Column:
    """What the row to keep is the minimum of: longest text, then smallest id."""
    return F.struct(
        (-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id")
    )


def _squeezed_rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", F.char_length(text).alias("n"), squeezed(text).alias("norm")
    ).withColumn("h", content_hash(F.col("norm")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    digest = F.sha2("norm", 256).alias("text_sha256")
    keyed = settle(_squeezed_rows(texts).select("doc_id", "n", "h", digest), "content-hashes")
    repeated = (
        keyed.groupBy("h")
        .agg(F.count("*").alias("size"), F.min(_rank()).alias("best"))
        .filter("size > 1")
        .select("h", F.col("best.doc_id").alias("best_id"), (-F.col("best.n")).alias("best_n"))
    )
    copies_ids = skewproof_join(keyed, repeated, ["h"], "left_semi")
    members = _squeezed_rows(maybe_in(texts, "doc_id", bitmap(copies_ids, "doc_id")))
    texts = (
        skewproof_join(members, repeated, ["h"], "inner")
        .filter(F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("n") == F.col("best_n")))
        .groupBy("h")
        .agg(F.min("norm").alias("best_norm"))
    )
    # Empty for rows that equal their representative, else the text that sets them apart.
    apart = F.when(F.col("norm") != F.col("best_norm"), F.col("norm")).otherwise("")
    compared = settle(
        skewproof_join(members, texts, ["h"], "inner").select(
            "doc_id", "h", "n", digest, apart.alias("apart")
        ),
        "compared",
    )
    groups = compared.groupBy("h", "apart").agg(
        F.count("*").alias("group_size"), F.min(_rank()).alias("best")
    )
    copies = skewproof_join(compared, groups, ["h", "apart"], "inner").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("n") == -F.col("best.n"))).alias(
            "kept"
        ),
        "text_sha256",
    )
    single = skewproof_join(keyed, repeated.select("h"), ["h"], "left_anti").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    return single.unionByName(copies)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without their exact copies, with the columns they came with. Only
    rows whose text repeats are shuffled."""
    copies = exact_groups(docs, id_col, text_col).filter("group_size > 1")
    grouped = copies.groupBy(F.col("text_sha256").alias("__sha"), F.col("doc_id").alias("__id")).agg(
        F.max("kept").alias("__kept")
    )
    decided = settle(grouped, "copies")
    inner = {c: f"__in_{i}" for i, c in enumerate(docs.columns)}
    text = F.coalesce(F.col(inner[text_col]), F.lit(""))
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    pages = bitmap(decided, "__id")
    same_row = Window.partitionBy("__sha", inner[id_col]).orderBy(F.col("__n").desc())
    checked = (
        maybe_in(rows, inner[id_col], pages)
        .select("*", F.sha2(squeezed(text), 256).alias("__sha"), F.char_length(text).alias("__n"))
        .alias("r")
    )
    kept = (
        checked.join(
            decided.alias("d"),
            (F.col("r.__sha") == F.col("d.__sha"))
            & F.col(f"r.{inner[id_col]}").eqNullSafe(F.col("d.__id")),
            "left",
        )
        .select("r.*", F.coalesce("__kept", F.lit(True)).alias("__kept"))
        .filter("__kept")
        .withColumn("__row", F.row_number().over(same_row))
        .filter("__row = 1")
    )
    return (
        surely_out(rows, inner[id_col], pages)
        .select(*inner.values())
        .unionByName(kept.select(*inner.values()))
        .toDF(*docs.columns)
    )
