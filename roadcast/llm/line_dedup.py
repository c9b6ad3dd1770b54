"""Line dedup: lines that many documents share stay in one of them.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Of a key
that is long enough and found in enough documents, only the lines in the largest document
stay.

1. Each line with a long key becomes a row of hash, document and position.
2. These rows are partitioned by ranges of hash and document, so that a line which a
   third of all documents hold is spread over many tasks, and sorted by hash, document
   and position. The stream of a partition leaves the first row of each key and document.
3. First occurrences are counted by key, pre-aggregated in each task.
4. Rows of repeated keys (a bitmap keeps the others where they are) are joined with the
   counts; what is to go is listed by document and returned as a bitmap of lines to keep,
   compressed to its runs. No text takes part in a shuffle up to here.

The bitmap of a document is its runs of kept lines, each as first line and length, in
base-128 digits with the lowest first. `kept_text` reads it.

Defined results: a null text is one empty line. A document is what has its id: rows that
repeat an id hold a key once, together, and each keeps or loses its own lines. Rows
without id count as one document that is smaller than all others. Other columns are
ignored. Hashes are 128 bits of SHA-256. Everything is column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadcast.llm.bitmaps import bitmap, maybe_in, surely_out
from roadcast.llm.tables import settle
from roadcast.operators.joins import skewproof_join

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(SPACE))
    # Of texts in ASCII, the quicker function changes the same letters.
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _print(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(text_col, F.lit("")))


def keyed_lines(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """A row per line with a long key: ``h, doc_id, print`` (of the text), ``n_lines`` of
    the text and the line's position ``pos``."""
    lines = docs.select(
        F.col(id_col).alias("doc_id"), _print(text_col).alias("print"), _lines(F.col(text_col)).alias("lines")
    )
    each = lines.select("doc_id", "print", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    keyed = each.select("doc_id", "print", "n_lines", "pos", line_key(F.col("line")).alias("key"))
    half = F.substring(F.unhex(F.sha2("key", 256)), 1, 16)
    return keyed.filter(F.char_length("key") >= least_chars).select(half.alias("h"), "doc_id", "print", "n_lines", "pos")


def repeated_keys(keyed: DataFrame, least_documents: int) -> DataFrame:
    """``h, last`` of the keys in enough documents: the largest document that has it."""
    ranges = keyed.select("h", "doc_id", "pos").repartitionByRange("h", "doc_id")
    # The ranges suit this window, which sorts each by position and streams it.
    order = Window.partitionBy("h", "doc_id").orderBy("pos")
    firsts = ranges.withColumn("nth", F.row_number().over(order)).filter("nth = 1")
    counted = firsts.groupBy("h").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last"))
    return counted.filter(F.col("n_docs") >= least_documents).select("h", "last")


def _digits(n: Column) -> Column:
    """A number in base 128, the lowest digit first, all but the last plus 128, as hex."""

    def put(digit: Column) -> Column:
        return F.lpad(F.hex(digit), 2, "0")

    out = put(F.shiftright(n, 28))
    for k in (21, 14, 7, 0):
        rest = F.shiftright(n, k)
        out = F.when(rest < 128, put(rest)).otherwise(F.concat(put(rest % 128 + 128), out))
    return out


def keep_bitmap(n_lines: Column, dropped: Column) -> Column:
    """The bitmap of what is left of so many lines without the ``dropped``, a sorted
    array of positions."""
    bounds = F.concat(F.array(F.lit(-1)), dropped, F.array(n_lines))
    runs = F.transform(
        F.array(bounds),
        lambda b: F.filter(
            F.transform(
                F.sequence(F.lit(1), F.size(b) - 1),
                lambda i: F.struct(
                    (F.get(b, i - 1) + 1).alias("first"), (F.get(b, i) - F.get(b, i - 1) - 1).alias("n")
                ),
            ),
            lambda r: r["n"] > 0,
        ),
    )
    written = F.transform(F.get(runs, F.lit(0)), lambda r: F.concat(_digits(r["first"]), _digits(r["n"])))
    return F.unhex(F.array_join(written, ""))


def kept_runs(bits: Column) -> Column:
    """The runs in a bitmap: ``array<struct<first, n>>``."""

    def pairs(digits: Column) -> Column:
        places = F.transform(digits, lambda _, i: i)
        ends = F.filter(places, lambda i: F.get(digits, i) < 128)

        def number(k: Column, ends: Column) -> Column:
            first = F.coalesce(F.get(ends, k - 1), F.lit(-1)) + 1
            value = F.lit(0)
            for d in range(5):
                digit = F.when(first + d <= F.get(ends, k), F.get(digits, first + d)).otherwise(0)
                value = value + F.shiftleft(digit % 128, 7 * d)
            return value

        return F.get(
            F.transform(
                F.array(ends),
                lambda e: F.transform(
                    F.filter(F.transform(e, lambda _, i: i), lambda i: i % 2 == 0),
                    lambda i: F.struct(number(i, e).alias("first"), number(i + 1, e).alias("n")),
                ),
            ),
            F.lit(0),
        )

    # Bound to names within the expression, so that each is computed once.
    text = F.hex(bits)
    digits = F.transform(
        F.array(text),
        lambda t: F.when(
            F.char_length(t) > 0,
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.char_length(t), F.lit(2)) - 1, F.lit(2)),
                lambda i: F.conv(F.substr(t, i, F.lit(2)), 16, 10).cast("int"),
            ),
        ).otherwise(F.expr("cast(array() as array<int>)")),
    )
    return F.get(F.transform(digits, pairs), F.lit(0))


def kept_text(text: Column, bits: Column) -> Column:
    """The lines that a bitmap keeps, joined; the whole text where it is null."""
    both = F.struct(_lines(text).alias("lines"), kept_runs(bits).alias("runs"))
    parts = F.transform(
        F.array(both),
        lambda b: F.flatten(F.transform(b["runs"], lambda r: F.slice(b["lines"], r["first"] + 1, r["n"]))),
    )
    joined = F.array_join(F.get(parts, F.lit(0)), "\n")
    return F.when(bits.isNull(), F.coalesce(text, F.lit(""))).otherwise(joined)


def line_bitmaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """A row per text that loses lines: ``doc_id, print, n_lines, n_dropped, keep``, its
    bitmap. All other texts stay whole."""
    keyed = settle(keyed_lines(docs, id_col, text_col, least_chars), "line-hashes")
    repeated = settle(repeated_keys(keyed, least_documents), "repeated-lines")
    shared = skewproof_join(maybe_in(keyed, "h", bitmap(repeated, "h")), repeated, ["h"], "inner")
    dropped = (
        shared.filter(~F.col("doc_id").eqNullSafe(F.col("last")))
        .groupBy("doc_id", "print")
        .agg(F.max("n_lines").alias("n_lines"), F.array_sort(F.collect_set("pos")).alias("dropped"))
    )
    return dropped.select(
        "doc_id",
        "print",
        "n_lines",
        F.size("dropped").cast("long").alias("n_dropped"),
        keep_bitmap(F.col("n_lines"), F.col("dropped")).alias("keep"),
    )


def _with_bitmaps(docs: DataFrame, id_col: str, text_col: str, options: dict) -> tuple[DataFrame, dict]:
    """The documents, their columns renamed as told, with ``__n_dropped`` and ``__keep``,
    null for texts that stay whole. Only texts that lose lines are shuffled."""
    found = settle(line_bitmaps(docs, id_col, text_col, **options), "line-bitmaps").select(
        F.col("doc_id").alias("__id"), F.col("print").alias("__hit"), F.col("n_dropped").alias("__n_dropped"),
        F.col("keep").alias("__keep"),
    )
    inner = {c: f"__in_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    rows = rows.withColumn("__print", _print(inner[text_col]))
    pages = bitmap(found, "__hit")
    hit = maybe_in(rows, "__print", pages).join(
        found, (F.col("__print") == F.col("__hit")) & F.col(inner[id_col]).eqNullSafe(F.col("__id")), "left"
    )
    whole = surely_out(rows, "__print", pages)
    return hit.drop("__id", "__hit").unionByName(whole, allowMissingColumns=True), inner


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without their shared lines, with the columns they came with."""
    rows, inner = _with_bitmaps(docs, id_col, text_col, options)
    text = F.when(F.col("__keep").isNull(), F.col(inner[text_col])).otherwise(
        kept_text(F.col(inner[text_col]), F.col("__keep"))
    )
    return rows.select(
        *[(text if c == text_col else F.col(n)).alias(c) for c, n in inner.items()]
    )


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row per document: ``doc_id, n_lines, n_dropped, kept_sha256``."""
    rows, inner = _with_bitmaps(docs, id_col, text_col, options)
    text = F.coalesce(F.col(inner[text_col]), F.lit(""))
    breaks = F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit("")))
    return rows.select(
        F.col(inner[id_col]).alias("doc_id"),
        (breaks + 1).cast("long").alias("n_lines"),
        F.coalesce("__n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept_text(text, F.col("__keep")).cast("binary"), 256).alias("kept_sha256"),
    )
