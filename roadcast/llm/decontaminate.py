"""Finding benchmark passages in documents with a positional inverted index.

1. Count in the whole corpus how often each benchmark term occurs.
2. In every window of an item, pick the two rarest terms as its probes.
3. Index the documents: a posting, (term, document, position), for each occurrence of a
   probe term. The index is a table in the shared folder.
4. Join postings with probes. A posting at ``position`` of a term at ``offset`` in an
   item says that the item would begin at ``position - offset``; where both lists of a
   window agree on that, the document is a candidate there.
5. Compare the words of each candidate with the document's, and mark those that lie in
   any window that matches whole.

Terms are 64-bit hashes up to step 4; step 5 compares the words themselves. Tasks get a
bitmap of the terms, of fixed size however large the benchmark. Only texts of candidate
documents are shuffled.

Words are `[a-z0-9]` and everything beyond ASCII, A-Z lower-cased. Defined results: null
and empty texts have no words; items without words match nothing. An item without id is
looked for like any other: its passages count as hit, but it is in no list or number of
items. Rows that repeat an id are judged by their own texts. Items that repeat a text all
count, each by its id; an item that repeats an id with another text is looked for as well,
and the id counts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadcast.llm.bitmaps import BITS, bitmap, collect_bitmap, maybe_in, surely_out
from roadcast.llm.tables import in_small_batches, settle
from roadcast.llm.wordhash import PUNCTUATION, hashed_words, word_hash

WINDOW = 13
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _in(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit in a bitmap."""
    place = hashes & np.uint64(BITS - 1)
    table = np.frombuffer(bits, np.uint8)
    return (table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _key(own: Column) -> Column:
    """128 bits of a sequence of words, none of which holds a space."""
    return F.unhex(F.md5(F.concat_ws(" ", own)))


def distinct_items(items: DataFrame, text_col: str) -> DataFrame:
    """A row per distinct sequence of words: ``item`` (its key, as an id may have several
    texts), ``words``, ``terms`` (their hashes)."""
    texts = (
        items.select(words(F.col(text_col)).alias("words"))
        .filter(F.size("words") > 0)
        .distinct()
        .select(_key(F.col("words")).alias("item"), "words")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [word_hash(w).view(np.int64) for w in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(terms, pa.list_(pa.int64()))], ["item", "words", "terms"]
            )

    return texts.select("item", "words").mapInArrow(
        hashed, "item binary, words array<string>, terms array<bigint>"
    )


def term_counts(docs: DataFrame, text_col: str, bits: bytes) -> DataFrame:
    """How often each term in the bitmap occurs in the corpus: ``term, n``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            found = []
            for _, hashes, _ in hashed_words(batch.column(0), PUNCTUATION):
                found.append(hashes[_in(bits, hashes)])
            if found:
                own, n = np.unique(np.concatenate(found), return_counts=True)
                terms, back = np.unique(np.concatenate((terms, own)), return_inverse=True)
                counts = np.bincount(back, np.concatenate((counts, n)), len(terms)).astype(np.int64)
            if len(terms) > 1 << 20:
                yield _rows(terms.view(np.int64), counts)
                terms, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        yield _rows(terms.view(np.int64), counts)

    def _rows(terms, counts):
        return pa.RecordBatch.from_arrays([pa.array(terms), pa.array(counts)], ["term", "n"])

    partial = in_small_batches(docs.select(F.col(text_col))).mapInArrow(count, "term long, n long")
    return partial.groupBy("term").agg(F.sum("n").alias("n"))


def probes(items: DataFrame, counts: DataFrame, window: int = WINDOW) -> DataFrame:
    """The two rarest places of every window, each pair once: ``term, item, offset,
    probe, needed``. ``needed`` is 1 where a window has a single word."""
    places = items.select("item", F.size("terms").alias("n_words"), F.posexplode("terms").alias("offset", "term"))
    ranked = places.join(counts, "term", "left").select(
        "item", "n_words", "offset", "term", F.coalesce("n", F.lit(0)).alias("n")
    )
    # A window begins at each place that leaves room for a whole one.
    size = F.least("n_words", F.lit(window))
    first = F.greatest(F.lit(0), F.col("offset") - size + 1)
    last = F.least(F.col("offset"), F.col("n_words") - size)
    in_window = ranked.withColumn("begin", F.explode(F.sequence(first, last)))
    order = Window.partitionBy("item", "begin").orderBy("n", "offset")
    rarest = in_window.withColumn("rank", F.row_number().over(order)).filter("rank <= 2")
    pairs = rarest.groupBy("item", "begin").agg(
        F.sort_array(F.collect_list(F.struct("offset", "term"))).alias("pair")
    )
    return pairs.select("item", "pair").distinct().select(
        F.explode("pair").alias("place"),
        "item",
        F.col("pair")[0]["offset"].alias("probe"),
        F.col("pair")[F.size("pair") - 1]["offset"].alias("probe_end"),
        F.size("pair").alias("needed"),
    ).select("place.term", "item", "place.offset", "probe", "probe_end", "needed")


def build_index(docs: DataFrame, bits: bytes, id_col: str, text_col: str) -> DataFrame:
    """A row per document: ``doc_id, print`` (of its text), ``n_words`` and the postings
    of the terms in the bitmap as ``terms`` and ``positions``."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "print", "n_words", "terms", "positions"]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, hashes, counts in hashed_words(batch.column(2), PUNCTUATION):
                place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
                hit = _in(bits, hashes)
                upto = np.concatenate(([0], np.cumsum(hit)))[np.concatenate(([0], np.cumsum(counts)))]
                lists = [
                    pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(values[hit]))
                    for values in (hashes.view(np.int64), place.astype(np.int64))
                ]
                own = batch.slice(row, len(counts))
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), pa.array(counts), *lists], names
                )

    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("print"), F.col(text_col).alias("text")
    )
    return in_small_batches(rows).mapInArrow(
        index, f"doc_id {kind}, print long, n_words long, terms array<long>, positions array<long>"
    )


def _postings(index: DataFrame) -> DataFrame:
    zipped = F.explode(F.arrays_zip("terms", "positions")).alias("posting")
    return index.select("doc_id", "print", zipped).select(
        "doc_id", "print", F.col("posting.terms").alias("term"), F.col("posting.positions").alias("position")
    )


def candidates(index: DataFrame, probing: DataFrame) -> DataFrame:
    """Where an item may begin in a document: ``doc_id, print, item, begin``."""
    return (
        _postings(index)
        .join(probing, "term")
        .select("doc_id", "print", "item", "probe", "probe_end", "needed", "offset",
                (F.col("position") - F.col("offset")).alias("begin"))
        .groupBy("doc_id", "print", "item", "probe", "probe_end", "needed", "begin")
        .agg((F.min("offset") != F.max("offset")).alias("both"))
        .filter("both or needed = 1")
        .select("doc_id", "print", "item", "begin")
        .distinct()
    )


def near_matches(index: DataFrame, probing: DataFrame, slack: int) -> DataFrame:
    """Proximity search: where both probes of a window occur with their distance off by
    at most ``slack`` words: ``doc_id, item, probe, first, second`` (positions)."""
    found = _postings(index).join(probing.filter("needed = 2"), "term").withColumn(
        "begin", F.col("position") - F.col("offset")
    )
    keys = ["doc_id", "print", "item", "probe", "probe_end"]
    # Beginnings within ``slack`` of each other lie in one block or two neighbouring ones.
    block = F.floor(F.col("begin") / (slack + 1))
    first = found.filter("offset = probe").select(*keys, "position", "begin", block.alias("block"))
    second = found.filter("offset = probe_end").select(
        *keys, F.col("position").alias("second"), F.col("begin").alias("begin_2"),
        F.explode(F.array(block - 1, block, block + 1)).alias("block"),
    )
    return (
        first.join(second, [*keys, "block"])
        .filter(F.abs(F.col("begin") - F.col("begin_2")) <= slack)
        .select("doc_id", "item", "probe", F.col("position").alias("first"), "second")
        .distinct()
    )


def _confirmed(docs: DataFrame, where: DataFrame, items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Words hit and items found, for the candidate documents:
    ``doc_id, print, n_hit, items``."""
    kind = docs.schema[id_col].dataType.simpleString()
    asked = (
        where.join(items.select("item", F.concat_ws(" ", "words").alias("words")), "item")
        .groupBy(F.col("doc_id").alias("c_id"), F.col("print").alias("c_print"))
        .agg(F.collect_list(F.struct("item", "words", "begin")).alias("asked"))
    )
    texts = maybe_in(
        docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("print"), F.col(text_col).alias("text")),
        "print",
        bitmap(asked, "c_print"),
    )
    rows = texts.join(
        asked, (F.col("print") == F.col("c_print")) & F.col("doc_id").eqNullSafe(F.col("c_id"))
    ).select("doc_id", "print", words(F.col("text")).alias("words"), "asked")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, found = [], []
            for doc, asked in zip(batch.column(2), batch.column(3)):
                n_hit, own = _matches(doc.as_py(), asked.as_py(), window)
                hits.append(n_hit)
                found.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hits, pa.int64()), pa.array(found, pa.list_(pa.binary()))],
                ["doc_id", "print", "n_hit", "items"],
            )

    confirmed = in_small_batches(rows).mapInArrow(compare, f"doc_id {kind}, print long, n_hit long, items array<binary>")
    return confirmed.groupBy("doc_id", "print").agg(
        F.max("n_hit").alias("n_hit"), F.first("items").alias("items")
    )


def _matches(doc: list[str], asked: list[dict], window: int) -> tuple[int, list]:
    """How many words lie in windows that match, and the items they belong to."""
    hit = np.zeros(len(doc) + 1, np.int64)
    found = set()
    for candidate in asked:
        item, begin = candidate["words"].split(" "), candidate["begin"]
        size, run = min(window, len(item)), 0
        for k, word in enumerate(item):
            at = begin + k
            run = run + 1 if 0 <= at < len(doc) and doc[at] == word else 0
            if run >= size:
                found.add(candidate["item"])
                hit[at - size + 1] += 1
                hit[at + 1] -= 1
    return int(np.count_nonzero(np.cumsum(hit[:-1]))), sorted(found)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    share: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """A row per document: ``doc_id, print, n_words, n_hit, n_items, items_sha256,
    contaminated``. A document is contaminated when at least one word in ``share`` lies
    inside a matching window."""
    known = settle(distinct_items(items, item_text), "benchmark-items")
    vocabulary = known.select(F.explode("terms").alias("term"))
    counts = term_counts(docs, text_col, collect_bitmap(vocabulary, "term"))
    probing = settle(probes(known, counts, window), "benchmark-probes")
    index = settle(
        build_index(docs, collect_bitmap(probing, "term"), id_col, text_col), "word-index"
    )
    confirmed = settle(
        _confirmed(docs, candidates(index, probing), known, window, id_col, text_col).filter("n_hit > 0"),
        "benchmark-matches",
    )
    ids = items.filter(F.col(item_id).isNotNull()).select(
        _key(words(F.col(item_text))).alias("item"), F.col(item_id).cast("string").alias("item_id")
    ).distinct()
    listed = (
        confirmed.select("doc_id", "print", "n_hit", F.explode("items").alias("item"))
        .join(ids, "item", "left")
        .groupBy(F.col("doc_id").alias("c_id"), F.col("print").alias("c_print"))
        .agg(F.max("n_hit").alias("hit"), F.array_sort(F.collect_set("item_id")).alias("ids"))
    )
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    joined = index.select("doc_id", "print", "n_words").join(
        listed, (F.col("print") == F.col("c_print")) & F.col("doc_id").eqNullSafe(F.col("c_id")), "left"
    )
    return joined.select(
        "doc_id",
        "print",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "ids"), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with the columns they came with. Only
    texts whose print is that of a contaminated one are shuffled."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    bad = contamination(docs, items, **options).filter("contaminated").select("doc_id", "print").distinct()
    bad = settle(bad, "contaminated").alias("b")
    inner = {c: f"__in_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()]).withColumn(
        "__print", F.xxhash64(inner[text_col])
    )
    pages = bitmap(bad, "print")
    checked = maybe_in(rows, "__print", pages).join(
        bad,
        (F.col("__print") == F.col("b.print")) & F.col(inner[id_col]).eqNullSafe(F.col("b.doc_id")),
        "left_anti",
    )
    left = surely_out(rows, "__print", pages).unionByName(checked)
    return left.select(*inner.values()).toDF(*docs.columns)
