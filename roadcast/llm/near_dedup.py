"""Near-duplicates: circulant MinHash, banding, and exact Jaccard on whole sets.

A document's set holds its distinct runs of a few words. Documents with equal sets are
one class from the start. Classes that agree on a band of signature coordinates share a
bucket, and two classes are linked when ``100 * intersection >= percent * union`` on
their whole sets. Documents are duplicates when links connect them.

No bucket's pairs are ever listed. First every bucket compares its members with one of
them, the one that shares most buckets with others. A large family of copies is mostly
connected by then, at a cost in proportion to its size. What is left are members that
are not in a bucket's largest component; they are compared with all others of the
bucket, in blocks of bounded size that meet in one task each and return only the links
that join components. So every pair of a bucket is compared or already connected.

The number of bands follows from the threshold: a pair that just reaches it shares no
band with a probability of at most 0.00001. Shingles are 64-bit hashes.

Defined results: null and empty texts, and those of white space, have empty sets and are
linked with nothing. A row with a null id is linked with nothing and kept. Rows that
repeat an id and text are one document several times, with the same result; rows that
repeat an id with another text are documents of their own. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from roadcast.llm.bitmaps import bitmap, maybe_in, surely_out
from roadcast.llm.graph import components
from roadcast.llm.minhash import band_keys, bands_for, linked, shingle_sets, signatures
from roadcast.llm.tables import in_small_batches, settle
from roadcast.llm.wordhash import WHITE, hashed_words
from roadcast.operators.joins import skewproof_join

BAND_ROWS = 4
BLOCK_ROWS = 512  # members of a bucket that meet others in one task,
BLOCK_SHINGLES = 1 << 20  # or fewer, if their sets are this large


def _digest(own: np.ndarray) -> bytes:
    return hashlib.md5(own.tobytes()).digest()


def _sets(column: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    for row, hashes, counts in hashed_words(column, WHITE):
        yield row, shingle_sets(hashes, counts, size)


def sketches(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """A row per document: ``doc_id, mark`` (of its text), ``print`` (of its set), ``n``
    (its size), ``bands``."""
    kind = docs.schema[id_col].dataType.simpleString()
    bands = bands_for(percent / 100, BAND_ROWS)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets in _sets(batch.column(2), size):
                full = [s for s in sets if len(s)]
                keys = np.empty((0, bands), np.int64)
                if full:
                    keys = band_keys(signatures(full, bands * BAND_ROWS), BAND_ROWS)
                upto = np.cumsum([0, *(bands if len(s) else 0 for s in sets)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(sets)),
                        batch.column(1).slice(row, len(sets)),
                        pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(keys.reshape(-1))),
                    ],
                    ["doc_id", "mark", "print", "n", "bands"],
                )

    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text")
    )
    return in_small_batches(rows).mapInArrow(
        sketch, f"doc_id {kind}, mark long, print binary, n long, bands array<long>"
    )


def _classes(sketched: DataFrame) -> DataFrame:
    """A row per distinct set: ``id``, its print, ``doc_id, mark`` of its smallest
    document, ``n, bands``. An id of documents may have several texts, a print has one set."""
    rows = sketched.filter("n > 0 and doc_id is not null")
    best = rows.groupBy("print").agg(F.min(F.struct("doc_id", "mark", "n", "bands")).alias("c"))
    return best.select(F.col("print").alias("id"), "c.doc_id", "c.mark", "c.n", "c.bands")


def _buckets(classes: DataFrame) -> DataFrame:
    """Members of buckets of two or more: ``key, id, n, members``."""
    members = classes.select("id", "n", F.explode("bands").alias("key"))
    crowded = members.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    return skewproof_join(members, crowded, ["key"], "inner")


def _blocks(rows: Column, shingles: Column) -> Column:
    return F.ceil(F.greatest(rows / BLOCK_ROWS, shingles / BLOCK_SHINGLES)).cast("long")


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("id"), blocks)


def _star_groups(buckets: DataFrame, percent: int) -> DataFrame:
    """Groups that compare the middle of a bucket (side 0) with its members (side 1):
    ``group, side, id``. A middle's members count once, whatever bands they share."""
    shared = buckets.groupBy("id").agg(F.sum("members").alias("shared"))
    ranked = buckets.join(shared, "id")
    middles = ranked.groupBy("key").agg(F.max(F.struct("shared", "n", "id")).alias("best")).select(
        "key", F.col("best.id").alias("middle"), F.col("best.n").alias("n_middle")
    )
    near = 100 * F.least("n", "n_middle") >= percent * F.greatest("n", "n_middle")
    pairs = (
        skewproof_join(buckets, middles, ["key"], "inner")
        .filter((F.col("id") != F.col("middle")) & near)
        .select("middle", "id", "n")
        .distinct()
    )
    pairs = settle(pairs, "star-pairs")
    sizes = pairs.groupBy("middle").agg(
        _blocks(F.count("*"), F.sum("n")).alias("blocks")
    )
    around = skewproof_join(pairs, sizes, ["middle"], "inner").select(
        F.struct("middle", _block(F.col("blocks")).alias("i"), F.lit(0).cast("long").alias("j")).alias("group"),
        F.lit(1).alias("side"),
        "id",
    )
    centre = sizes.select(
        "middle", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("i")
    ).select(
        F.struct("middle", "i", F.lit(0).cast("long").alias("j")).alias("group"),
        F.lit(0).alias("side"),
        F.col("middle").alias("id"),
    )
    return around.unionByName(centre)


def _rest_groups(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Groups that compare the members outside a bucket's largest component (side 0)
    with all its members (side 1). Buckets with the same members count once."""
    labelled = settle(
        buckets.join(roots.withColumnRenamed("node", "id"), "id", "left").select(
            "key", "id", "n", F.coalesce("root", "id").alias("root")
        ),
        "labelled-buckets",
    )
    parts = labelled.groupBy("key", "root").agg(
        F.count("*").alias("rows"), F.sum("n").alias("shingles"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("mark")
    )
    sizes = (
        parts.groupBy("key")
        .agg(
            F.count("*").alias("parts"),
            F.sum("rows").alias("rows"),
            F.sum("shingles").alias("shingles"),
            F.sum("mark").alias("mark"),
            F.max(F.struct("rows", "root", "shingles")).alias("largest"),
        )
        .filter("parts > 1 and rows > 2")
        .groupBy("rows", "shingles", "mark")
        .agg(F.min(F.struct("key", "largest")).alias("one"))
        .select(
            "one.key",
            F.col("one.largest.root").alias("largest"),
            _blocks(F.col("rows"), F.col("shingles")).alias("all"),
            _blocks(F.col("rows") - F.col("one.largest.rows"), F.col("shingles") - F.col("one.largest.shingles")).alias("loose"),
        )
    )
    rows = skewproof_join(labelled, settle(sizes, "open-buckets"), ["key"], "inner")

    def numbered(column: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(column) - 1))

    loose = rows.filter("root <> largest").select(
        "key", _block(F.col("loose")).alias("i"), numbered("all").alias("j"), F.lit(0).alias("side"), "id"
    )
    every = rows.select(
        "key", numbered("loose").alias("i"), _block(F.col("all")).alias("j"), F.lit(1).alias("side"), "id"
    )
    return loose.unionByName(every).select(F.struct("key", "i", "j").alias("group"), "side", "id")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set on the left with every one on the right."""
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float32)
    for k in range(0, len(shared), 4096):
        part = shared[k : k + 4096]
        out += _held(left, part) @ _held(right, part).T
    return out


def _held(sets: list[np.ndarray], values: np.ndarray) -> np.ndarray:
    """Which of the sorted values each of the sorted sets holds."""
    out = np.zeros((len(sets), len(values)), np.float32)
    for row, own in zip(out, sets):
        own = own[np.searchsorted(own, values[0]) : np.searchsorted(own, values[-1], "right")]
        at = np.searchsorted(values, own)
        row[at[values[np.minimum(at, len(values) - 1)] == own]] = 1
    return out


def _joining(left: list[tuple], right: list[tuple], percent: int) -> list[tuple]:
    """Links between ``(id, root, set)`` on the left and on the right, those that join
    components not joined yet."""
    up: dict = {}

    def top(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    if len(left) * len(right) <= 64:
        close = (
            (a, b)
            for a in left
            for b in right
            if top(a[1]) != top(b[1]) and linked(a[2], b[2], percent)
        )
    else:
        both = _common([a[2] for a in left], [b[2] for b in right])
        n = np.array([len(a[2]) for a in left])[:, None] + np.array([len(b[2]) for b in right])[None, :]
        close = ((left[i], right[j]) for i, j in np.argwhere(100 * both >= percent * (n - both)))
    links = []
    for a, b in close:
        x, y = top(a[1]), top(b[1])
        if x != y:
            up[max(x, y)] = min(x, y)
            links.append((a[0], b[0]))
    return links


def _compare(groups: DataFrame, classes: DataFrame, roots: DataFrame | None, docs: DataFrame,
             size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Links ``a, b`` between the two sides of each group."""
    own = classes.select("id", "doc_id", "mark")
    if roots is not None:
        own = own.join(roots.withColumnRenamed("node", "id"), "id", "left")
    else:
        own = own.withColumn("root", F.col("id"))
    asked = groups.join(own, "id").select(
        F.xxhash64("group").alias("g"), "side", "id", "doc_id", "mark", F.coalesce("root", "id").alias("root")
    )
    asked = settle(asked, "groups")
    texts = maybe_in(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", bitmap(asked, "doc_id")
    ).withColumn("mark", F.xxhash64("text"))
    rows = (
        asked.join(texts, ["doc_id", "mark"])
        .select("g", "side", "id", "root", "text")
        .repartition("g")
        .sortWithinPartitions("g", "side", "id")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, sides = None, ({}, {})
        for batch in batches:
            found = []
            columns = [batch.column(k).to_pylist() for k in range(4)]
            for row, sets in _sets(batch.column(4), size):
                for k, own in enumerate(sets, row):
                    g, side, node, root = (c[k] for c in columns)
                    if g != group:
                        found += _joining(*(list(s.values()) for s in sides), percent)
                        group, sides = g, ({}, {})
                    if _digest(own) == node:  # else another text of the same mark
                        sides[side][node] = (node, root, own)
            if found:
                yield _links(found)
        if group is not None:
            found = _joining(*(list(s.values()) for s in sides), percent)
            if found:
                yield _links(found)

    def _links(found):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], ["a", "b"])

    found = in_small_batches(rows).mapInArrow(compare, "a binary, b binary")
    return settle(found, "links")


def _judged(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """A row per document: ``doc_id, mark, n_shingles, component_id, kept``."""
    sketched = settle(sketches(docs, size, percent, id_col, text_col), "sketches")
    classes = settle(_classes(sketched), "classes")
    buckets = settle(_buckets(classes), "buckets")
    how = (docs, size, percent, id_col, text_col)
    stars = _compare(_star_groups(buckets, percent), classes, None, *how)
    roots = settle(components(stars), "roots")
    rest = _compare(_rest_groups(buckets, roots), classes, roots, *how)
    roots = components(stars.unionByName(rest)).withColumnRenamed("node", "id")
    # The document that stays is the smallest of the classes that links connect.
    first = classes.select("id", F.struct("doc_id", "mark").alias("own"))
    tied = settle(first.join(roots, "id"), "tied-classes")
    best = tied.groupBy("root").agg(F.min("own").alias("best"))
    tied = skewproof_join(tied.select("id", "root"), best, ["root"], "inner").select("id", "best")
    of_class = first.join(tied, "id", "left").select(
        F.col("id").alias("print"), F.coalesce("best", "own").alias("best")
    )
    found = skewproof_join(sketched, of_class, ["print"], "left")
    linked_id = F.col("doc_id").isNotNull() & F.col("best").isNotNull()
    stays = (F.col("doc_id") == F.col("best.doc_id")) & (F.col("mark") == F.col("best.mark"))
    return found.select(
        "doc_id",
        "mark",
        F.col("n").alias("n_shingles"),
        F.when(linked_id, F.col("best.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linked_id, stays).otherwise(True).alias("kept"),
    )


def near_groups(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per document: ``doc_id, n_shingles, component_id, kept``."""
    return _judged(docs, size, percent, id_col, text_col).drop("mark")


def keep_one(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents without those that duplicate one with a smaller id, or with the same
    id and a smaller mark, with the columns they came with. Only texts of rows that share
    an id with a dropped one are shuffled."""
    found = _judged(docs, size, percent, id_col, text_col).filter("not kept")
    dropped = found.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).distinct()
    dropped = settle(dropped, "near-copies")
    inner = {c: f"__in_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    pages = bitmap(dropped, "__id")
    checked = maybe_in(rows, inner[id_col], pages).join(
        dropped,
        (F.col(inner[id_col]) == F.col("__id")) & (F.xxhash64(inner[text_col]) == F.col("__mark")),
        "left_anti",
    )
    return surely_out(rows, inner[id_col], pages).unionByName(checked).toDF(*docs.columns)
