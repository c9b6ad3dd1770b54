"""Exact deduplication: edge rows, repeated rows, clashing columns, hash collisions."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from roadcast.llm import bitmaps, exact_dedup

ROWS = [
    (1, "a b", "x"),
    (2, "ab", "x"),
    (3, "a  b\t\n", "y"),
    (4, None, None),
    (5, "", "y"),
    (6, " \x0b\x0c\r", None),
    (7, "a b", "no ASCII space"),
    (8, "lone", "z"),
    (9, "lone2", None),
    (9, "lone2", None),
    (None, "ab", "null id"),
    (10, "é" * 50_000, "long"),
    (11, " " + "é" * 50_000, "long"),
]
SCHEMA = "doc_id long, text string, kept string"


def brute(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups["".join(c for c in t or "" if c not in exact_dedup.SPACE)].append((i, t or ""))
    out = []
    for members in groups.values():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        out += [(i, best[0], len(members), (i, len(t)) == (best[0], len(best[1]))) for i, t in members]
    return sorted(out, key=repr)


def result(df):
    rows = df.select("doc_id", "keep_id", "group_size", "kept").collect()
    return sorted(map(tuple, rows), key=repr)


def test_against_brute_force(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    assert result(exact_dedup.exact_groups(docs)) == brute(ROWS)


def test_keep_first_returns_the_same_columns_and_one_row_a_group(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumn("h", F.lit(1)).withColumn("n", F.lit("n"))
    left = exact_dedup.keep_first(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 6, 7, 8, 9, 11]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_groups(docs).count() == 0
    assert exact_dedup.keep_first(docs).count() == 0


def test_texts_that_share_a_hash_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "content_hash", lambda c: F.substring(c, 1, 1))
    rows = [(i, t, None) for i, t in enumerate(["ab", "a b", "ac", "ac ", "ad", "b", "b"])]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert result(exact_dedup.exact_groups(docs)) == brute(rows)


@pytest.mark.parametrize("bits", [1 << 15, 1 << 24])
def test_bitmap_splits_without_loss(spark, monkeypatch, bits):
    monkeypatch.setattr(bitmaps, "BITS", bits)
    rows = spark.range(5000).withColumn("k", F.when(F.col("id") % 7 > 0, F.col("id")))
    keys = rows.filter("id % 10 = 3").select("k")
    pages = bitmaps.bitmap(keys, "k")
    inside = {r.id for r in bitmaps.maybe_in(rows, "k", pages).collect()}
    outside = {r.id for r in bitmaps.surely_out(rows, "k", pages).collect()}
    assert {i for i in range(5000) if i % 10 == 3} <= inside
    assert not inside & outside and len(inside | outside) == 5000
