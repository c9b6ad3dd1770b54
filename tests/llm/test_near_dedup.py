"""Near-dedup against brute force over all pairs, with blocks of every size."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadcast.llm import minhash, near_dedup
from roadcast.llm.graph import components
from roadcast.llm.wordhash import PUNCTUATION, WHITE, hashed_words, word_hash

SCHEMA = "doc_id long, text string"


def shingles(text, size):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in words.replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ")
             .replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def brute(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t in rows]
    up = {i: i for i, _ in sets if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, s in sets:
        for b, t in sets:
            if a is not None and b is not None and a < b and s and t:
                if 100 * len(s & t) >= percent * len(s | t):
                    x, y = top(a), top(b)
                    up[max(x, y)] = min(x, y)
    return sorted(
        {(i, len(s), None if i is None else top(i), i is None or top(i) == i) for i, s in sets}, key=repr
    )


def result(df):
    return sorted({tuple(r) for r in df.collect()}, key=repr)


def family(seed, n, words=120, edits=4):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(4000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits)):
            own[rng.randrange(words)] = f"x{rng.randrange(9999)}"
        out.append(" ".join(own))
    return out


EDGES = [None, "", " \t\x0b", "One", "one", "one two", "one  TWO", "one two three", "é " * 5, "a" * 70_000,
         "a\x00b c d", "a b c d", "\x00", "a\x00 b c d"]


@pytest.fixture(scope="module")
def rows():
    texts = EDGES + family(1, 40) + family(2, 25, edits=9) + family(3, 6, words=900, edits=60)
    out = [(7 * i % 1009, t) for i, t in enumerate(texts)]
    return out + [out[12], (None, texts[11]), (None, None)]


@pytest.mark.parametrize("block", [2, 512])
@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_against_brute_force(spark, rows, monkeypatch, block, size, percent):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block)
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit(1)).withColumn("n", F.lit("x"))
    found = result(near_dedup.near_groups(docs, size, percent))
    want = brute(rows, size, percent)
    assert [r for r in found if r[0] is not None] == [r for r in want if r[0] is not None]
    assert {r[0] for r in found if r[0] is None} == {None}
    assert all(r[2] is None and r[3] for r in found if r[0] is None)


def test_one_document_of_each_group_stays(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("__id", F.col("doc_id")).withColumn("kept", F.lit(0))
    left = near_dedup.keep_one(docs)
    assert left.columns == docs.columns
    want = {r[0] for r in brute(rows, 5, 80) if r[3]}
    assert {r.doc_id for r in left.collect()} == want


def test_one_id_with_two_texts(spark):
    a, b, c = (" ".join(f"{w}{k}" for k in range(60)) for w in "abc")
    rows = [(1, a), (2, a + " end"), (2, b), (3, b + " end"), (3, c), (4, c), (5, c + " end"), (5, c + " fin")]
    docs = spark.createDataFrame(rows, SCHEMA)
    left = [tuple(r) for r in near_dedup.keep_one(docs).collect()]
    assert sorted(left) == [(1, a), (2, b), (3, c)]
    found = [(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_groups(docs).collect()]
    assert sorted(found) == [(1, 1, True), (2, 1, False), (2, 2, True), (3, 2, False), (3, 3, True),
                             (4, 3, False), (5, 3, False), (5, 3, False)]
    twins = [(7, a), (7, a + " end"), (7, a.upper()), (7, c)]
    left = [tuple(r) for r in near_dedup.keep_one(spark.createDataFrame(twins, SCHEMA)).collect()]
    assert len(left) == 2 and (7, c) in left


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near_dedup.near_groups(docs).count() == 0
    assert near_dedup.keep_one(docs).count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(99), rng.randrange(99)) for _ in range(60)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {(r.node, r.root) for r in found} == {(x, top(x)) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.sort(values[:2000]), np.sort(values[500:2500])
    signs = minhash.signatures([a, b], 2048)
    assert abs((signs[0] == signs[1]).mean() - 1500 / 2500) < 0.04
    assert minhash.linked(a, b, 60) and not minhash.linked(a, b, 61)


def test_bands_follow_from_the_threshold():
    for similarity in (0.8, 0.85):
        n = minhash.bands_for(similarity, 4)
        assert (1 - similarity**4) ** n <= 1e-5 < (1 - similarity**4) ** (n - 1)


@pytest.mark.parametrize("table", [WHITE, PUNCTUATION])
def test_words_are_the_same_in_windows_of_any_size(monkeypatch, table):
    texts = ["", None, "a b", "  x", "Ab-c1 é", "n\x00l", "y" * 300 + " z", "\n".join("word%d" % i for i in range(400)), "z"]

    def all_words():
        hashes, counts = [], []
        for _, h, n in hashed_words(pa.array(texts), table):
            hashes += h.tolist()
            counts += n.tolist()
        return hashes, counts

    whole = all_words()
    assert whole[1][5] == (1 if table is WHITE else 2)
    assert whole[1][:4] == [0, 0, 2, 1] and len(whole[0]) == sum(whole[1])
    assert word_hash(["a", "b"]).tolist() == whole[0][:2]
    for window in (1, 7, 64):
        monkeypatch.setattr("roadcast.llm.wordhash.WINDOW", window)
        assert all_words() == whole
