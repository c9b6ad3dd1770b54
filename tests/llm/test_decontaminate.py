"""Benchmark passages against brute force over all windows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from roadcast.llm import decontaminate as dc
from roadcast.llm.bitmaps import collect_bitmap

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(docs, items):
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for item, passage in items:
            asked = words(passage)
            k = min(13, len(asked))
            if not k:
                continue
            for i in range(len(asked) - k + 1):
                for j in range(len(own) - k + 1):
                    if own[j : j + k] == asked[i : i + k]:
                        hit.update(range(j, j + k))
                        found.update(() if item is None else (item,))
        ids = ",".join(sorted(map(str, found)))
        out.append((doc, len(own), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "of", "é1"]

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = [(i, " ".join(prose(rng.randrange(5, 40)))) for i in range(20)]
    items += [(30, "short one"), (31, "short one"), (32, None), (33, "!?"), (None, "w1 w2"), (None, " ".join(prose(20))), (34, "the the the the")]
    docs = [(1, None), (2, ""), (3, "--"), (4, "Short-ONE"), (5, "the " * 30), (6, "x" * 60_000)]
    for i in range(10, 60):
        own = prose(rng.randrange(1, 200))
        for _ in range(rng.randrange(3)):
            passage = words(rng.choice(items)[1])
            cut = rng.randrange(len(passage) + 1) if passage else 0
            at = rng.randrange(len(own) + 1)
            own[at:at] = passage[:cut] if rng.random() < 0.5 else passage
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(own)))
    docs += [docs[-1], (None, items[0][1]), (None, "nothing"), (59, "other text with the same id")]
    return docs, items


def test_against_brute_force(spark, tables):
    docs, items = tables
    frame = spark.createDataFrame(docs, DOCS).withColumn("print", F.lit(0)).withColumn("item", F.lit("x"))
    found = dc.contamination(frame, spark.createDataFrame(items, ITEMS)).drop("print")
    assert sorted(map(tuple, found.collect()), key=repr) == brute(docs, items)


def test_clean_documents_stay(spark, tables):
    docs, items = tables
    frame = spark.createDataFrame(docs, DOCS).withColumn("print", F.lit(0)).withColumn("doc", F.lit("x"))
    left = dc.keep_clean(frame, spark.createDataFrame(items, ITEMS))
    assert left.columns == frame.columns
    want = [d for d in docs if not brute([d], items)[0][5]]
    assert sorted([(r.doc_id, r.text) for r in left.collect()], key=repr) == sorted(want, key=repr)


def test_two_texts_under_one_id(spark):
    texts = [" ".join(f"{w}{k}" for k in range(20)) for w in "abc"]
    items = [(1, texts[0]), (1, texts[1]), (2, texts[1]), (2, texts[2])]
    docs = [(i, t) for i, t in enumerate([*texts, " ".join(texts), "nothing of it", texts[2][:40]])]
    frame, known = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    found = dc.contamination(frame, known).drop("print")
    assert sorted(map(tuple, found.collect()), key=repr) == brute(docs, items)
    assert {r.doc_id for r in dc.keep_clean(frame, known).collect()} == {4, 5}


def test_passages_without_an_id_count(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    docs, items = [(1, f"so {passage} it is"), (2, "clean")], [(None, passage)]
    frame, known = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    found = sorted(dc.contamination(frame, known).collect())
    assert [(r.n_hit, r.n_items, r.contaminated) for r in found] == [(20, 0, True), (0, 0, False)]
    assert [r.doc_id for r in dc.keep_clean(frame, known).collect()] == [2]


def test_empty_tables(spark, tables):
    docs, items = tables
    none, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert dc.contamination(none, spark.createDataFrame(items, ITEMS)).count() == 0
    found = dc.contamination(spark.createDataFrame(docs, DOCS), no_items).collect()
    assert len(found) == len(docs) and not any(r.contaminated for r in found)


@pytest.mark.parametrize("slack", [0, 2])
def test_proximity(spark, slack):
    item = "alpha beta gamma delta"
    texts = ["alpha beta gamma delta", "alpha x beta gamma delta", "x alpha y y beta", "beta alpha", "alpha beta"]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    known = dc.distinct_items(spark.createDataFrame([(7, item)], ITEMS), "text")
    counts = spark.createDataFrame([], "term long, n long")
    probing = dc.probes(known, counts).cache()  # no term was counted: the first two are the rarest
    index = dc.build_index(docs, collect_bitmap(probing, "term"), "doc_id", "text")
    found = {(r.doc_id, r.first, r.second) for r in dc.near_matches(index, probing, slack).collect()}
    want = set()
    for i, text in enumerate(texts):
        own = text.split()
        for a, first in enumerate(own):
            for b, second in enumerate(own):
                if (first, second) == ("alpha", "beta") and abs((b - a) - 1) <= slack:
                    want.add((i, a, b))
    assert found == want


def test_probes_are_the_rarest_of_each_window(spark):
    known = dc.distinct_items(spark.createDataFrame([(1, "a b c d")], ITEMS), "text").cache()
    terms = known.first().terms
    counts = spark.createDataFrame(list(zip(terms, [5, 1, 9, 2])), "term long, n long")
    found = dc.probes(known, counts, window=2).collect()
    assert {(r.probe, r.probe_end) for r in found} == {(0, 1), (1, 2), (2, 3)}
    found = dc.probes(known, counts, window=4).collect()
    assert {(r.offset, r.term) for r in found} == {(1, terms[1]), (3, terms[3])}
