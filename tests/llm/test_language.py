"""Language profiles: held-out accuracy, edge texts, and the algebra of bundles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadcast.llm import language

SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def prototypes(documents):
    return language.learn(documents)


def test_held_out_accuracy(documents, prototypes):
    found = language.classify(documents, prototypes).filter(language.held_out(F.col("doc_id")))
    rows = found.filter("lang is not null").select("lang", "lang_pred", "score").collect()
    assert len(rows) > 250
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_texts_without_letters_are_unknown(spark, prototypes):
    texts = [None, "", " \n", "12 %%% 34", "日", "the that thing", "É" * 60_000, "x́"]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], SCHEMA)
    docs = docs.withColumn("score", F.lit("old")).withColumn("lang_pred", F.lit(3))
    found = {r.doc_id: r for r in language.classify(docs, prototypes).collect()}
    assert [found[i].lang_pred == "und" for i in range(8)] == [True] * 4 + [False] * 4
    assert [found[i].score for i in range(4)] == [0.0] * 4
    assert found[5].lang_pred == "en"
    left = language.keep_known(docs, prototypes)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [4, 5, 6, 7]
    assert left.filter("doc_id = 5").first().score == "old"


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert language.learn(empty) == {}
    assert language.classify(empty, {}).count() == 0
    docs = spark.createDataFrame([(1, "a text", None), (None, "b", None), (1, "a text", None)], SCHEMA)
    assert [(r.lang_pred, r.score) for r in language.classify(docs, language.learn(docs)).collect()] == [("und", 0.0)] * 3


def test_labels_of_held_out_rows_are_not_learned_from(spark):
    rows = [(i, "abc abc", "held" if language_crc(i) % 3 == 1 else "kept") for i in range(40)]
    assert list(language.learn(spark.createDataFrame(rows, SCHEMA))) == ["kept"]


def language_crc(i):
    import zlib

    return zlib.crc32(str(i).encode())


def test_bundles_add_up_and_scores_are_cosines():
    table, space = language._symbols(), language.Space(256)
    texts = ["the cat sat on the mat", "der Hund und die Katze", "le chat est là"]

    def vector(text):
        out = np.zeros(256)
        for gram in language.trigrams(language.symbols_of(text, table)).tolist():
            a, b, c = gram // 4096, gram // 64 % 64, gram % 64
            third = space.third.astype(float)
            out += np.roll(third[a], 2) * np.roll(third[b], 1) * third[c]
        return out

    vectors = np.array([vector(t) for t in texts])
    prototypes = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    langs, scores = language._predict([*texts, "the hat"], space, table, ["en", "de", "fr"], prototypes)
    assert langs[:3] == ["en", "de", "fr"] and np.allclose(scores[:3], 1)
    other = vector("the hat")
    assert np.isclose(scores[3], max(prototypes @ other) / np.linalg.norm(other), atol=1e-5)
