"""The quality classifier: held-out accuracy, odd labels, and the descent's optimum."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadcast.llm import quality

DOCS = "doc_id long, text string"
LABELS = "doc_id long, quality int"


@pytest.fixture(scope="module")
def scored(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.score(docs, quality.fit(docs, labels))
    return found.join(labels, "doc_id").filter(quality.held_out(F.col("doc_id"))).toPandas()


def test_held_out_accuracy(scored):
    good = scored.quality == 1
    assert len(scored) > 900
    assert ((scored.predicted == 1) == good).mean() > 0.95
    ranks = scored.score.rank()
    area = (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert area > 0.985
    assert scored.score.between(0, 1).all() and ((scored.score >= 0.7) == (scored.predicted == 1)).all()


def test_edges(spark):
    good, bad = "a fine and varied line of prose number {}", "junk### junk### junk### {}"
    rows = [(i, (good if i % 2 else bad).format(i)) for i in range(120)]
    labels = [(i, i % 2) for i in range(100)] + [(1, 1), (3, 0), (5, None), (None, 1), (7000, 1)]
    rows += [(200, None), (201, ""), (None, good), (202, "é" * 50_000), (1, good.format(1))]
    docs = spark.createDataFrame(rows, DOCS).withColumn("label", F.lit("x")).withColumn("score", F.lit(9))
    model = quality.fit(docs, spark.createDataFrame(labels, LABELS).withColumn("text", F.lit("l")))
    found = quality.score(docs, model).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert by_id[200].score == by_id[201].score
    assert by_id[111].score > by_id[110].score
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)


@pytest.mark.parametrize("labels, want", [([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0)])
def test_too_little_to_learn_from(spark, labels, want):
    docs = spark.createDataFrame([(i, "x y") for i in range(4)], DOCS)
    usable = [r for r in labels]
    found = quality.score(docs, quality.fit(docs, spark.createDataFrame(usable, LABELS))).collect()
    assert all(abs(r.score - want) < 1e-9 for r in found)
    assert quality.score(docs.limit(0), quality.fit(docs, spark.createDataFrame([], LABELS))).count() == 0


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 6))
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=80) > 0, 1.0, -1.0)
    cost = np.full(80, 0.7)
    own = [np.arange(6)] * 80
    w, bias = quality.descend(own, list(x), y, 6, cost, rounds=500)

    def objective(w, bias):
        slack = np.maximum(0, 1 - y * (x @ w + bias))
        return 0.5 * (w @ w + bias**2) + (cost * slack**2).sum()

    best = objective(w, bias)
    for _ in range(300):
        assert objective(w + 1e-2 * rng.normal(size=6), bias + 1e-2 * rng.normal()) >= best - 1e-5


def test_features_are_indicators_over_whole_texts():
    text = "One two  two"
    found = list(quality.features(pa.array([text, None, text + " " + text, "z" * 9])))
    assert all(len(f) == len(set(f.tolist())) for f in found)
    assert set(found[0].tolist()) <= set(found[2].tolist())
    assert len(found[1]) == 0
    long = "ab " * 400_000
    assert set(list(quality.features(pa.array([long])))[0].tolist()) == set(
        list(quality.features(pa.array(["ab " * 20])))[0].tolist()
    )
