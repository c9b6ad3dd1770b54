"""Every stage against what its operator finds, on its own input."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oracle import connect, differences
from roadcast.llm import exact_dedup, tables
from roadcast.llm.queries import ORACLES, QUERIES
from roadcast.session import path_exists
from test_decontaminate import brute as contaminated
from test_near_dedup import brute as near_groups


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Documents of each stage and its result, on odd rows beside the driver's."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = random.Random(1)
    base = [f"thing{words.randrange(900)}" for _ in range(200)]
    extra = [(9000, None, None, None, None), (9001, "", "en", "s", 0), (9002, "12 34", "en", None, 5)]
    extra += [(9003, " ".join(base), "en", "s", 1), (9004, "  ".join(base), "en", "s", 1)]
    extra += [(9005, " ".join(base[:-1] + ["other"]), "en", "s", 1), (9006, " ".join(base), None, "s", 1)] * 2
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumn("n", F.lit("extra"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    out, current = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, current, folder).write.parquet(f"{folder}/out-{k}")
        result = spark.read.parquet(f"{folder}/out-{k}")
        out[name] = (current, result)
        current = result
    return out


def rows(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_stages_and_columns(stages):
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "decontamination", "best_fit_packing"]
    for docs, result in list(stages.values())[:-1]:
        assert result.columns == docs.columns and result.filter("n <> 'extra'").isEmpty()


def test_language_rejects_what_has_none(stages):
    docs, result = stages["language_id"]
    assert rows(result) == [r for r in rows(docs) if any(c.isalpha() for c in r[1] or "")]


def test_one_row_of_each_text_stays(stages):
    docs, result = stages["exact_dedup"]
    best = {}
    for i, t in rows(docs):
        key = "".join(c for c in t if c not in exact_dedup.SPACE)
        best[key] = min(best.get(key, (0, i, t)), (-len(t), i, t))
    assert rows(result) == sorted(((i, t) for _, i, t in best.values()), key=repr)


def test_one_document_of_each_group_stays(stages):
    docs, result = stages["near_dedup"]
    kept = {r[0] for r in near_groups(rows(docs), 5, 80) if r[3]}
    assert rows(result) == [r for r in rows(docs) if r[0] in kept]
    assert len(kept) < docs.count()


def test_contaminated_documents_go(stages, spark):
    docs, result = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    bad = {r[0] for r in contaminated(rows(docs), items) if r[5]}
    assert rows(result) == [r for r in rows(docs) if r[0] not in bad]


def test_everything_left_is_packed(stages):
    docs, result = stages["best_fit_packing"]
    assert {r.doc_id for r in result.select("doc_id").collect()} == {i for i, _ in rows(docs)}
    fill = result.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.expr("offset + length")).alias("m"))
    assert fill.filter("n <> m or n > 2048").isEmpty()


def test_settled_copies_are_released(spark):
    kept = tables.settle(spark.range(3).toDF("x"), "label")
    (path,) = {f.rsplit("/", 1)[0] for f in kept.inputFiles()}
    assert kept.count() == 3 and path_exists(spark, path)
    tables.release(spark)
    assert not path_exists(spark, path) and not tables._settled


def test_empty_documents(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries(spark, name):
    folder = "/root/testdata/sf0.01"
    found = QUERIES[name](spark, folder).toArrow()
    if name in ORACLES:
        assert differences(found, connect(folder).sql(ORACLES[name]).to_arrow_table()) == []
    else:
        assert found.num_rows >= 1000
