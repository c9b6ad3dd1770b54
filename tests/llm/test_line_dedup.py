"""Line dedup against a plain version, and its bitmaps."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from roadcast.llm import line_dedup

SCHEMA = "doc_id long, text string"


def key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, least=20, docs=3):
    held = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                held[key(line)].add(doc)
    last = {k: max(d for d in ds if d is not None) for k, ds in held.items() if len(ds) >= docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(3)
    shared = [f"Shared line number {i} of the corpus É" for i in range(12)] + ["short", "x" * 19, "y" * 20, "é" * 20]
    rows = []
    for i in range(120):
        lines = [rng.choice(["", " ", "\t"]) + rng.choice(shared + [f"own {i} line {k} with some length"])
                 + rng.choice(["", " ", "\r", "\x0b"]) for k in range(rng.randrange(14))]
        rows.append((i, "\n".join(x.upper() if rng.random() < 0.2 else x for x in lines)))
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "z" * 50_000 + "\n" + shared[0] + "\n" + shared[0])]
    rows += [(i, "a line that every one of them does hold\nrest %d" % i) for i in range(300, 360)]
    rows += [rows[5], (6, "same id, other text\n" + shared[1]), (None, shared[0]), (None, shared[2] + "\n" + shared[0])]
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("print", F.lit(1)).withColumn("h", F.lit("x"))
    docs = docs.withColumn("__keep", F.lit("y")).repartition(5)
    want = brute(rows)
    assert sum(w[2] for w in want) > 200
    found = [tuple(r) for r in line_dedup.report(docs).collect()]
    hashed = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in want]
    assert sorted(found, key=repr) == sorted(hashed, key=repr)
    left = line_dedup.deduplicated(docs)
    assert left.columns == docs.columns
    got = sorted([(r.doc_id, r.text or "") for r in left.collect()], key=repr)
    assert got == sorted([(w[0], w[3]) for w in want], key=repr)
    assert [r.text for r in left.collect() if r.doc_id == 200] == [None]


def test_other_limits(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {(r.doc_id, r.n_dropped) for r in line_dedup.report(docs, least_chars=5, least_documents=2).collect()}
    assert found == {(w[0], w[2]) for w in brute(rows, 5, 2)}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "a" * 30)] * 4])
def test_edges(spark, rows):
    found = line_dedup.report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.n_lines, r.n_dropped) for r in found] == [(1, 0)] * len(rows)


def test_bitmaps_read_back_and_are_short(spark):
    rng = random.Random(9)
    cases = [(1, []), (1, [0]), (5, [0, 4]), (300, list(range(100, 290))), (70_000, [65_000]), (9, list(range(9))),
             (3_000_000, [127, 128, 16_383, 16_384, 2_500_000])]
    cases += [(200, sorted(rng.sample(range(200), rng.randrange(200)))) for _ in range(20)]
    frame = spark.createDataFrame(cases, "n int, dropped array<int>").repartition(4)
    bits = line_dedup.keep_bitmap(F.col("n"), F.col("dropped"))
    for r in frame.select("n", "dropped", bits.alias("b")).select("*", line_dedup.kept_runs(F.col("b")).alias("r")).collect():
        gone, at, runs = set(r.dropped), 0, []
        for end in [*sorted(gone), r.n]:
            if end > at:
                runs.append((at, end - at))
            at = end + 1
        assert [tuple(x) for x in r.r] == runs
        assert len(r.b) <= 10 * len(runs)


def test_a_line_of_many_documents_is_spread(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("the very same line in all of them").alias("text"))
    keyed = line_dedup.keyed_lines(rows, "doc_id", "text", 20)
    sizes = keyed.select("h", "doc_id", "pos").repartitionByRange(8, "h", "doc_id").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in sizes.collect()) < 1500
    plan = line_dedup.repeated_keys(keyed, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "rangepartitioning" in plan
