"""Collocations against a plain count of all n-grams."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadcast.llm import collocations as co
from roadcast.llm.wordscan import scan

SCHEMA = "doc_id long, text string, lang string"


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def brute(rows, longest=5, least=100, top=2000, absorbed=100):
    total, count = Counter(), defaultdict(Counter)
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                count[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in count.items():
        frequent = {p: n for p, n in f.items() if n >= least}
        own = []
        for p, a in frequent.items():
            if len(p) < 2:
                continue
            score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            longer = (g for q, g in frequent.items() if len(q) > len(p)
                      and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if all(100 * g < absorbed * a for g in longer):
                own.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(own)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def corpus():
    rng = random.Random(11)
    words = ["the", "of", "New", "york", "É", "état", "x\x00y", "big", "apple", "is"]
    fixed = ["New York is big", "the état of the art", "of\tthe  of the", "a b c d e f g", "É é"]
    rows = []
    for i in range(900):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choices(words, k=rng.randrange(1, 9)))
                 for _ in range(rng.randrange(9))]
        rows.append((i, rng.choice([". ", "\n", ", ", " ", "\x0b"]).join(parts), rng.choice(["en", "en", "fr", None, "und"])))
    rows += [(1, None, "en"), (2, "", None), (3, "." * 500, "de"), (4, "q" * 60_000, "en"), (5, "go go " * 200, "en")]
    return rows + [rows[7]] * 40


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("options", [{}, {"longest": 3, "least": 20, "top": 4, "absorbed": 80}, {"longest": 2, "least": 30}])
def test_against_brute_force(spark, options):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("print", F.lit(1)).withColumn("fp", F.lit(2)).repartition(5)
    want = brute(rows, **options)
    assert len(want) > 10
    assert result(co.collocations(docs, **options)) == want


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    whole = co.Fingerprints.of

    def few(self, size):
        return whole(self, size) % 3

    monkeypatch.setattr(co.Fingerprints, "of", few)
    rows = corpus()[:300]
    want = brute(rows, least=40)
    assert len(want) > 10
    assert result(co.collocations(spark.createDataFrame(rows, SCHEMA), least=40)) == want


def test_counts_beyond_64_bits(spark):
    f = 10**15
    known = spark.createDataFrame([("en", "a", 1, 3 * f), ("en", "b", 1, 2 * f), ("en", "a b", 2, f)],
                                  "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("en", 9 * 10**16 + 7)], "lang string, n long")
    row = co.scored(known, totals).first()
    assert row.score == 1000 * f * (9 * 10**16 + 7) // (6 * f * f) and (row.l, row.r) == (3 * f, 2 * f)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "too rare to count", "en")]])
def test_nothing_frequent(spark, rows):
    assert result(co.collocations(spark.createDataFrame(rows, SCHEMA))) == []


@pytest.mark.parametrize("run_bytes", [1, 50, 1 << 20])
def test_scanned_words(run_bytes):
    texts = ["One, two", None, "", "  x.y\x00 z", "É\té. ", ".a", "b", " ", "end"]
    got = []
    for words in scan(pa.array(texts), co.TABLE, co.BREAKS, run_bytes):
        exact = words.dictionary()
        spelled = [exact.dictionary[i].as_py().decode() for i in exact.indices.to_pylist()]
        for k in range(len(words.upto) - 1):
            own = slice(words.upto[k], words.upto[k + 1])
            got.append((words.first_row + k, spelled[own], words.after_break[own].tolist()))
    T, N = True, False
    want = [["one", "two"], [], [], ["x", "y\0", "z"], ["É", "é"], ["a"], ["b"], [], ["end"]]
    breaks = [[T, T], [], [], [T, T, N], [T, N], [T], [T], [], [T]]
    assert got == list(zip(range(9), want, breaks))


class Tapped:
    """Stands for a frame and keeps what its tasks are to do."""

    def __init__(self, spark):
        self.sparkSession = spark

    def select(self, *_):
        return self

    def mapInArrow(self, task, schema):
        self.task = task
        return self.sparkSession.createDataFrame([], schema)


def test_a_task_holds_little_beside_its_texts(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(20_000)]
    texts = [" ".join(rng.choices(words, k=1500)) for _ in range(600)]
    common = " ".join(words[:3000])
    rows = {"lang": ["en"] * 900, "text": texts + [common] * 300, "print": [i.to_bytes(16) for i in range(900)]}
    batch = pa.RecordBatch.from_pydict(rows, pa.schema([("lang", "string"), ("text", "string"), ("print", "binary")]))
    every = b"\xff" * (1 << 22)

    def peak(counting, *given):
        docs = Tapped(spark)
        counting(docs, *given)
        tracemalloc.start()
        try:
            rows = sum(found.num_rows for found in docs.task(iter([batch])))
            return rows, tracemalloc.get_traced_memory()[1] / 1e6
        finally:
            tracemalloc.stop()

    mb = batch.nbytes / 1e6
    assert 10 < mb < 20
    rows, most = peak(co.frequent_fingerprints, 2, every, 100)
    assert rows > 800_000 and most < 130
    rows, most = peak(co.occurrences, [every])
    assert rows == 20_001 and most < 80


def test_tasks_that_pass_on_often_lose_nothing(spark, monkeypatch):
    for name, n in {"_RUN": 300, "_WAITING": 40, "_FLUSH": 60, "_WAITING_PHRASES": 30, "_FLUSH_PHRASES": 50}.items():
        monkeypatch.setattr(co, name, n, raising=False)
    rows = corpus()[:300]
    want = brute(rows, least=40)
    assert len(want) > 10
    assert result(co.collocations(spark.createDataFrame(rows, SCHEMA).repartition(2), least=40)) == want


def passed_on(task, texts, tasks):
    """Rows that so many tasks pass on, each with its share of the texts."""
    schema = pa.schema([("lang", "string"), ("text", "string"), ("print", "binary")])
    made = 0
    for k in range(tasks):
        own = texts[k::tasks]
        rows = {"lang": ["en"] * len(own), "text": own, "print": [t.encode()[:16].ljust(16) for t in own]}
        made += sum(found.num_rows for found in task(iter([pa.RecordBatch.from_pydict(rows, schema)])))
    return made


def test_rows_of_all_passes_grow_with_the_texts(spark, monkeypatch):
    """Whatever passes a task runs: a table five times as large, with five times the tasks
    and more phrases that are frequent, makes no more than five times the rows."""
    rng = random.Random(17)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(1000)], k=200)) for _ in range(400)]
    seen = []

    def mapping(self, task, schema, *rest):
        seen.append(task)
        return whole(self, task, schema, *rest)

    frame = type(spark.range(1))
    whole = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", mapping)
    made = {}
    for n in (80, 400):
        seen.clear()
        docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts[:n])], SCHEMA)
        co.frequent_phrases(docs, longest=1, least=20)
        over_texts = [t for t in seen if t.__name__ != "read"]
        made[n] = [passed_on(t, texts[:n], n // 20) for t in over_texts]
    assert len(made[80]) == len(made[400])
    assert all(b <= 6 * a for a, b in zip(made[80], made[400])), made


def test_digests_tell_apart_what_words_do(spark):
    rows = [r for r in corpus() if r[1]]
    docs = co.text_rows(spark.createDataFrame(rows, SCHEMA).repartition(3))
    single = co.frequent_fingerprints(docs, 1, None, 50)
    bits = co._bitmaps(single.filter("n > 0"))
    short = F.shiftrightunsigned("digest", 64 - co._DIGEST_BITS).alias("digest")
    words = co.occurrences(docs, [bits]).groupBy("size", "fp", short).agg(F.sum("n").alias("n")).filter("n >= 50")
    want = sorted(map(tuple, words.filter("size = 1").drop("size").collect()))
    assert len(want) > 10
    assert sorted(map(tuple, single.filter("n > 0").drop("at").collect())) == want
    totals = words.filter("size = 0").agg(F.sum("n")).first()[0]
    assert single.filter("n < 0").agg(F.sum("n")).first()[0] == -totals


def test_texts_with_one_pointer(spark, monkeypatch):
    whole = co.text_rows
    monkeypatch.setattr(co, "text_rows", lambda *given: whole(*given).withColumn("print", F.unhex(F.lit("30" * 16))))
    rows = corpus()[:300]
    want = brute(rows, least=40)
    assert len(want) > 10
    assert result(co.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), least=40)) == want
