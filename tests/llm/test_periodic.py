"""Periodic runs against all shifts of every text, and the transforms they come from."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadcast.llm import periodic

SCHEMA = "doc_id long, text string"


def brute(words):
    """(start, length, period) of every run, by start and then period."""
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        k = 0
        while k < n - p:
            s = k
            while k < n - p and words[k] == words[k + p]:
                k += 1
            if k - s + p >= max(24, 3 * p):
                found.setdefault((s, k - s + p), p)
            k += 1
    return sorted((s, length, p) for (s, length), p in found.items())


def some_words(rng):
    n, kind = rng.randrange(400), rng.random()
    if kind < 0.1:
        return ["same"] * n
    if kind < 0.3:
        return [rng.choice("ab") for _ in range(n)]
    if kind < 0.4:
        a, b = ["a"], ["a", "b"]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    out = []
    while len(out) < n:
        base = [f"w{rng.randrange(rng.choice([2, 3, 50]))}" for _ in range(rng.randrange(1, 40))]
        if rng.random() < 0.4:
            base = base * rng.randrange(1, 4) + ["x"]
        out += (base * rng.randrange(1, 12))[: rng.randrange(1, 300)]
        if rng.random() < 0.5:
            out += [f"y{rng.randrange(50)}" for _ in range(rng.randrange(30))]
    return out[:n]


def numbered(texts):
    names = {}
    codes = [names.setdefault(w, len(names)) for t in texts for w in t]
    return np.array(codes, np.int64), np.cumsum([0] + [len(t) for t in texts])


def found_in(texts):
    codes, begins = numbered(texts)
    out = [[] for _ in texts]
    for s, e, p in zip(*periodic.runs_in(codes, begins)):
        k = int(np.searchsorted(begins, s, "right")) - 1
        out[k].append((int(s - begins[k]), int(e - s), int(p)))
    return out


@pytest.mark.parametrize("largest", [4, 1 << 18])
def test_runs_against_all_shifts(monkeypatch, largest):
    monkeypatch.setattr(periodic, "_LARGEST_BLOCK", largest)
    rng = random.Random(largest)
    for _ in range(25):
        texts = [some_words(rng) for _ in range(rng.randrange(1, 25))]
        assert found_in(texts) == [brute(t) for t in texts]


def test_chance_hits_change_nothing(monkeypatch):
    """With residues modulo the prime that nearly all agree, every distance is a seed."""
    rng = random.Random(4)
    texts = [some_words(rng) for _ in range(20)]
    search = periodic._Search.__init__

    def blurred(self, codes, begins):
        search(self, codes, begins)
        self.values = self.values % np.uint64(2)

    monkeypatch.setattr(periodic._Search, "__init__", blurred)
    assert found_in(texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("size", [1, 2, 4, 32])
def test_differences_are_exact(size):
    rng = np.random.default_rng(size)
    blocks = rng.integers(0, periodic.PRIME, (5, size)).astype(np.uint64)
    windows = rng.integers(0, periodic.PRIME, (5, 2 * size)).astype(np.uint64)
    found = periodic.differences(blocks, windows)
    for b, w, f in zip(blocks.tolist(), windows.tolist(), found.tolist()):
        assert f == [sum((x - y) ** 2 for x, y in zip(b, w[k:])) % periodic.PRIME for k in range(size)]
    roots = periodic._powers(pow(31, (periodic.PRIME - 1) // (2 * size), periodic.PRIME), size)
    back = periodic._powers(pow(int(pow(31, (periodic.PRIME - 1) // (2 * size), periodic.PRIME)), -1, periodic.PRIME), size)
    assert (periodic.inverse(periodic.transform(windows, roots), back) == windows).all()


def expected(doc_id, text, rewrite):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if rewrite and doc_id is not None and words:
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        if h % 10 == 0:
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    left = " ".join(w for k, w in enumerate(words) if k not in gone)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    digest = hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest()
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, digest, hashlib.sha256(left.encode()).hexdigest())


@pytest.mark.parametrize("rewrite", [None, periodic.planted])
def test_query_against_brute_force(spark, rewrite):
    rng = random.Random(6)
    texts = [" ".join(some_words(rng)) for _ in range(60)]
    texts += [" ".join(f"u{rng.randrange(5000)}" for _ in range(rng.randrange(1, 300))) for _ in range(60)]
    texts += [None, "", " \n", "a\x00b " * 30, "É é \x0b" * 20, "x" * 60_000, "ab\tAB\n" * 40, "one two " * 3000]
    rows = list(enumerate(texts)) + [(3, texts[5]), (None, "z " * 40), (None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("runs", F.lit(1)).withColumn("best", F.lit("x")).repartition(3)
    found = periodic.report(periodic.periodic_runs(docs, rewrite=rewrite))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                             "collapsed_sha256"]
    want = [expected(i, t, rewrite) for i, t in rows if t != "one two " * 3000]
    got = [tuple(r) for r in found.collect()]
    long_id = texts.index("one two " * 3000)
    if rewrite is None:
        assert [r[2:6] for r in got if r[0] == long_id] == [(0, 6000, 2, 3_000_000)]
    assert sorted([r for r in got if r[0] != long_id], key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in got) > 20


def test_runs_and_text_of_the_operator(spark):
    docs = spark.createDataFrame([(1, "say " + "la di  da " * 9 + "end")], SCHEMA)
    row = periodic.periodic_runs(docs).first()
    assert [tuple(r) for r in row.runs] == [(1, 27, 3)] and row.collapsed == "say la di da end"


def test_empty_table(spark):
    assert periodic.report(periodic.periodic_runs(spark.createDataFrame([], SCHEMA))).count() == 0
