"""Packing: ids against the tokenizer, best fit against a plain search, and fill."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadcast.llm import packing
from roadcast.llm.tokens import _FAR, Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"
ODD = [
    "", "don't I'LL it's'tis x²½ 3.14 a\xa0b\x85c", "İstanbul ΟΔΟΣ é H̱", "a\x1cb", "<|endoftext|> x <|START",
    "日本語 text", "é" * 5000, "|| | &&& $$$ %%%", "ŉ ǅ ß ẞ", "it''s 's ''re", "\t\n ", "x" * 2001 + " y", "﻿​zero",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def reference(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_are_those_of_the_library(spark, library):
    encoder = Encoder(PATH, 0)
    assert encoder._merges is not None
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(300).collect()
    for text in ODD + [r.text for r in rows]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == reference(library, text)


def test_plain_characters_alone_in_pairs_and_beside_words(library):
    encoder = Encoder(PATH, 0)
    assert encoder._merges is not None
    plain = [c for c in map(chr, range(0x300)) if not _FAR.search(c)]
    assert len(plain) > 500 and "\u018f" not in plain and "A" in plain
    texts = list(map(chr, range(0x300))) + ["AZ\u018fRBAYCAN", "\u0181\u0190"]
    texts += ["".join(a + b for b in plain) + " " + " ".join(a + b for b in plain) for a in plain]
    for word in ("the", "don't", "x1", "9", "--"):
        texts += [f"{c}{word} {word}{c} {word}{c}{word}" for c in plain]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == reference(library, text), text


def test_every_entry_of_the_vocabulary_comes_out_of_its_own_pair(library):
    """What makes joining by the rank of the whole the same as by the rank of the pair."""
    import json

    model = json.load(open(PATH, encoding="utf-8"))["model"]
    rank = {tuple(m.split(" ") if isinstance(m, str) else m): k for k, m in enumerate(model["merges"])}
    assert len({a + b for a, b in rank}) == len(rank)
    for whole in ("".join(p) for p in rank):
        stem = whole.removesuffix("</w>")
        parts = list(stem)
        if stem != whole:
            parts[-1] += "</w>"
        while len(parts) > 1:
            best = min(((rank.get(p, 1 << 30), i) for i, p in enumerate(zip(parts, parts[1:]))))
            assert best[0] < 1 << 30, whole
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert parts == [whole]


def test_other_files_are_left_to_the_library():
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"), 5)
    assert encoder._merges is None
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = other.encode("Some text", add_special_tokens=False).ids + [5]
    assert np.frombuffer(encoder.encode("Some text"), "<u4").tolist() == want


def packed(spark, rows, capacity=64):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("length", F.lit("x"))
    parts = packing.pieces(docs, PATH, capacity, with_ids=True)
    return packing.pack(parts, capacity, open_sequences=8).collect()


def test_pieces_and_places(spark, library):
    rows = list(enumerate(ODD + [None, "word " * 300])) + [(0, ""), (None, "null id")]
    found = packed(spark, rows)
    texts = dict(rows[:-1]) | {None: "null id"}
    by_doc = {}
    for r in found:
        ids = np.array(r.ids, "<u4")
        assert (len(ids), zlib.crc32(ids.tobytes())) == (r.length, r.ids_crc32)
        by_doc.setdefault(r.doc_id, []).append(r)
    assert len(by_doc.pop(0)) == 2
    for doc, own in by_doc.items():
        own.sort(key=lambda r: r.piece)
        assert [i for r in own for i in r.ids] == reference(library, texts[doc])
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == [64 * k for k in range(len(own))]
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64


def test_the_same_input_gives_the_same_sequences(spark):
    rows = [(i, "w " * (i % 50)) for i in range(500)]
    assert sorted(map(tuple, packed(spark, rows)), key=repr) == sorted(map(tuple, packed(spark, rows[::-1])), key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert packing.pack(packing.pieces(docs, PATH)).count() == 0


@pytest.mark.parametrize("limit", [3, 1000])
def test_best_fit_against_a_plain_search(limit):
    rng = random.Random(limit)
    bins, free = packing.BestFit(100, limit), {}
    for _ in range(3000):
        length = rng.randrange(1, 101)
        fits = [f for f in free.values() if f >= length]
        number, offset = bins.place(length)
        if fits:
            assert free[number] == min(fits) and offset == 100 - free[number]
        else:
            assert offset == 0 and number not in free
            if len(free) == limit:
                fullest = min(free.values())
                closed = [n for n, f in free.items() if f == fullest and n not in {x for s in bins.by_free for x in s}]
                assert len(closed) == 1
                del free[closed[0]]
            free[number] = 100
        free[number] -= length
        if not free[number]:
            del free[number]
        assert bins.open == len(free) <= limit


def test_sequences_are_nearly_full(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    row = packing.pack(packing.pieces(docs, PATH)).selectExpr(
        "sum(length) as tokens", "count(distinct sequence_id) as n"
    ).first()
    assert row.n <= 1.01 * row.tokens / 2048 + 1
