"""Archives: the way there and back, frames on their own, edge rows."""

import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from roadcast.llm import warc

SCHEMA = "page_id long, url string, html string"
LONG = "<p>" + "many words and é😀 " * 80 + "</p>"
ROWS = [
    (1, "http://a.example/x y\r\nz", LONG),
    (2, None, LONG),
    (3, "http://b.example/é", "short"),
    (4, "u", "short"),
    (5, "u", None),
    (6, "u", ""),
    (7, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" + "x" * 2000),
    (8, "u", "y" * 999),
    (9, "u", "y" * 999),
    (10, "u", "z" * 1000),
    (11, "u", "z" * 1000),
    (None, "u", "z" * 1000),
    (11, "again", "z" * 1000),
    (12, "u", "é" * 400_000),
    (None, "u", "n" * 2000),
    (None, "u", "n" * 2000),
]


def want(rows):
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if h == html and p is not None]
        best = max(same, default=None) if len(body) >= 1000 else page
        refers = best if best != page else None
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("raw", [1 << 20, 3000])
def test_there_and_back(spark, tmp_path, monkeypatch, raw):
    monkeypatch.setattr(warc, "RAW_BYTES", raw)
    pages = spark.createDataFrame(ROWS, SCHEMA).withColumn("refers_to", F.lit("x")).withColumn("payload", F.lit(1))
    manifest = warc.write_archives(pages, f"file:{tmp_path}/archives")
    assert manifest.agg(F.sum("records")).first()[0] == len(ROWS)
    rows = warc.read_archives(manifest, with_payload=True).collect()

    def number(text):
        return None if text is None else int(text)

    found = [(number(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in rows]
    assert sorted(found, key=repr) == want(ROWS)
    bodies = {(number(r.page_id), bytes(r.payload).decode()) for r in rows if r.payload is not None}
    assert bodies == {(p, h or "") for (p, _, h), w in zip(ROWS, [None] * len(ROWS)) if (p, h) not in {(1, LONG), (10, "z" * 1000)} and not (p is None and h[0] == "z")}


def test_a_dictionary_opens_the_archive_and_each_record_is_a_frame(spark, tmp_path):
    rows = [(i, f"http://a.example/{i}", f"<html><body>page number {i} " + "common text " * 30 + "</body></html>") for i in range(400)]
    manifest = warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), f"file://{tmp_path}/w")
    (row,) = manifest.collect()
    data = open(row.archive.removeprefix("file://"), "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and data[8:12] == struct.pack("<I", 0xEC30A437)
    learned = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    rest, records = data[8 + size :], []
    while rest:
        one = zstandard.ZstdDecompressor(dict_data=learned).decompressobj()
        records.append(one.decompress(rest))
        rest = one.unused_data
    assert len(records) == 400 and all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    plain = sum(len(zstandard.compress(r)) for r in records)
    assert len(data) - size < plain / 2


def test_damage_is_noticed(tmp_path):
    record = warc._record("1", "u", b"payload", None, "1970-01-01T00:00:00Z")
    assert warc._read_record(record)[2:5] == (7, hashlib.sha1(b"payload").hexdigest(), "response")
    with pytest.raises(ValueError):
        warc._read_record(record.replace(b"payload\r\n", b"paYload\r\n"))


def test_empty_table(spark, tmp_path):
    manifest = warc.write_archives(spark.createDataFrame([], SCHEMA), f"file:{tmp_path}/none")
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0
