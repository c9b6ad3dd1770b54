"""WARC archives of pages: records compressed one by one with a dictionary of their own.

An archive is a ``.warc.zst`` file. A Zstandard dictionary built from its records opens
it in a skippable frame; each record follows as a frame of its own, so that one can be
read without the others. Of records with equal payloads one is the response, the others
are revisits that refer to it.

A task writes archives of bounded size under names no other attempt uses. The manifest
it returns is kept by Spark's own commit, so records of a failed or repeated attempt
are never listed; reading goes by the manifest.

Defined results: a null page is an empty payload, a null address an empty one. Rows that
repeat a page id get a record each; they never refer to their own id. A null id never
becomes the one referred to unless all ids are null, and then all are responses. Other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadcast.llm.tables import in_small_batches, settle
from roadcast.session import scratch_path

RAW_BYTES = 16 << 20  # of records in one archive, unless a single one is larger
DICTIONARY_BYTES = 32 << 10
TRAINING_BYTES = 4 << 20  # of evenly spaced records that the dictionary is built from
LEVEL = 3
SMALLEST_REVISIT = 1000

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
REVISIT_PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"


def revisits(
    pages: DataFrame, id_col: str, html_col: str, smallest: int = SMALLEST_REVISIT
) -> DataFrame:
    """Which records refer to which: ``page_id, payload, refers_to``, a row per pair of
    id and payload. Only numbers and digests are shuffled."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = (
        pages.filter(F.octet_length(payload) >= smallest)
        .select(F.col(id_col).alias("page_id"), F.sha2(payload, 256).alias("payload"))
        .distinct()
    )
    first = rows.groupBy("payload").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    return (
        rows.join(first.filter("n > 1"), "payload")
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "payload", "refers_to")
    )


def _open(uri: str):
    """The file system of a place that any executor can reach, and the path there."""
    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:])


def _record(page: str, url: str, payload: bytes, refers_to: str | None, date: str) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{ID_PREFIX}{page}>",
        f"WARC-Date: {date}",
        # Only what may stand in a header line; the address can be had back by unquoting.
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]):
    """A dictionary from evenly spaced records; their own bytes where they are too few
    or too alike to learn from."""
    import zstandard

    total = sum(map(len, records))
    step = max(1, -(-total // TRAINING_BYTES))
    samples = [r[:TRAINING_BYTES] for r in records[::step]]
    if len(samples) >= 16:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
        except zstandard.ZstdError:
            pass
    raw = b"".join(samples)[-DICTIONARY_BYTES:]
    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _write(folder: str, records: list[bytes]) -> tuple[str, int, int]:
    import zstandard

    learned = _dictionary(records)
    content = learned.as_bytes()
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=learned)
    uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
    files, path = _open(uri)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    written = 0
    with files.open_output_stream(path, compression=None) as out:
        for part in [struct.pack("<II", SKIPPABLE, len(content)), content, *map(packer.compress, records)]:
            out.write(part)
            written += len(part)
    return uri, len(records), written


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per page into archives under ``folder``, which all executors must
    reach. Returns the manifest, already kept: ``archive, records, bytes``."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        payload.alias("html"),
    )
    again = revisits(pages, id_col, html_col).alias("a")
    joined = rows.alias("r").join(
        again,
        F.col("r.page_id").eqNullSafe(F.col("a.page_id")) & (F.sha2("r.html", 256) == F.col("a.payload")),
        "left",
    )
    text = [F.col(c).cast("string") for c in ("r.page_id", "a.refers_to")]
    records = joined.select(text[0], "r.url", "r.html", text[1])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, done = [], 0, []
        for batch in batches:
            for row in zip(*(c for c in batch.columns)):
                page, url, html, refers = (v.as_py() for v in row)
                record = _record(page or "", url, html, refers, date)
                if held and size + len(record) > RAW_BYTES:
                    done.append(_write(folder, held))
                    held, size = [], 0
                held.append(record)
                size += len(record)
        if held:
            done.append(_write(folder, held))
        if done:
            columns = [pa.array(c) for c in zip(*done)]
            yield pa.RecordBatch.from_arrays(columns, ["archive", "records", "bytes"])

    manifest = in_small_batches(records).mapInArrow(write, "archive string, records long, bytes long")
    return settle(manifest, "warc-manifest")


_HEADER = re.compile(rb"(?im)^([A-Za-z-]+):[ ]*(.*?)\r$")


def _frames(stream) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    import zstandard

    magic, size = struct.unpack("<II", stream.read(8))
    if magic != SKIPPABLE:
        raise ValueError("an archive must open with its dictionary")
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(size)))
    rest, frame, out = b"", None, []
    while True:
        data = rest or stream.read(1 << 16)
        if not data:
            if frame is not None:
                raise ValueError("an archive ends inside a record")
            return
        frame = frame or unpacker.decompressobj()
        out.append(frame.decompress(data))
        rest = frame.unused_data if frame.eof else b""
        if frame.eof:
            yield b"".join(out)
            frame, out = None, []


def _read_record(record: bytes) -> tuple:
    head, _, body = record.partition(b"\r\n\r\n")
    fields = {k.lower(): v.decode() for k, v in _HEADER.findall(head + b"\r\n")}
    block = body[: int(fields[b"content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(_HEADER.findall(http + b"\r\n"))[b"Content-Length"])
    digest = base64.b32decode(fields[b"warc-payload-digest"].removeprefix("sha1:")).hex()
    kind = fields[b"warc-type"]
    if kind == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (length, digest):
        raise ValueError(f"a damaged payload in {fields[b'warc-record-id']}")
    own, other = (
        fields.get(k, "").strip("<>").removeprefix(ID_PREFIX) or None
        for k in (b"warc-record-id", b"warc-refers-to")
    )
    return own, fields[b"warc-target-uri"], length, digest, kind, other, payload if kind == "response" else None


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the listed archives: ``page_id`` and ``refers_to`` as text,
    ``url`` as written, ``payload_bytes, payload_digest, record_type`` and, if asked for,
    ``payload``, null for revisits. A damaged payload is an error."""
    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    if with_payload:
        schema, names, types = schema + ", payload binary", [*names, "payload"], [*types, pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                files, path = _open(uri)
                rows, size = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for record in _frames(stream):
                        rows.append(_read_record(record)[: len(names)])
                        size += len(record)
                        if size > RAW_BYTES:
                            yield _batch(rows, names, types)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows, names, types)

    archives = max(1, manifest.count())
    return manifest.select("archive").repartition(archives, "archive").mapInArrow(read, schema)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(columns, names)


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder in the shared place."""
    return scratch_path(spark, "warc")
