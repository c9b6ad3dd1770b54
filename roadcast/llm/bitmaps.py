"""A bitmap of hashed keys, of bounded size whatever the number of keys.

Rows whose key is in a set pass, and a few others: those whose hash shares a bit. The
table has at most ``BITS / 32768`` rows of 4 KB, 2 MB together, so it can be broadcast
however large the set grows; a full bitmap only stops saving work. Whoever uses it joins
exactly afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

BITS = 1 << 24
_PAGE = 32768  # bits that bitmap_construct_agg packs into one value


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def bitmap(keys: DataFrame, key: str) -> DataFrame:
    """The pages of the bitmap of a column: ``__page``, ``__bits``."""
    return _pages(keys, _place(F.col(key)))


def _pages(keys: DataFrame, place: Column) -> DataFrame:
    return (
        keys.select(F.shiftright(place, 15).alias("__page"), (place % _PAGE).alias("__bit"))
        .groupBy("__page")
        .agg(F.bitmap_construct_agg("__bit").alias("__bits"))
    )


def _marked(rows: DataFrame, key: str, pages: DataFrame) -> DataFrame:
    place = _place(F.col(key))
    bit = (place % _PAGE).cast("int")
    byte = F.substr(F.col("__bits"), F.shiftright(bit, 3) + 1, F.lit(1))
    value = F.call_function("shiftright", F.conv(F.hex(byte), 16, 10).cast("int"), bit % 8)
    return rows.withColumn("__page", F.shiftright(place, 15)).join(
        F.broadcast(pages), "__page", "left"
    ).withColumn("__maybe", F.coalesce(value % 2 == 1, F.lit(False)))


def maybe_in(rows: DataFrame, key: str, pages: DataFrame) -> DataFrame:
    """The rows whose key may be in the bitmap, with their columns unchanged."""
    return _marked(rows, key, pages).filter("__maybe").select(*_columns(rows))


def surely_out(rows: DataFrame, key: str, pages: DataFrame) -> DataFrame:
    """The rows that `maybe_in` leaves."""
    return _marked(rows, key, pages).filter("not __maybe").select(*_columns(rows))


def _columns(rows: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in rows.columns]


def collect_bitmap(keys: DataFrame, key: str) -> bytes:
    """The bitmap of a column of 64-bit hashes as ``BITS / 8`` bytes on the driver, for
    Python tasks. The low bits of a hash are its place."""
    out = bytearray(BITS // 8)
    for row in _pages(keys, F.pmod(F.col(key), F.lit(BITS))).collect():
        start = row["__page"] * (_PAGE // 8)
        out[start : start + _PAGE // 8] = row["__bits"]
    return bytes(out)


def held(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes have their bit in a bitmap of `collect_bitmap`."""
    place = hashes & np.uint64(BITS - 1)
    table = np.frombuffer(bits, np.uint8)
    return (table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
