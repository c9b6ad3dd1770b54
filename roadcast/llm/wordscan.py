"""Words of Arrow text columns with their places, over byte buffers.

Beside `wordhash`, which only gives hashes, for operators that need a word's bytes or the
pieces that words stand in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from roadcast.llm.wordhash import _window_hashes

RUN_BYTES = 2 << 20


def byte_table(separators: bytes, lower: bool) -> np.ndarray:
    """Each byte, A-Z lower-cased if asked for, or 0 for one between words. NUL inside
    words counts as 255, a byte that no text in UTF-8 holds."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[0] = 255
    table[list(separators)] = 0
    table.flags.writeable = False
    return table


@dataclass
class Words:
    """Words of the rows from ``first_row`` on, one row behind another. ``upto``: number
    of words up to each row's end, from 0. ``starts`` and ``ends`` are places in ``low``."""

    first_row: int
    low: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    upto: np.ndarray
    hashes: np.ndarray
    after_break: np.ndarray  # whether a word stands behind a break

    def dictionary(self) -> pa.DictionaryArray:
        """The words themselves, each with its number among the distinct ones."""
        size = self.ends - self.starts
        offsets = np.concatenate(([0], np.cumsum(size)))
        data = self.low[self.low != 0]
        data[data == 255] = 0
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.large_binary(), len(size), buffers).dictionary_encode()


def scan(column: pa.Array, table: np.ndarray, breaks: bytes = b"", run_bytes: int = RUN_BYTES) -> Iterator[Words]:
    """Runs of whole rows of a text column, of about ``run_bytes`` each. Null texts have
    no words. ``breaks`` are separators that also end a piece; so does a text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    breaking = np.zeros(256, bool)
    breaking[list(breaks)] = True
    row = 0
    while row < len(column):
        upto = int(np.searchsorted(ends, ends[row] + run_bytes, "right")) - 1
        upto = min(max(upto, row + 1), len(column))
        raw = data[ends[row] : ends[upto]]
        begins = ends[row : upto + 1] - ends[row]
        yield _words(row, raw, table, begins, breaking)
        row = upto


def _words(row: int, raw: np.ndarray, table: np.ndarray, begins: np.ndarray, breaking: np.ndarray) -> Words:
    low = table[raw]
    if not len(low):
        none = np.empty(0, np.int64)
        return Words(row, low, none, none, np.zeros(len(begins), np.int64), none.view(np.uint64), none.astype(bool))
    texts = begins[:-1][begins[:-1] < len(low)]
    hashes, starts = _window_hashes(low, texts)
    inside = low != 0
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[texts[1:] - 1] |= inside[texts[1:] - 1]
    ends = np.flatnonzero(last) + 1
    broken = breaking[raw]
    broken[texts] = True  # where a text begins with a word, the word stands behind a break
    count = np.cumsum(broken)
    at = count[starts]
    after = np.ones(len(starts), bool)
    after[1:] = at[1:] != at[:-1]
    return Words(row, low, starts, ends, np.searchsorted(starts, begins), hashes, after)
