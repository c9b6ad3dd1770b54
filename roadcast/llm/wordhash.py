"""Words of whole Arrow text columns as 64-bit hashes, computed over byte buffers.

A word is a longest run of word bytes; A-Z count as a-z. The patterns here never split a
UTF-8 sequence, so bytes give the same words as characters. Texts are taken in windows
of about a megabyte that end between words, so that memory does not grow with a batch or
a text beyond eight bytes a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WINDOW = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _table(separators: bytes) -> np.ndarray:
    """Each byte lower-cased, or 0 for one between words. NUL inside words counts as 255,
    a byte that no text in UTF-8 holds."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[0] = 255
    for b in separators:
        table[b] = 0
    table.flags.writeable = False
    return table


# Between words: ASCII white space; everything ASCII but letters and digits.
WHITE = _table(b" \t\n\x0b\x0c\r")
PUNCTUATION = _table(bytes(b for b in range(128) if not chr(b).isalnum()))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_SHORT = _powers(64)


def _window_hashes(low: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start bytes of the words of a window. ``breaks``: where texts begin."""
    inside = low != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[breaks] = inside[breaks]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    gaps = np.diff(starts, append=len(low))
    place = np.arange(len(low)) - np.repeat(starts, gaps)[: len(low)] if starts[0] == 0 else None
    if place is None:
        place = np.zeros(len(low), np.int64)
        place[starts[0] :] = np.arange(starts[0], len(low)) - np.repeat(starts, gaps)
    # Runs of separators may be long, words rarely are: places count only inside words.
    place *= inside
    longest = int(place.max()) + 1
    powers = _SHORT if longest <= len(_SHORT) else _powers(longest)
    sums = np.add.reduceat(low.astype(np.uint64) * powers[place], starts)
    return mix64(sums), starts


def _cut(low: np.ndarray, at: int) -> int:
    """The next place from ``at`` on that lies between words."""
    while at < len(low):
        zeros = np.flatnonzero(low[at : at + 4096] == 0)
        if len(zeros):
            return at + int(zeros[0])
        at += 4096
    return len(low)


def hashed_words(column: pa.Array, table: np.ndarray):
    """For runs of rows of a text column: (first row, hashes, words per row).

    Null texts have no words. ``hashes`` are of all words of the rows, one row behind
    another.
    """
    if column.type not in (pa.string(), pa.binary()):
        column = column.cast(pa.string())
    if not len(column):
        return
    column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        upto = int(np.searchsorted(ends, ends[row] + WINDOW, "right")) - 1
        upto = min(max(upto, row + 1), len(column))
        raw = data[ends[row] : ends[upto]]
        if not len(raw):
            yield row, np.empty(0, np.uint64), np.zeros(upto - row, np.int64)
        elif upto == row + 1:
            parts, begin = [], 0
            while begin < len(raw):
                # Only as much of the text as the window holds is lower-cased at a time.
                stop = begin + WINDOW
                if stop < len(raw):
                    stop += _cut(table[raw[stop : stop + WINDOW]], 0)
                    while stop < len(raw) and table[raw[stop]]:
                        stop += _cut(table[raw[stop : stop + WINDOW]], 0)
                low = table[raw[begin:stop]]
                parts.append(_window_hashes(low, np.zeros(1, np.int64))[0])
                begin = stop
            hashes = np.concatenate(parts)
            yield row, hashes, np.array([len(hashes)])
        else:
            begins = ends[row:upto] - ends[row]
            low = table[raw]
            hashes, starts = _window_hashes(low, begins[begins < len(low)])
            bounds = np.searchsorted(starts, np.append(begins, len(low)))
            yield row, hashes, np.diff(bounds)
        row = upto


def word_hash(words: list[str]) -> np.ndarray:
    """Hashes of single words, as `hashed_words` gives them."""
    if not words:
        return np.empty(0, np.uint64)
    lines = pa.array(words, pa.string())
    return np.concatenate([h for _, h, _ in hashed_words(lines, WHITE)])
