"""Runs of a text in which a stretch of words repeats itself at least three times.

A run is a stretch of consecutive words with smallest period q, at least `LEAST` words
and `TIMES` periods long, that no neighbouring word extends keeping the period. All runs
of all texts are found, exactly:

1. At every dyadic scale B, the words are cut into blocks of B. A run of period p, with
   B <= p < 2B, holds a whole block that occurs once more p words on.
2. A block convolution finds all places where it does: the sum of the squared differences
   between the block and each place of the following window is worked out for all places
   at once by number-theoretic transforms, in whole numbers modulo a prime. It is zero
   wherever nothing differs.
3. Neighbouring blocks with the same distance are joined and extended on both sides by
   less than a block, by binary search on prefix polynomials.
4. What is long enough is compared word by word. A stretch inside a run of a smaller
   period has that period and is left out.

Blocks with a word that does not come again in reach cannot occur once more and are not
convolved; in prose this leaves few. Residues may be zero, and polynomials equal, by
chance: step 4 then looks at the distance in question again, word by word.

Memory follows a batch of texts or, beyond that, one text. Texts are not shuffled.

Words are `[^\\x20\\x09-\\x0D]+`, told apart by case. Defined results: null and empty texts
have no words and no runs. Rows that repeat an id are separate. Other columns are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from roadcast.llm.tables import in_small_batches
from roadcast.llm.wordscan import byte_table, scan

LEAST = 24
TIMES = 3
TABLE = byte_table(b" \t\n\x0b\x0c\r", lower=False)
PRIME = 15 * (1 << 27) + 1  # has roots of unity of order up to 2**27
_ROOT = 31
_BASES = (1_234_567_891, 987_654_321)
_LARGEST_BLOCK = 1 << 18
_CELLS = 1 << 19  # numbers transformed at a time
_P = np.uint64(PRIME)


def _reduced(x: np.ndarray) -> np.ndarray:
    """Numbers below twice the prime, modulo it."""
    return np.minimum(x, x - _P)  # where x is smaller, the difference wraps around


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate((out, out * np.uint64(pow(base, len(out), PRIME)) % _P))
    return out[:n]


def transform(rows: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """The transform of each row, in bit-reversed order. ``roots``: powers of a root of
    unity of the order of the row length, half as many."""
    n = rows.shape[1]
    half = n // 2
    while half:
        pairs = rows.reshape(len(rows), -1, 2, half)
        first, second = pairs[:, :, 0], pairs[:, :, 1]
        low = _reduced(first + second)
        high = (first + _P - second) * roots[:: n // (2 * half)] % _P
        rows = np.stack((low, high), axis=2).reshape(len(rows), n)
        half //= 2
    return rows


def inverse(rows: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Back from bit-reversed order. ``roots`` are those of the inverse root."""
    n, half = rows.shape[1], 1
    while half < n:
        pairs = rows.reshape(len(rows), -1, 2, half)
        first = pairs[:, :, 0]
        second = pairs[:, :, 1] * roots[:: n // (2 * half)] % _P
        rows = np.stack((_reduced(first + second), _reduced(first + _P - second)), axis=2)
        rows = rows.reshape(len(rows), n)
        half *= 2
    return rows * np.uint64(pow(n, -1, PRIME)) % _P


def differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """The sums of squared differences, modulo the prime, between each block of B numbers
    and the first B places of its window of 2 B."""
    size = blocks.shape[1]
    root = pow(_ROOT, (PRIME - 1) // (2 * size), PRIME)
    roots, back = _powers(root, size), _powers(pow(root, -1, PRIME), size)
    turned = np.zeros(windows.shape, np.uint64)
    turned[:, 0] = blocks[:, 0]
    turned[:, size + 1 :] = blocks[:, :0:-1]
    products = transform(windows, roots) * transform(turned, roots) % _P
    crossed = inverse(products, back)[:, :size]
    squares = np.zeros((len(windows), 2 * size + 1), np.uint64)
    np.cumsum(windows * windows % _P, axis=1, out=squares[:, 1:])
    theirs = (squares[:, size : 2 * size] - squares[:, :size]) % _P
    own = (blocks * blocks % _P).sum(axis=1, keepdims=True) % _P
    return (own + theirs + np.uint64(2) * (_P - crossed)) % _P


def _again(codes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How far on in its text each word comes again; where it does not, very far."""
    out = np.full(len(codes), 1 << 60)
    key = text * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


class _Search:
    """The runs in texts of numbered words, one text behind another."""

    def __init__(self, codes: np.ndarray, begins: np.ndarray):
        self.codes, self.begins = codes, begins
        self.text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        self.values = codes.astype(np.uint64) * np.uint64(2_654_435_761) % _P
        self.sums: list[tuple[np.ndarray, np.ndarray]] = []
        self.found = [np.empty(0, np.int64)] * 3  # start, end, period

    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and period of all runs, by start and then period."""
        longest = int(np.diff(self.begins).max(initial=0))
        if longest >= LEAST:
            again = _again(self.codes, self.text)
            scale = 1
            while TIMES * scale <= longest:
                self._at(scale, again < 2 * scale)
                scale *= 2
        order = np.lexsort((self.found[2], self.found[0]))
        return tuple(x[order] for x in self.found)

    def _at(self, scale: int, comes_again: np.ndarray) -> None:
        """Add the runs with periods from ``scale`` up to twice that."""
        step = np.diff(comes_again.astype(np.int8), prepend=0, append=0)
        first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        # All words of a run but those of its last period come again a period on.
        long = last - first >= max(2 * scale, LEAST + 1 - 2 * scale)
        first, last = first[long], last[long]
        if not len(first):
            return
        size = min(scale, _LARGEST_BLOCK)
        begin = self.begins[self.text[first]]
        j = -((begin - first) // size)
        many = np.maximum((last - begin) // size - j, 0)
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        blocks = np.repeat(begin + j * size, many) + nth * size
        ends = self.begins[self.text[blocks] + 1] if len(blocks) else blocks
        blocks, ends = blocks[blocks + scale + size <= ends], ends[blocks + scale + size <= ends]
        at, distance = self._seeds(blocks, ends, size, scale)
        if not len(at):
            return
        # Blocks in a row with one distance are one stretch.
        order = np.lexsort((at, distance))
        at, distance = at[order], distance[order]
        new = np.ones(len(at), bool)
        new[1:] = (distance[1:] != distance[:-1]) | (at[1:] != at[:-1] + size)
        left, d = at[new], distance[new]
        right = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] + size
        needed = np.maximum(LEAST - d, (TIMES - 1) * d)
        use = right - left + 2 * (size - 1) >= needed
        if size == scale:  # else a block may be shorter than the other run's period
            use &= ~self._inside(left, right + d)
        left, right, d, needed = left[use], right[use], d[use], needed[use]
        if not len(left):
            return
        text = self.text[left]
        right = right + self._equal(right, d, np.minimum(self.begins[text + 1] - d - right, size), 1)
        left = left - self._equal(left, d, np.minimum(left - self.begins[text], size), -1)
        long = right - left >= needed
        stretches = np.unique(np.stack((left[long], right[long], d[long]), axis=1), axis=0)
        runs = {run for l, r, p in stretches.tolist() for run in self._compared(l, r, p)}
        left, right, d = np.array(sorted(runs), np.int64).reshape(-1, 3).T
        own = ~self._inside(left, right + d)
        self.found = [np.concatenate(x) for x in zip(self.found, (left[own], (right + d)[own], d[own]))]

    def _seeds(self, blocks: np.ndarray, ends: np.ndarray, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
        """Blocks and the distances from ``scale`` up to twice that at which they occur."""
        at, distance = [blocks[:0]], [blocks[:0]]
        padded = np.concatenate((self.values, np.zeros(2 * size, np.uint64)))
        rows = max(1, _CELLS // (2 * size))
        for near in range(scale, 2 * scale, size):
            some = np.flatnonzero(blocks + near + size <= ends)
            for k in range(0, len(some), rows):
                own = blocks[some[k : k + rows]]
                window = padded[own[:, None] + near + np.arange(2 * size)]
                row, place = np.nonzero(differences(padded[own[:, None] + np.arange(size)], window) == 0)
                fits = own[row] + near + place + size <= ends[some[k + row]]
                at.append(own[row][fits])
                distance.append(near + place[fits])
        return np.concatenate(at), np.concatenate(distance)

    def _inside(self, left: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which stretches lie inside a run found so far."""
        starts, ends, _ = self.found
        if not len(starts):
            return np.zeros(len(left), bool)
        order = np.argsort(starts)
        reach = np.maximum.accumulate(ends[order])
        k = np.searchsorted(starts[order], left, "right")
        return (k > 0) & (reach[np.maximum(k, 1) - 1] >= end)

    def _equal(self, at: np.ndarray, d: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        """How many words, up to ``most``, from ``at`` on (or back) equal those ``d`` on."""
        if not self.sums:
            for base in _BASES:
                powers = _powers(base, len(self.codes) + 1)
                sums = np.zeros(len(self.codes) + 1, np.uint64)
                np.cumsum(self.values * powers[:-1] % _P, out=sums[1:])
                self.sums.append((sums % _P, powers))
        low, high = np.zeros(len(at), np.int64), most.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            a, b = (at, at + middle) if way > 0 else (at - middle, at)
            same = np.ones(len(at), bool)
            for sums, powers in self.sums:
                here, there = sums[b] + _P - sums[a], sums[b + d] + _P - sums[a + d]
                same &= here % _P * powers[d] % _P == there % _P
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low

    def _compared(self, left: int, right: int, d: int) -> list[tuple[int, int, int]]:
        """The stretch itself where its words equal those ``d`` on and its neighbours'
        do not, else what of its surroundings does and is long enough."""
        codes, text = self.codes, int(self.text[left])
        begin, end = int(self.begins[text]), int(self.begins[text + 1])
        whole = np.array_equal(codes[left:right], codes[left + d : right + d])
        if whole and (left == begin or codes[left - 1] != codes[left - 1 + d]):
            if right + d == end or codes[right] != codes[right + d]:
                return [(left, right, d)]
        equal = codes[begin : end - d] == codes[begin + d : end]
        step = np.diff(equal.astype(np.int8), prepend=0, append=0)
        pairs = zip(np.flatnonzero(step == 1) + begin, np.flatnonzero(step == -1) + begin)
        needed = max(LEAST - d, (TIMES - 1) * d)
        return [(int(l), int(r), d) for l, r in pairs if r - l >= needed and l < right and r > left]


def runs_in(codes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of the runs in texts of numbered words. ``begins`` are the
    places where the texts begin and, at last, end; runs are in order of their place."""
    return _Search(codes.astype(np.int64), begins.astype(np.int64)).all()


Rewrite = Callable[[object, int], tuple[int, int] | None]


def planted(doc_id: object, n: int) -> tuple[int, int] | None:
    """For one document in ten, from which word on it is made to repeat itself, and the
    period."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    a = g % n
    return (a, 1 + (n - a) // (3 + g % 8)) if h % 10 == 0 else None


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Rewrite | None = None
) -> DataFrame:
    """A row per document: ``doc_id``, ``runs``, an ``array<struct<start, length, period>>``
    by start and then period, counted in words from 0, and ``collapsed``, the text without
    what each run repeats: words in a run behind its first period are dropped and the
    others joined by one space. ``rewrite`` may name, for an id and a number of words, a
    place from which on a text is first made to repeat itself with some period."""
    kind = docs.schema[id_col].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in scan(batch.column(1), TABLE):
                ids = batch.column(0).slice(words.first_row, len(words.upto) - 1)
                exact = words.dictionary()
                codes = exact.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                if rewrite is not None:
                    _rewritten(codes, words.upto, ids.to_pylist())
                start, end, period = runs_in(codes, words.upto)
                text = np.searchsorted(words.upto, start, "right") - 1
                dropped = np.zeros(len(codes) + 1, np.int64)
                np.add.at(dropped, start + period, 1)
                np.add.at(dropped, end, -1)
                keep = np.cumsum(dropped[:-1]) == 0
                kept = np.concatenate(([0], np.cumsum(keep)))[words.upto]
                strings = exact.dictionary.cast(pa.binary()).take(pa.array(codes[keep]))
                lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), strings), b" ")
                values = [pa.array(x) for x in (start - words.upto[text], end - start, period)]
                bounds = np.searchsorted(text, np.arange(len(words.upto)))
                runs = pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(values, fields=list(run))
                )
                yield pa.RecordBatch.from_arrays(
                    [ids, runs, lines.cast(pa.string())], ["doc_id", "runs", "collapsed"]
                )

    def _rewritten(codes, upto, ids):
        for k, doc_id in enumerate(ids):
            first, n = int(upto[k]), int(upto[k + 1] - upto[k])
            change = rewrite(doc_id, n)
            if change is not None:
                a, p = change
                codes[first + a : first + n] = np.resize(codes[first + a : first + a + p], n - a)

    return in_small_batches(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).mapInArrow(
        search, f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )


def most_periodic(runs: Column) -> Column:
    """The run with the greatest quotient of length and period, the first of several."""
    more = lambda r, best: r["length"] * best["period"] > best["length"] * r["period"]
    return F.aggregate(
        runs, F.get(runs, F.lit(0)), lambda best, r: F.when(more(r, best), r).otherwise(best)
    )


def report(found: DataFrame) -> DataFrame:
    """Number of runs, the most periodic one and digests of the runs and of what is left:
    ``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256``."""
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    )
    best = found.select("*", most_periodic(F.col("runs")).alias("best"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
