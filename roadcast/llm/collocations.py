"""Collocations: frequent phrases whose words occur together more often than apart.

Phrases are runs of up to five words within a piece of text, counted by language.

1. Level by level, from single words on, tasks hash every n-gram with prefix polynomials
   (Rabin-Karp fingerprints: one multiplication an n-gram) and count it, unless one of the
   n-grams of one word less inside it is rare; two bitmaps of fixed size tell, whose false
   hits cost work.
2. What has one fingerprint is taken apart in the same pass by a digest of its words. Rows
   of fingerprint, digest, count and a pointer to a text that holds it are shuffled: a
   task's rows are the n-grams it counts, however many are frequent in the end.
3. Only frequent phrases are read, from the texts that the pointers name.
4. Every cut of a phrase in two is scored by joins with the phrases' own counts. The
   lowest score counts. Phrases inside a longer one that is as frequent are dropped.

Words are `[^\\x20\\x09]+` with A-Z lower-cased; `.,;:!?` and line breaks end a piece.
Scores are exact: products are decimals of 38 digits, divided as whole numbers.

Defined results: a null text has no words, a null language is ``und``. Every row counts,
rows that repeat an id or a text as well. A table without frequent phrases gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from roadcast.llm.bitmaps import bitmap, collect_bitmap, held, maybe_in
from roadcast.llm.tables import in_small_batches, settle
from roadcast.llm.wordhash import mix64
from roadcast.llm.wordscan import Words, byte_table, scan
from roadcast.operators.joins import dimension_join, skewproof_join

LONGEST = 5
LEAST = 100
TOP = 2000
ABSORBED = 100  # percent of a phrase's count that a longer one must have
BREAKS = b".,;:!?\n\x0b\x0c\r"
TABLE = byte_table(b" \t" + BREAKS, lower=True)
_BASE = 0x9E3779B97F4A7C15
_SLICES = 64  # of a language's phrases, each ranked by itself first
_SIZES = 64  # more than the words of a phrase
_PRINT_BITS = 48  # enough to keep false candidates rare, and fewer bytes to shuffle
_DIGEST_BITS = 48  # 32 of them share a column with a pointer, 16 with a fingerprint
_RUN = 1 << 20  # bytes of text that are taken apart at a time
_WAITING = 1 << 20  # fingerprints a task gathers before it counts them
_FLUSH = 1 << 21  # distinct fingerprints a task holds before it passes them on
_WAITING_PHRASES, _FLUSH_PHRASES = 1 << 17, 1 << 19  # the same of phrases


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Fingerprints:
    """Hashes of the n-grams of a run of words, seeded by their language."""

    def __init__(self, words: Words, seeds: np.ndarray):
        n = len(words.hashes)
        self.n, self.seeds = n, seeds
        self.inverse = _powers(pow(_BASE, -1, 1 << 64), n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words.hashes * _powers(_BASE, n), out=self.sums[1:])
        self.piece = np.cumsum(words.after_break)

    def of(self, size: int) -> np.ndarray:
        """The fingerprint of the n-gram from each word on that leaves room for one."""
        many = max(self.n - size + 1, 0)
        own = (self.sums[size : size + many] - self.sums[:many]) * self.inverse[:many]
        return mix64(own + self.seeds[:many] * np.uint64(2 * size + 1)) >> np.uint64(64 - _PRINT_BITS)

    def whole(self, size: int) -> np.ndarray:
        """Whether these lie in one piece."""
        many = max(self.n - size + 1, 0)
        return self.piece[size - 1 : size - 1 + many] == self.piece[:many]

    def candidates(self, size: int, shorter: bytes | None) -> np.ndarray:
        """Whether these lie in one piece and have frequent parts of one word less."""
        ok = self.whole(size)
        if shorter is None:
            return ok
        known = _frequent(shorter, self.of(size - 1))
        return ok & known[: len(ok)] & known[1 : len(ok) + 1]


def _bitmaps(found: DataFrame) -> bytes:
    """Two bitmaps of fingerprints, by their lower and their upper half."""
    upper = found.select(F.shiftright("fp", _PRINT_BITS // 2).alias("fp"))
    return collect_bitmap(found, "fp") + collect_bitmap(upper, "fp")


def _frequent(bitmaps: bytes, fps: np.ndarray) -> np.ndarray:
    """Which fingerprints may be among those of `_bitmaps`."""
    half = len(bitmaps) // 2
    return held(bitmaps[:half], fps) & held(bitmaps[half:], fps >> np.uint64(_PRINT_BITS // 2))


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _runs(batch: pa.RecordBatch, run_bytes: int) -> Iterator[tuple[Words, np.ndarray, list[str], Fingerprints]]:
    """Runs of the rows of ``lang, text, ...``: the words, the number of each word's
    language, the languages and the fingerprints."""
    langs = batch.column(0).dictionary_encode()
    names = langs.dictionary.to_pylist()
    seeds = np.array([_seed(x) for x in names], np.uint64)
    codes = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    for words in scan(batch.column(1), TABLE, BREAKS, run_bytes):
        if len(words.starts):
            counts = np.diff(words.upto)
            own = np.repeat(codes[words.first_row : words.first_row + len(counts)], counts)
            yield words, own, names, Fingerprints(words, seeds[own])


def _counted(counted: list[np.ndarray], waiting: list[np.ndarray]) -> list[np.ndarray]:
    """Digests in order, their fingerprints, counts and pointers, with what waits (digests,
    fingerprints and pointers of occurrences) added to them. Both lists may be changed. An
    n-gram may come twice where another has its digest."""
    if not waiting:
        return counted
    found = np.concatenate(waiting, axis=1)
    waiting.clear()
    found = found[:, np.argsort(found[0])]
    new = np.ones(found.shape[1], bool)
    new[1:] = (found[0, 1:] != found[0, :-1]) | (found[1, 1:] != found[1, :-1])
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(found[2], first) if len(first) else found[2]
    own = [found[0, first], found[1, first], np.diff(first, append=found.shape[1]), least]
    del found, new, first
    if not len(counted[0]):
        return own
    at = np.searchsorted(counted[0], own[0])
    near = np.minimum(at, len(counted[0]) - 1)
    known = (counted[0][near] == own[0]) & (counted[1][near] == own[1])
    np.add.at(counted[2], at[known], own[2][known])
    np.minimum.at(counted[3], at[known], own[3][known])
    fresh = ~known
    for k in range(4):
        counted[k] = np.insert(counted[k], at[fresh], own[k][fresh])
    return counted


def _word_digests(words: Words, used: np.ndarray) -> np.ndarray:
    """A digest of each word; 0 where a word is not used."""
    out = np.zeros(len(used), np.uint64)
    exact = words.dictionary()
    own = exact.indices.to_numpy(zero_copy_only=False)
    needed = np.zeros(len(exact.dictionary), bool)
    needed[own[used]] = True
    of_word = np.zeros(len(needed), np.uint64)
    of_word[needed] = np.array([_digest(w) for w in exact.dictionary.filter(pa.array(needed)).to_pylist()], np.uint64)
    out[used] = of_word[own[used]]
    return out


def _digests_at(words: Words, prints: Fingerprints, at: np.ndarray, size: int) -> np.ndarray:
    """The digests of the n-grams from these words on."""
    used = np.zeros(prints.n, bool)
    for k in range(size):
        used[at + k] = True
    of_word = _word_digests(words, used)
    return _short(_digests(prints.seeds[at], [of_word[at + k] for k in range(size)]))


def _short(digests: np.ndarray) -> np.ndarray:
    """What of a digest is shuffled."""
    return (digests >> np.uint64(64 - _DIGEST_BITS)).view(np.int64)


def _pointers(prints: pa.Array) -> np.ndarray:
    """The first four bytes of the texts' prints as numbers. Texts may share one."""
    own = np.frombuffer(b"".join(prints.to_pylist()), ">u4")
    return own.reshape(len(prints), -1)[:, 0].astype(np.int64)


def frequent_fingerprints(docs: DataFrame, size: int, shorter: bytes | None, least: int) -> DataFrame:
    """``fp, digest, n, at`` of the n-grams of that size that occur often enough in a
    language, with the pointer to a text. ``shorter``: the bitmaps of those of one word less.
    With single words comes the number of words of each language, as a negative ``n``, the
    fingerprint 0 and the language's seed for a digest."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, waiting, n_waiting = [np.empty(0, np.int64)] * 4, [], 0
        totals: dict[int, list[int]] = {}
        for batch in batches:
            pointers = _pointers(batch.column(2))
            for words, _, _, prints in _runs(batch, _RUN):
                at = np.flatnonzero(prints.candidates(size, shorter))
                own = np.empty((3, len(at)), np.int64)
                own[0], own[1] = _digests_at(words, prints, at, size), prints.of(size)[at].view(np.int64)
                row = np.searchsorted(words.upto, at, "right") - 1
                own[2] = pointers[words.first_row + row]
                waiting.append(own)
                n_waiting += len(at)
                if size == 1:
                    for seed, first, n in zip(*np.unique(_short(prints.seeds), return_index=True, return_counts=True)):
                        total = totals.setdefault(int(seed), [0, int(own[2, first])])
                        total[0] -= int(n)
                if n_waiting > _WAITING:
                    counted, n_waiting = _counted(counted, waiting), 0
                    if len(counted[0]) > _FLUSH:
                        yield _rows(counted)
                        counted = [np.empty(0, np.int64)] * 4
        yield _rows(_counted(counted, waiting))
        every = [(seed, 0, n, pointer) for seed, (n, pointer) in totals.items()]
        yield _rows(list(np.array(every, np.int64).reshape(-1, 4).T))

    def _rows(counted: list[np.ndarray]) -> pa.RecordBatch:
        digest, fp, n, at = counted
        packed = [fp << 16 | digest >> 32, digest << 32 | at, n]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in packed], ["key", "rest", "n"])

    rows = in_small_batches(docs.select("lang", "text", "print"))
    # Tasks have counted what they can, so their rows are dealt as they are, in few bytes.
    dealt = rows.mapInArrow(count, "key long, rest long, n long").repartition("key")
    summed = dealt.groupBy("key", F.shiftrightunsigned("rest", 32).alias("low")).agg(
        F.sum("n").alias("n"), F.min(F.col("rest").bitwiseAND(F.lit((1 << 32) - 1))).alias("at")
    )
    high = F.shiftleft(F.col("key").bitwiseAND(F.lit(0xFFFF)), 32)
    return summed.filter((F.col("n") >= least) | (F.col("n") < 0)).select(
        F.shiftrightunsigned("key", 16).alias("fp"), high.bitwiseOR(F.col("low")).alias("digest"), "n", "at"
    )


def _digest(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def _digests(seeds: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """64 bits that tell apart what has one fingerprint: of phrases, by their languages'
    seeds and the digests of their first words, their second ones and so on."""
    out = seeds
    for own in words:
        out = mix64(out * np.uint64(_BASE) + own)
    return out


def _spelled(words: Words, first: int, size: int) -> list[bytes]:
    parts = (words.low[words.starts[k] : words.ends[k]].tobytes() for k in range(first, first + size))
    return [p.replace(b"\xff", b"\0") for p in parts]


def _distinct(codes: list[np.ndarray], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of equal numbers in all columns: the first row of each kind, and how many."""
    key = codes[0]
    for column, most in zip(codes[1:], sizes[1:]):
        _, key = np.unique(key * most + column, return_inverse=True)
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return first, counts


def _phrases_of(
    words: Words, langs: np.ndarray, n_langs: int, prints: Fingerprints, levels: list[bytes]
) -> np.ndarray:
    """The distinct phrases of a run with frequent fingerprints, told apart word by word, a
    column each: size, fingerprint, digest, count, two rows to fill in, number of the
    first word."""
    exact = words.dictionary()
    own = exact.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    places, shorter = [], None
    for size, bits in enumerate(levels, 1):
        fps = prints.of(size)
        at = np.flatnonzero(prints.candidates(size, shorter) & _frequent(bits, fps))
        shorter = bits
        if len(at):
            columns = [langs[at], *(own[at + k] for k in range(size))]
            first, counts = _distinct(columns, [n_langs] + [len(exact.dictionary)] * size)
            places.append((size, at[first], fps[at[first]], counts))
    # Few of the words stand in frequent phrases; only these are digested.
    used = np.zeros(len(exact.dictionary), bool)
    for size, at, _, _ in places:
        for k in range(size):
            used[own[at + k]] = True
    of_word = np.zeros(len(used), np.uint64)
    spelled = exact.dictionary.filter(pa.array(used)).to_pylist()
    of_word[used] = np.array([_digest(w) for w in spelled], np.uint64)
    out = [np.empty((7, 0), np.int64)]
    for size, at, fps, counts in places:
        found = np.zeros((7, len(at)), np.int64)
        digests = _digests(prints.seeds[at], [of_word[own[at + k]] for k in range(size)])
        found[0], found[1], found[2], found[3], found[6] = size, fps.view(np.int64), digests.view(np.int64), counts, at
        out.append(found)
    return np.concatenate(out, axis=1)


def _added(found: np.ndarray, waiting: list[np.ndarray]) -> np.ndarray:
    """Columns as of `_phrases_of`, those alike in the first three rows added up."""
    every = np.concatenate((found, *waiting), axis=1)
    if not every.shape[1]:
        return every
    order = np.lexsort(every[:3])
    every = every[:, order]
    new = np.ones(every.shape[1], bool)
    new[1:] = (every[:3, 1:] != every[:3, :-1]).any(axis=0)
    first = np.flatnonzero(new)
    out = every[:, first]
    out[3] = np.add.reduceat(every[3], first)
    return out


def occurrences(docs: DataFrame, levels: list[bytes]) -> DataFrame:
    """The phrases with frequent fingerprints, told apart by their words: ``lang, size,
    fp, digest, n, print, pos`` of partial counts; with size 0, the number of words.

    `collocations` does without: every task passes on each frequent phrase that it holds,
    and a larger table has both more tasks and more frequent phrases. It compares words
    themselves, so it can tell whether digests do."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[str, int] = {}  # of the languages
        totals: list[int] = []
        found, waiting, n_waiting = np.empty((7, 0), np.int64), [], 0
        for batch in batches:
            text_prints = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64).reshape(-1, 2)
            for words, langs, names, prints in _runs(batch, _RUN):
                code_of = np.array([codes.setdefault(name, len(codes)) for name in names])
                totals += [0] * (len(codes) - len(totals))
                for code, n in zip(*np.unique(langs, return_counts=True)):
                    totals[code_of[code]] += int(n)
                new = _phrases_of(words, langs, len(names), prints, levels)
                new[0] += code_of[langs[new[6]]] * _SIZES
                row = np.searchsorted(words.upto, new[6], "right") - 1
                new[4:6] = text_prints[words.first_row + row].T
                new[6] -= words.upto[row]
                waiting.append(new)
                n_waiting += new.shape[1]
                if n_waiting > max(_WAITING_PHRASES, found.shape[1] // 2):
                    found, waiting, n_waiting = _added(found, waiting), [], 0
                    if found.shape[1] > _FLUSH_PHRASES:
                        yield _table(found, list(codes))
                        found = found[:, :0]
        words_of = np.zeros((7, len(totals)), np.int64)
        words_of[0], words_of[3] = np.arange(len(totals)) * _SIZES, totals
        yield _table(np.concatenate((_added(found, waiting), words_of), axis=1), list(codes))

    def _table(found: np.ndarray, names: list[str]) -> pa.RecordBatch:
        lang = pa.DictionaryArray.from_arrays(pa.array(found[0] // _SIZES, pa.int32()), pa.array(names, pa.string()))
        pointed = np.ascontiguousarray(found[4:6].T).tobytes()
        text_prints = pa.Array.from_buffers(pa.binary(16), found.shape[1], [None, pa.py_buffer(pointed)])
        columns = [
            lang.cast(pa.string()), pa.array((found[0] % _SIZES).astype(np.int32)), *map(pa.array, found[1:4]),
            text_prints.cast(pa.binary()), pa.array(found[6]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "size", "fp", "digest", "n", "print", "pos"])

    return in_small_batches(docs).mapInArrow(
        verify, "lang string, size int, fp long, digest long, n long, print binary, pos long"
    )


def _materialised(docs: DataFrame, counted: DataFrame) -> DataFrame:
    """The phrases of ``size, fp, digest, n, at``: ``lang, phrase, size, f``, of size 0 an empty
    one for a language's words. Only texts that a pointer names are shuffled; rows with the same
    text and language count as one."""
    wanted = counted.groupBy("at").agg(F.collect_list(F.struct("size", "fp", "digest", "n")).alias("wanted"))
    pointer = F.conv(F.hex(F.substring("print", 1, 4)), 16, 10).cast("long")
    texts = maybe_in(docs.select("lang", "text", pointer.alias("at")), "at", bitmap(counted, "at"))
    texts = texts.groupBy("at", "lang", F.sha2("text", 256)).agg(F.min("text").alias("text"))
    rows = texts.join(wanted, "at").select("lang", "text", "wanted")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, langs, names, prints in _runs(batch, _RUN):
                own = batch.column(2).slice(words.first_row, len(words.upto) - 1).flatten()
                sizes, fps, digests, counts = (c.to_numpy(zero_copy_only=False) for c in own.flatten())
                found = []
                for size in np.unique(sizes).tolist():
                    of_size = sizes == size
                    f = dict(zip(zip(fps[of_size].tolist(), digests[of_size].tolist()), counts[of_size].tolist()))
                    if size:
                        printed = prints.of(size).view(np.int64)
                        at = np.flatnonzero(prints.whole(size) & np.isin(printed, fps[of_size]))
                        keys = zip(printed[at].tolist(), _digests_at(words, prints, at, size).tolist())
                    else:
                        _, at = np.unique(langs, return_index=True)
                        keys = ((0, seed) for seed in _short(prints.seeds[at]).tolist())
                    for first, key in zip(at.tolist(), keys):
                        n = f.pop(key, None)
                        if n is not None:
                            phrase = b" ".join(_spelled(words, first, size)).decode()
                            found.append((names[langs[first]], phrase, size, n))
                types = (pa.string(), pa.string(), pa.int32(), pa.int64())
                columns = zip(*found) if found else ((),) * 4
                arrays = [pa.array(c, t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "phrase", "size", "f"])

    # Texts that share a pointer may both hold a phrase.
    return in_small_batches(rows).mapInArrow(read, "lang string, phrase string, size int, f long").distinct()


def text_rows(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, text, print``: what the passes read."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    halves = [F.lpad(F.hex(F.xxhash64(*columns)), 16, "0") for columns in ((lang, text), (text, lang))]
    return docs.select(lang.alias("lang"), text.alias("text"), F.unhex(F.concat(*halves)).alias("print"))


def frequent_phrases(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, lang_col: str = "lang", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, size, f`` of all frequent phrases of up to so many words, single
    words among them, and ``lang, n`` of the number of words."""
    rows = text_rows(docs, lang_col, text_col)
    bits, levels = None, []
    while len(levels) < longest:
        size = len(levels) + 1
        found = settle(frequent_fingerprints(rows, size, bits, least), "frequent-ngrams")
        levels.append(found.withColumn("size", F.when(F.col("n") < 0, 0).otherwise(size)))
        bits = _bitmaps(found.filter("n > 0"))
        if not any(bits):
            break
    counted = reduce(DataFrame.unionByName, levels)
    phrases = settle(_materialised(rows, counted), "phrases")
    if phrases.count() != counted.count():
        raise ValueError("a text is not what it was when its phrases were counted")
    totals = phrases.filter("size = 0").select("lang", (-F.col("f")).alias("n"))
    return phrases.filter("size > 0"), totals


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the phrases of two words and more, by the
    cut that scores lowest."""
    words = F.split("phrase", " ")
    cuts = phrases.filter("size > 1").select(
        "lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    for side, name in (("first", "l"), ("rest", "r")):
        own = phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        cuts = skewproof_join(cuts, own, ["lang", side], "inner")
    whole = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    above = (whole["a"] * 1000).cast("decimal(22,0)") * whole["n"]
    parts = dimension_join(cuts, totals, ["lang"], "inner").select(
        "lang", "phrase", "a", "k", "l", "r", "n",
        above.cast("decimal(38,0)").alias("above"), (whole["l"] * whole["r"]).cast("decimal(38,0)").alias("below"),
    )
    best = parts.groupBy("lang", "phrase").agg(
        F.min(F.struct(F.expr("above div below").alias("score"), "k", "a", "l", "r", "n")).alias("best")
    )
    return best.select("lang", "phrase", *[f"best.{c}" for c in ("a", "l", "r", "n", "score")])


def _parts(longest: int):
    """Shorter phrases of at least two words inside a phrase, as an array."""
    words, size = F.split("phrase", " "), F.col("size")
    inside = [
        F.when(size >= start + many, F.array_join(F.slice(words, start + 1, many), " "))
        for many in range(2, longest)
        for start in range(longest - many + 1)
    ]
    return F.array_compact(F.array(*[F.when(F.col("phrase") != p, p) for p in inside]))


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    absorbed: int = ABSORBED,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    phrases, totals = frequent_phrases(docs, longest, least, lang_col, text_col)
    found = scored(phrases, totals)
    if longest > 2:
        longer = (
            phrases.filter("size > 2")
            .select("lang", "f", F.explode(_parts(longest)).alias("phrase"))
            .groupBy("lang", "phrase")
            .agg(F.max("f").alias("longer"))
        )
        found = found.join(longer, ["lang", "phrase"], "left").filter(
            F.col("longer").isNull() | (100 * F.col("longer") < absorbed * F.col("a"))
        )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_SLICES))
    # No language is ranked whole by one task: the best of its slices are.
    some = found.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    ).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
