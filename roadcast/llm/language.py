"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram's vector binds its letters:
the first one's vector rotated twice, times the second one's rotated once, times the
third one's. A text's vector bundles, that is adds up, those of all its trigrams; a
language's prototype bundles its training texts. A text gets the language whose
prototype has the largest cosine with its vector.

Since bundling is a sum, prototypes are made from counts of trigrams per language over
all training rows, a table of at most 64^3 rows a language.

Letters are folded to 64 symbols: a word boundary, a-z, and 37 places shared by all other
letters. Defined results: a text that is null or has no letter is `und` with score 0; so
is every text when there is nothing to learn from. Rows with a null language are not
learned from. Scores are cosines, cut at 0; ties go to the first language in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from roadcast.llm.tables import in_small_batches
from roadcast.llm.wordhash import mix64

SYMBOLS = 64
GRAMS = SYMBOLS**3
DIMENSIONS = 1024
TEXTS_AT_ONCE = 128
UNKNOWN = "und"


def _symbols() -> np.ndarray:
    """The symbol of each character below U+3000; letters beyond share places by hash."""
    table = np.zeros(0x3000, np.uint8)
    for code in range(0x3000):
        c = chr(code)
        if c.isalpha():
            table[code] = ord(c) - 96 if "a" <= c <= "z" else 27 + _place(code)
    return table


def _place(code: int) -> int:
    return int(mix64(np.array([code], np.uint64))[0] % np.uint64(SYMBOLS - 27))


def symbols_of(text: str, table: np.ndarray) -> np.ndarray:
    """The text's symbols, 0 for all that is no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) and codes.max() >= len(table):
        far = codes >= len(table)
        out = table[np.where(far, 0, codes)]
        out[far] = [27 + _place(c) if chr(c).isalpha() else 0 for c in codes[far].tolist()]
        return out
    return table[codes]


def trigrams(symbols: np.ndarray) -> np.ndarray:
    """Numbers of the trigrams that hold a letter; runs of non-letters count as one."""
    s = np.concatenate(([0], symbols, [0])).astype(np.int32)
    s = s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))]
    if len(s) < 3:
        return np.empty(0, np.int32)
    return (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]


class Space:
    """The letter vectors, and the vectors of trigrams made from them."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 6):
        rng = np.random.Generator(np.random.PCG64(seed))
        letters = rng.integers(0, 2, (SYMBOLS, dimensions), np.int8) * 2 - 1
        self.third = letters.astype(np.int8)
        self.second = np.roll(self.third, 1, axis=1)
        self.first = np.roll(self.third, 2, axis=1)

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        a, b, c = grams // SYMBOLS**2, grams // SYMBOLS % SYMBOLS, grams % SYMBOLS
        return (self.first[a] * self.second[b] * self.third[c]).astype(np.float32)

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the trigrams' vectors, each as often as it counts."""
        out = np.zeros(self.first.shape[1])
        for k in range(0, len(grams), 4096):
            out += counts[k : k + 4096] @ self.vectors(grams[k : k + 4096]).astype(np.float64)
        return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Trigrams per language: ``lang, gram, n``, counted over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _symbols()
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                grams = trigrams(symbols_of(text.as_py() or "", table))
                if len(grams):
                    if lang not in sums:
                        if len(sums) == 64:  # bounds the memory of a task
                            yield from _flush(sums)
                        sums[lang] = np.zeros(GRAMS, np.int64)
                    own, n = np.unique(grams, return_counts=True)
                    sums[lang][own] += n
        yield from _flush(sums)

    def _flush(sums):
        for lang, total in sums.items():
            own = np.flatnonzero(total)
            columns = [pa.array([lang] * len(own), pa.string()), pa.array(own.astype(np.int32)), pa.array(total[own])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])
        sums.clear()

    rows = docs.select(F.col(text_col), F.col(lang_col))
    partial = in_small_batches(rows).mapInArrow(count, "lang string, gram int, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    dimensions: int = DIMENSIONS,
) -> dict[str, np.ndarray]:
    """A prototype of length 1 for each language, from the rows that are not held out.

    The driver receives ``dimensions`` numbers a language."""
    rows = docs.filter(F.col(lang_col).isNotNull() & ~F.coalesce(held_out(F.col(id_col)), F.lit(False)))
    counts = gram_counts(rows, text_col, lang_col)

    def bundle(key: tuple, group: pa.Table) -> pa.Table:
        grams = group.column("gram").to_numpy()
        vector = Space(dimensions).bundle(grams, group.column("n").to_numpy().astype(np.float64))
        vector /= max(np.linalg.norm(vector), 1e-12)
        return pa.table({"lang": [key[0].as_py()], "vector": pa.array([vector], pa.list_(pa.float64()))})

    found = counts.groupBy("lang").applyInArrow(bundle, "lang string, vector array<double>").collect()
    return {r.lang: np.array(r.vector) for r in sorted(found, key=lambda r: r.lang)}


def _predict(texts: list[str | None], space: Space, table: np.ndarray, names: list[str], prototypes: np.ndarray):
    """Language and score of each text."""
    grams = [trigrams(symbols_of(t or "", table)) for t in texts]
    seen = np.zeros(GRAMS, bool)
    for g in grams:
        seen[g] = True
    known = np.flatnonzero(seen)
    place = np.zeros(GRAMS, np.int32)
    place[known] = np.arange(len(known), dtype=np.int32)
    vectors = np.zeros((len(texts), space.first.shape[1]), np.float32)
    if len(known):
        counts = np.empty((len(texts), len(known)), np.float32)
        for i, g in enumerate(grams):
            counts[i] = np.bincount(place[g], minlength=len(known))
        for k in range(0, len(known), 4096):
            vectors += counts[:, k : k + 4096] @ space.vectors(known[k : k + 4096])
    lengths = np.linalg.norm(vectors.astype(np.float64), axis=1)
    cosines = (vectors.astype(np.float64) @ prototypes.T) / np.maximum(lengths, 1e-12)[:, None]
    best = cosines.argmax(axis=1)
    scores = np.clip(cosines[np.arange(len(texts)), best], 0, 1)
    empty = np.array([not len(g) for g in grams])
    langs = [UNKNOWN if e else names[b] for e, b in zip(empty.tolist(), best.tolist())]
    return langs, np.where(empty, 0.0, scores)


def classify(
    docs: DataFrame,
    prototypes: dict[str, np.ndarray],
    text_col: str = "text",
    lang_name: str = "lang_pred",
    score_name: str = "score",
) -> DataFrame:
    """The rows as they are, with the predicted language and its score. Columns of those
    names that were there before are replaced."""
    kept = [c for c in docs.columns if c not in (lang_name, score_name) or c == text_col]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    at = kept.index(text_col)
    schema = T.StructType(
        [*rows.schema.fields, T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType())]
    )
    names = list(prototypes)
    matrix = np.array([prototypes[n] for n in names])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _symbols()
        space = Space(matrix.shape[1]) if names else None
        for batch in batches:
            for part in (batch.slice(k, TEXTS_AT_ONCE) for k in range(0, batch.num_rows, TEXTS_AT_ONCE)):
                texts = part.column(at).to_pylist()
                if names:
                    langs, scores = _predict(texts, space, table, names, matrix)
                else:
                    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(langs, pa.string()), pa.array(scores)], schema.names
                )

    return in_small_batches(rows).mapInArrow(predict, schema)


def keep_known(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """The documents in one of the languages, with the columns they came with."""
    inner = [f"__in_{i}" for i in range(len(docs.columns))]
    text = inner[docs.columns.index(text_col)]
    found = classify(docs.toDF(*inner), prototypes, text, "__lang", "__score")
    return found.filter(F.col("__lang") != UNKNOWN).select(*inner).toDF(*docs.columns)
