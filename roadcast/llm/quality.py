"""A quality classifier: naive Bayes features for a support vector machine.

A text's features say which character and word n-grams it holds. Each is scaled by the
log of the ratio in which the two classes hold it, counted over all training rows, and a
text's vector is brought to length 1. A linear model with hinge loss is fitted to these
by dual coordinate descent, on a bounded sample of the training rows, and its margin is
mapped to a probability by a logistic curve fitted to rows left out of the descent.

N-grams are hashed to ``2 ** BITS`` places. Every occurrence in the whole text counts
once: features are indicators. Defined results: a null text counts as empty; a text
without features gets the score of the bias. Rows with a null label are not learned
from, nor are ids whose labels contradict each other; an id that repeats, in either table,
counts once, with the text that sorts first. All rows are scored. With only one class to learn from, every score is that class's 0 or 1; with none, 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadcast.llm.bitmaps import bitmap, maybe_in
from roadcast.llm.tables import in_small_batches, settle
from roadcast.llm.wordhash import WHITE, hashed_words, mix64

BITS = 17
SAMPLE = 8000  # labelled rows that the descent and the curve are fitted on
CURVE_SHARE = 5  # one row in so many of the sample is for the curve
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 20
ACCEPT = 0.7


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int32)


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """The distinct feature places of each text: its words, pairs and triples of words
    told apart by whether they repeat one word, and runs of four bytes, lower-cased."""
    column = column.cast(pa.string()).fill_null("")
    per_row: list[np.ndarray] = []
    for row, hashes, counts in hashed_words(column, WHITE):
        ends = np.cumsum(counts)
        singles = _places(mix64(hashes ^ np.uint64(0xA5A5)))
        pairs = _places(mix64(hashes[:-1] * np.uint64(3) + hashes[1:] * np.uint64(5)))
        again = np.concatenate((hashes[1:] == hashes[:-1], [False]))
        thrice = np.concatenate((again[:-1] & again[1:], [False]))
        for k, (n, end) in enumerate(zip(counts.tolist(), ends.tolist())):
            raw = np.frombuffer(column[row + k].as_buffer() or b"", np.uint8)
            runs = [_runs(raw[at : at + (1 << 20) + 3]) for at in range(0, len(raw), 1 << 20)]
            inner = slice(end - n, max(end - 1, end - n))
            shapes = [place for place, seen in ((_TWICE, again), (_THRICE, thrice)) if _within(seen, end, n, place)]
            yield np.unique(
                np.concatenate((singles[end - n : end], pairs[inner], np.array(shapes, np.int32), *runs))
            )


_TWICE, _THRICE = 0, 1  # places of a word that follows itself once, twice


def _within(seen: np.ndarray, end: int, n: int, place: int) -> bool:
    """Whether a repetition that begins in a text of n words ends in it, too."""
    return bool(seen[end - n : max(end - 1 - place, end - n)].any())


def _runs(raw: np.ndarray) -> np.ndarray:
    low = WHITE[raw].astype(np.uint32)
    if len(low) < 4:
        return np.empty(0, np.int32)
    code = (low[:-3] << np.uint32(24)) | (low[1:-2] << np.uint32(16)) | (low[2:-1] << np.uint32(8)) | low[3:]
    code = code * np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x85EBCA77)
    return np.unique((code >> np.uint32(32 - BITS)).astype(np.int32))


@dataclass
class Model:
    """``weights`` per place, already times the scale; the curve's slope and shift."""

    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, places: np.ndarray) -> float:
        norm = np.sqrt((self.scale[places] ** 2).sum())
        return float(self.weights[places].sum() / norm + self.bias) if norm else self.bias

    def score(self, places: np.ndarray) -> float:
        z = self.slope * self.margin(places) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, places: int,
            cost: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the squared hinge loss; a constant feature of 1 gives
    the bias. ``cost`` is per row."""
    w, bias = np.zeros(places), 0.0
    alpha = np.zeros(len(rows))
    diagonal = 0.5 / cost
    square = np.array([float(v @ v) + 1.0 for v in values]) + diagonal
    rng = np.random.Generator(np.random.PCG64(7))
    for _ in range(rounds):
        largest = 0.0
        for i in rng.permutation(len(rows)).tolist():
            own, value = rows[i], values[i]
            slope = y[i] * (float(w[own] @ value) + bias) - 1 + diagonal[i] * alpha[i]
            if alpha[i] == 0 and slope >= 0:
                continue
            largest = max(largest, abs(slope))
            new = max(alpha[i] - slope / square[i], 0.0)
            step = (new - alpha[i]) * y[i]
            alpha[i] = new
            if step:
                w[own] += step * value
                bias += step
        if largest < 1e-3:
            break
    return w, bias


def curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by damped Newton steps, with smoothed targets."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    beta = np.array([1.0, 0.0])
    x = np.stack((margins, np.ones(len(margins))), axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        gradient = x.T @ (p - target) + 1e-3 * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def usable_labels(labels: DataFrame, label_id: str, label_col: str, sample: int) -> DataFrame:
    """Labels that may be learned from, one per id: ``l_id, label, chosen``. Chosen are,
    in each class, the ids whose hashes are the smallest."""
    known = (
        labels.filter(F.col(label_col).isNotNull() & F.col(label_id).isNotNull())
        .filter(~held_out(F.col(label_id)))
        .groupBy(F.col(label_id).alias("l_id"))
        .agg(F.min(label_col).alias("label"), F.max(label_col).alias("most"))
        .filter("label = most")
        .select("l_id", F.col("label").cast("int").alias("label"))
    )
    order = F.xxhash64("l_id")
    sides = [
        known.filter(side).select("l_id").orderBy(order, "l_id").limit(sample // 2)
        for side in ("label > 0", "label <= 0")
    ]
    chosen = sides[0].unionByName(sides[1]).withColumn("chosen", F.lit(True))
    joined = known.join(F.broadcast(chosen), "l_id", "left")  # at most ``sample`` ids
    return settle(joined.select("l_id", "label", F.coalesce("chosen", F.lit(False)).alias("chosen")), "labels")


def labelled(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Training rows, one per id: ``doc_id, text, label, chosen``. Of the documents only
    those that may have a label are shuffled."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    found = maybe_in(rows, "doc_id", bitmap(known, "l_id"))
    joined = found.join(known, F.col("doc_id") == F.col("l_id"))
    # The join has dealt the rows out by id already.
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    return joined.withColumn("__row", first).filter("__row = 1").select("doc_id", "text", "label", "chosen")


def gathered(rows: DataFrame) -> DataFrame:
    """One pass over the training rows, kept. Rows with a ``place`` say how many texts of
    each class a task found to hold that feature, as ``n0`` and ``n1``, with all its texts
    at place -1. The others are the chosen texts: ``o, label, own``, their features."""
    schema = "place int, n0 long, n1 long, o long, label int, own array<int>"
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32())]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, (1 << BITS) + 1), np.int64)
        for batch in batches:
            kept = []
            others = (batch.column(k).to_pylist() for k in (1, 2, 3))
            for own, label, chosen, o in zip(features(batch.column(0)), *others):
                side = int(label > 0)
                sums[side, own + 1] += 1
                sums[side, 0] += 1
                if chosen:
                    kept.append((o, side, own))
            if kept:
                yield _batch([None] * len(kept), [None] * len(kept), [None] * len(kept), *zip(*kept))
        held = np.flatnonzero(sums.any(axis=0))
        none = [None] * len(held)
        yield _batch((held - 1).astype(np.int32), sums[0, held], sums[1, held], none, none, none)

    def _batch(*columns):
        names = [c.split()[0] for c in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    asked = rows.select("text", "label", "chosen", F.xxhash64("doc_id").alias("o"))
    return settle(in_small_batches(asked).mapInArrow(count, schema), "class-counts")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "quality",
) -> Model:
    """Counts over all labelled training rows; the fit on up to ``sample`` of them, those
    whose hashed ids are the smallest in each class.

    The driver receives ``2 ** BITS`` counts and as many weights, whatever the input."""
    known = usable_labels(labels, label_id, label_col, sample)
    seen = gathered(labelled(docs, known, id_col, text_col))
    places = 1 << BITS
    counts = seen.filter("place is not null").groupBy("place")
    counted = counts.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    sums = np.zeros((2, places + 1))
    at = counted.column("place").to_numpy() + 1
    sums[0, at], sums[1, at] = counted.column("n0").to_numpy(), counted.column("n1").to_numpy()
    totals, held = sums[:, 0], sums[:, 1:]
    if not totals.all():
        sure = 0.0 if not totals.any() else (35.0 if totals[1] else -35.0)
        return Model(np.zeros(places), np.zeros(places), 0.0, 0.0, sure)
    low, high = (held + SMOOTHING) / (totals[:, None] + 2 * SMOOTHING)
    scale = np.log(high / low)
    bounded = seen.filter("place is null").select("o", "label", "own")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [
            (o, own.values.to_numpy(), 1.0 if label else -1.0)
            for b in batches
            for o, label, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2))
        ]
        found.sort(key=lambda r: r[0])
        y = np.array([r[2] for r in found])
        own = [r[1] for r in found]
        values = []
        for places_of in own:
            v = scale[places_of]
            norm = np.linalg.norm(v)
            values.append(v / norm if norm else v)
        aside = np.arange(len(found)) % CURVE_SHARE == 0
        inner = np.flatnonzero(~aside)
        share = np.array([(y[inner] > 0).sum(), (y[inner] <= 0).sum()])
        cost = COST * len(inner) / (2.0 * np.maximum(np.where(y[inner] > 0, share[0], share[1]), 1))
        w, bias = descend([own[i] for i in inner], [values[i] for i in inner], y[inner], places, cost)
        outer = np.flatnonzero(aside)
        margins = np.array([float(w[own[i]] @ values[i]) + bias for i in outer])
        slope, shift = curve(margins, y[outer])
        yield pa.RecordBatch.from_arrays(
            [pa.array([w], pa.list_(pa.float64())), pa.array([bias]), pa.array([slope]), pa.array([shift])],
            ["weights", "bias", "slope", "shift"],
        )

    # At most ``sample`` rows meet in one task.
    fitted = bounded.repartition(1).mapInArrow(
        train, "weights array<double>, bias double, slope double, shift double"
    )
    row = fitted.first()
    return Model(scale, np.array(row.weights) * scale, row.bias, row.slope, row.shift)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id, score, predicted``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(own) for own in features(batch.column(1))], np.float64)
            predicted = pa.array((scores >= ACCEPT).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), predicted], ["doc_id", "score", "predicted"]
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return in_small_batches(rows).mapInArrow(apply, f"doc_id {kind}, score double, predicted int")
