"""Token sequences of fixed capacity, filled by bounded-space online best fit.

A task holds a fixed number of open sequences. A bitset keyed by free space tells which
amounts of space are on offer; a piece goes to the open sequence it fills best, found
by a shift and the lowest set bit. When it fits none, a new one is opened, and if too
many are open the fullest closes first.

Texts are tokenized where they are read. Only a line of numbers per piece is shuffled,
so that every task packs a large mixed share, and pieces come in the order of a hash:
the same input gives the same sequences, whichever executor runs the task.

Defined results: a null or empty text is the end id alone. Rows that repeat an id are
packed like any others. A null id stays null. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from roadcast.llm.tables import in_small_batches
from roadcast.llm.tokens import Encoder

CAPACITY = 2048
OPEN_SEQUENCES = 4096


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for,
    ``ids``. Only texts longer than ``capacity`` are cut."""
    fields = [
        T.StructField("doc_id", docs.schema[id_col].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, end)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    data = encoder.encode(text or "")
                    for k, at in enumerate(range(0, len(data), step)):
                        own = data[at : at + step]
                        row.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        ids.append(own)
                columns = [
                    part.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    lists = [np.frombuffer(x, "<u4").astype(np.int32) for x in ids]
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return in_small_batches(rows).mapInArrow(cut, T.StructType(fields))


class BestFit:
    """Open sequences by free space, and the bitset of the amounts on offer."""

    def __init__(self, capacity: int, open_limit: int):
        self.capacity, self.limit = capacity, open_limit
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.offered = 0
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        number = stack.pop()
        if not stack:
            self.offered &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The sequence a piece goes to and its place there."""
        fits = self.offered >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.limit:  # the fullest closes
                self._take((self.offered & -self.offered).bit_length() - 1)
            number, free = self.made, self.capacity
            self.made += 1
        left = free - length
        if left:
            self.by_free[left].append(number)
            self.offered |= 1 << left
            self.open += 1
        return number, self.capacity - free


def pack(
    parts: DataFrame, capacity: int = CAPACITY, open_sequences: int = OPEN_SEQUENCES
) -> DataFrame:
    """The pieces, which have a ``length`` of at most ``capacity``, with ``sequence_id``
    and ``offset``. Of the pieces in one batch the longest are placed first."""
    schema = T.StructType(
        [
            *parts.schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    at = parts.columns.index("length")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BestFit(capacity, open_sequences)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            lengths = batch.column(at).to_numpy(zero_copy_only=False)
            number = np.empty(len(lengths), np.int64)
            offset = np.empty(len(lengths), np.int64)
            for i in np.argsort(-lengths, kind="stable").tolist():
                number[i], offset[i] = bins.place(int(lengths[i]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(base + number), pa.array(offset)], schema.names
            )

    order = F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32")
    mixed = parts.repartition(order).sortWithinPartitions(order, "doc_id", "piece")
    return mixed.mapInArrow(fill, schema)
