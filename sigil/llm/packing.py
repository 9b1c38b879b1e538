"""Bounded-space best-fit packing of tokenised documents into fixed-length sequences.

Each task packs the pieces it reads, so nothing is shuffled. A fixed number of bins is
open; a bit set keyed by free space finds the tightest bin for a piece in constant time.
When all bins are open and none fits, the fullest closes. Pieces of one batch are taken
longest first, which the online rule allows: it sees them in the order they are fed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from sigil.llm.common import slices, small_batches, texts_of
from sigil.llm.tokens import tokenizer

LENGTH = 2048
OPEN_BINS = 4096


class BestFit:
    """Places sizes into bins of a capacity; at most `bins` of them are open at a time."""

    def __init__(self, capacity: int = LENGTH, bins: int = OPEN_BINS) -> None:
        self.capacity, self.bins = capacity, bins
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0  # bit f is set if an open bin has f free
        self.open = 0
        self.opened = 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        which = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        return which

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) of a piece of this size, 1 to capacity."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            which = self._take(free)
        else:
            if self.open == self.bins:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the least free space: the fullest
                self.open -= 1
            which, free = self.opened, self.capacity
            self.opened += 1
            self.open += 1
        if free == size:
            self.open -= 1
        else:
            self.by_free[free - size].append(which)
            self.bits |= 1 << (free - size)
        return which, self.capacity - free


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, bins: int = OPEN_BINS, path: str | None = None, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and
    with with_ids the piece's ids as an array.

    A document's ids are its tokens and then id 0; only longer ones than `length` are cut.
    Null and empty texts are the single id 0. Rows with null or repeated ids are packed like
    all others; an empty table gives an empty table. Other input columns are ignored.
    """
    small_batches(docs)
    kind = dict(docs.select(docs[id_col]).dtypes)[id_col]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 36
        encode, packer = tokenizer(path), BestFit(length, bins)
        for batch in slices(batches, mb=2):
            out: list[tuple] = []
            kept: list[np.ndarray] = []
            for row, ids in enumerate(encode.many(texts_of(batch.column("text")))):
                ids = np.append(ids, np.uint32(0)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), length)):
                    part = ids[start : start + length]
                    out.append((len(part), row, piece, start, zlib.crc32(part.tobytes())))
                    if with_ids:
                        kept.append(part)
            order = sorted(range(len(out)), key=lambda i: -out[i][0])
            places = [(out[i], packer.place(out[i][0])) for i in order]
            columns = [
                batch.column("doc_id").take(pa.array([p[1] for p, _ in places], pa.int64())),
                pa.array([p[2] for p, _ in places], pa.int32()),
                pa.array([p[3] for p, _ in places], pa.int64()),
                pa.array([p[0] for p, _ in places], pa.int64()),
                pa.array([p[4] for p, _ in places], pa.int64()),
                pa.array([base + b for _, (b, _) in places], pa.int64()),
                pa.array([o for _, (_, o) in places], pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array([kept[i].astype(np.int32) for i in order], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
