"""Documents packed into sequences of a fixed length: bounded-space online best-fit.

Each task tokenizes its documents in the order of its part of the table and packs them at once, so nothing is shuffled.
It keeps a fixed number of sequences open, in lists by free space, with a bit set of the free spaces that some open
sequence has. A piece goes to the open sequence that it fills best. If none has room, a new one is opened, and where
that is one too many, the fullest is closed first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import blocks, int64
from snaplake.llm.vocabulary import encoder

SCHEMA = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"


class BestFit:
    """Places pieces one after the other. Memory is bounded by ``open_bins``, whatever is packed."""

    def __init__(self, size: int, open_bins: int) -> None:
        self.size, self.open_bins = size, open_bins
        self.spaces = 0  # bit k: an open sequence has k places left
        self.by_space: dict[int, list[int]] = {}
        self.open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """(number of the sequence, place in it) of a piece of 1 to ``size`` tokens."""
        fits = self.spaces >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            if self.open == self.open_bins and length < self.size:
                self._take((self.spaces & -self.spaces).bit_length() - 1)
            space, number = self.size, self.made
            self.made += 1
        if left := space - length:
            self.by_space.setdefault(left, []).append(number)
            self.spaces |= 1 << left
            self.open += 1
        return number, self.size - space

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        number = bins.pop()
        if not bins:
            del self.by_space[space]
            self.spaces &= ~(1 << space)
        self.open -= 1
        return number


def pieces_of(counts: Iterable[int], size: int) -> Iterator[tuple[int, int, int, int]]:
    """(document, piece, start, length): documents longer than ``size`` are cut, others stay whole."""
    for k, n in enumerate(counts):
        for piece, start in enumerate(range(0, n, size)):
            yield k, piece, start, min(size, n - start)


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a block's texts with ``end_id`` after each, and their bounds."""
    return np.insert(ids, bounds[1:], np.uint32(end_id)).astype("<u4"), bounds + np.arange(len(bounds))


def pack(
    docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 1, open_bins: int = 4096, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), sequence_id, offset.

    Null and empty texts are ``end_id`` alone. Documents with the same or no id are packed one by one like others.
    Sequences are of one task each: a task leaves at most ``open_bins`` of them unfilled. Other columns are left out.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        encode, fit = encoder(tokenizer).encode, BestFit(size, open_bins)
        for batch in batches:
            for row, data, bounds in blocks(batch.column(1)):
                ids, bounds = with_end(*encode(data, bounds), end_id)
                at, piece, start, length = (np.array(x, np.int64) for x in zip(*pieces_of(np.diff(bounds).tolist(), size)))
                number, offset = (np.array(x, np.int64) for x in zip(*map(fit.place, length.tolist())))
                cuts = np.append(bounds[at] + start, len(ids)) * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row + at)),
                        pa.array(piece.astype(np.int32)),
                        int64(start),
                        int64(length),
                        pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(ids)]),
                        int64(first + number),
                        int64(offset),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"],
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(rows, SCHEMA)
