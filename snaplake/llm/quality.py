"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Texts become hashed counts of their words, of the words' shapes and of a few bands for how far the text repeats itself.
One weight vector is shared by all grades; ordered thresholds cut its scale, so that P(grade >= k) is
``sigmoid(w.x - threshold_k)``. Weights and thresholds are fitted together by full gradients. A document gets its
expected grade and the probability of a grade of at least the wanted one, by which it is selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import blocks, give_back, hash_pieces, mix, offsets_of, words
from snaplake.llm.labelled import fold, labelled_sample

TRAINING_ROWS = 20_000
DIMENSIONS = 1 << 16
_U = np.uint64

# Shapes: lower case, capitals, digits and letters beyond ASCII are one sign each; other signs stand for themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x61:0x7B] = ord("a")
_SHAPE[0x41:0x5B] = ord("A")
_SHAPE[0x30:0x3A] = ord("0")
_SHAPE[0x80:] = ord("a")


def hashed_texts(data: np.ndarray, bounds: np.ndarray, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indices, values, first of each text and the total): rows of unit length for the texts of a block."""
    n = len(bounds) - 1
    hashes, starts, ends, first = words(data, bounds)
    doc = np.repeat(np.arange(n), np.diff(first))
    shapes = _shapes(data, starts, ends)
    d, i = doc.astype(np.uint64), np.arange(n, dtype=np.uint64)
    place = lambda h: (mix(h) >> _U(32)) % _U(dimensions)
    key = lambda d, h: d << _U(32) | place(h)
    unique, counts = np.unique(np.concatenate([key(d, hashes), key(d, shapes ^ _U(0xA5A5A5A5))]), return_counts=True)
    # How much repeats: distinct words in ten bands, and the count of words in powers of two.
    pairs = np.unique(d << _U(32) | hashes >> _U(32)) >> _U(32)
    total = np.maximum(np.diff(first), 1)
    share = np.bincount(pairs.astype(np.int64), minlength=n) * 10 // total
    size = np.log2(total).astype(np.int64)
    extra = [key(i, (share + 1000).astype(np.uint64)), key(i, (size * 16 + share + 5000).astype(np.uint64))]
    keys = np.concatenate([unique, *extra])
    values = np.concatenate([np.sqrt(counts), *[np.sqrt(total) * 0.5] * 2])
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    row = (keys >> _U(32)).astype(np.int64)
    norm = np.sqrt(np.bincount(row, values * values, n))
    return (keys & _U(0xFFFFFFFF)).astype(np.int32), (values / norm[row]).astype(np.float32), np.searchsorted(row, np.arange(n + 1))


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's shape, with runs of one sign drawn together."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    shape = _SHAPE[data]
    kept = np.zeros(len(data) + 1, np.int64)
    fresh = np.ones(len(data), bool)
    fresh[1:] = shape[1:] != shape[:-1]
    fresh[starts] = True
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    fresh &= np.cumsum(inside[:-1]) > 0
    kept[1:] = np.cumsum(fresh)
    return hash_pieces(shape[fresh], kept[ends] - kept[starts])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Ordinal:
    """``grades`` ascending; P(grade >= grades[k + 1]) = sigmoid(w.x - thresholds[k])."""

    grades: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, indices: np.ndarray, values: np.ndarray, first: np.ndarray) -> np.ndarray:
        """P(grade >= k-th grade) for each text, from the second grade on."""
        sums = np.concatenate([[0.0], np.cumsum(self.weights[indices] * values)])
        return _sigmoid((sums[first[1:]] - sums[first[:-1]])[:, None] - self.thresholds)


def fit_ordinal(
    indices: np.ndarray, values: np.ndarray, first: np.ndarray, grades: np.ndarray, dimensions: int = DIMENSIONS,
    steps: int = 60, rate: float = 0.3, ridge: float = 1e-5,
) -> Ordinal:
    """Maximum likelihood with a ridge, by Adam on full gradients. Thresholds are the first and logs of the gaps, so
    they stay in order. With one grade, or none, every document gets it."""
    kinds, y = np.unique(grades, return_inverse=True)
    n, k = len(y), len(kinds) - 1
    if k < 1:
        return Ordinal(kinds if len(kinds) else np.array([0]), np.zeros(dimensions), np.zeros(0))
    above = np.array([(y > j).mean() for j in range(k)])
    start = -np.log(above / (1 - above))
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    theta = np.concatenate([np.zeros(dimensions), start[:1], gaps])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    # Rows of about a quarter of a million values at a time, so that no array is as long as all of them.
    cuts = np.unique(np.append(np.searchsorted(first, np.arange(0, first[-1], 1 << 18), "left"), n))
    parts = [(int(a), int(b), slice(int(first[a]), int(first[b]))) for a, b in zip(np.append(0, cuts), cuts) if b > a]
    for step in range(1, steps + 1):
        w, t = theta[:dimensions], np.cumsum(np.concatenate([theta[dimensions : dimensions + 1], np.exp(theta[dimensions + 1 :])]))
        s = np.zeros(n)
        for a, b, own in parts:
            s[a:b] = np.bincount(np.repeat(np.arange(b - a), np.diff(first[a : b + 1])), w[indices[own]] * values[own], b - a)
        # P(y) = F(upper) - F(lower) of the cumulative links that stand around the grade.
        low = _sigmoid(np.append(t, np.inf)[y] - s)
        high = np.where(y > 0, _sigmoid(np.insert(t, 0, -np.inf)[y] - s), 0.0)
        low = np.where(y < k, low, 1.0)
        p = np.maximum(low - high, 1e-9)
        dlow, dhigh = np.where(y < k, low * (1 - low), 0.0), high * (1 - high)
        ds = (dlow - dhigh) / p / n  # gradient of the negative log likelihood in s
        dt = np.zeros(k)
        np.add.at(dt, y[y < k], -(dlow / p / n)[y < k])
        np.add.at(dt, y[y > 0] - 1, (dhigh / p / n)[y > 0])
        tail = np.cumsum(dt[::-1])[::-1]
        gw = ridge * w
        for a, b, own in parts:
            gw += np.bincount(indices[own], np.repeat(ds[a:b], np.diff(first[a : b + 1])) * values[own], dimensions)
        g = np.concatenate([gw, tail[:1], tail[1:] * np.exp(theta[dimensions + 1 :])])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    t = np.cumsum(np.concatenate([theta[dimensions : dimensions + 1], np.exp(theta[dimensions + 1 :])]))
    return Ordinal(kinds, theta[:dimensions], t)


def ratings(labels: DataFrame) -> DataFrame:
    """The given labels as grades: 0 for bad quality, 1 for good but toxic, 2 for good."""
    good = F.when(F.col("quality") > 0, F.when(F.coalesce("toxic", F.lit(0)) > 0, 1).otherwise(2)).when(F.col("quality") <= 0, 0)
    return labels.select("doc_id", good.alias("grade"))


def fit(docs: DataFrame, rated: DataFrame, grade: Column | None = None, training_rows: int = TRAINING_ROWS) -> Ordinal:
    """Learns from at most ``training_rows`` rated documents outside the held-out fold, whose hashed counts are read
    into the driver. Null ratings don't count; of an id's several ratings the highest holds."""
    sample = labelled_sample(docs, rated, F.col("grade") if grade is None else grade, training_rows)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, bounds in blocks(batch.column(0)):
                indices, values, first = hashed_texts(data, bounds)
                n = len(bounds) - 1
                cut = lambda a: pa.array([a[x:y].tobytes() for x, y in zip(first[:-1], first[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(row, n), batch.column(2).slice(row, n), cut(indices), cut(values)], names=["doc_id", "grade", "i", "v"]
                )

    hashed = sample.select("text", "doc_id", F.col("label").cast("double").alias("grade"))
    got = hashed.mapInArrow(rows, "doc_id long, grade double, i binary, v binary").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("grade", "ascending")]).combine_chunks()
    indices, bounds = offsets_of(got["i"])
    values, _ = offsets_of(got["v"])
    grades = got["grade"].to_numpy().astype(float)
    del got
    model = fit_ordinal(indices[bounds[0] : bounds[-1]].view(np.int32), values[bounds[0] : bounds[-1]].view(np.float32), (bounds - bounds[0]) // 4, grades)
    del indices, values
    give_back()
    return model


def rate(docs: DataFrame, model: Ordinal, wanted: float = 1, least: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, expected_grade, tail (the probability of a grade of ``wanted`` or more), selected (a tail of
    ``least`` or more) for each document. Null texts are rated as empty ones. Other columns are left out."""
    judge = _judge(model, wanted)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, bounds in blocks(batch.column(1)):
                expected, tail = judge(data, bounds)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(tail)), pa.array(expected), pa.array(tail)], names=["doc_id", "expected_grade", "tail"])

    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rated = base.mapInArrow(rows, "doc_id long, expected_grade double, tail double")
    held_out = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False))
    return rated.select("doc_id", held_out.alias("held_out"), "expected_grade", "tail", (F.col("tail") >= least).alias("selected"))


def _judge(model: Ordinal, wanted: float):
    k = int(np.searchsorted(model.grades, wanted))  # the first grade that is high enough

    def judge(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tails = model.tails(*hashed_texts(data, bounds))
        expected = model.grades[0] + tails @ np.diff(model.grades)
        tail = np.ones(len(tails)) if k == 0 else tails[:, k - 1] if k < len(model.grades) else np.zeros(len(tails))
        return expected.astype(np.float64), tail

    return judge


def select_documents(docs: DataFrame, model: Ordinal, wanted: float = 1, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose tail is ``least`` or more. Nothing is joined: whole rows pass
    the classifier."""
    judge, at = _judge(model, wanted), docs.columns.index(text)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [judge(data, bounds)[1] >= least for _, data, bounds in blocks(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate(kept) if kept else np.zeros(0, bool)))

    return docs.mapInArrow(rows, docs.schema)
