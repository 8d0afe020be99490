"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The lexicon is learned: words, and beginnings of words for languages that inflect, that toxic documents of the training
rows have far more often than others. A text's features are the densities of its lexicon words, how many of them stand
near a word of the second person, and rates of capitals, punctuation and obfuscation. Training rows are parted by
their ids, so that the trees learn from features that a lexicon of other rows makes, and the calibration from rows that
the trees haven't seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplake.llm.boosting import Trees, fit_isotonic, fit_trees
from snaplake.llm.common import blocks, hash_pieces, int64, stored
from snaplake.llm.labelled import fold, labelled_sample

TRAINING_ROWS = 20_000
LEXICON_ROWS = 4_096
STARTS = (4, 5, 6)  # bytes of the beginnings of words
NEAR = 6

# Words of the second person in English, German, French and Spanish.
SECOND_PERSON = "you your yours yourself du dich dir dein deine deiner ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros".split()

FEATURES = (
    "word_density", "start_density", "weight_density", "highest_weight", "second_weight", "hits", "distinct_hits", "near_second_person",
    "second_person", "capitals", "capital_words", "exclamations", "questions", "punctuation", "obfuscation", "digits", "repeats", "word_length", "length",
)

_WORD = np.zeros(256, bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _WORD[_a:_b] = True
_WORD[[ord("@"), ord("$"), ord("*")]] = True
_UPPER, _ASCII_LETTER, _DIGIT = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_ASCII_LETTER[0x41:0x5B] = _ASCII_LETTER[0x61:0x7B] = True
_DIGIT[0x30:0x3A] = True
_MASK = np.zeros(256, bool)
_MASK[[ord("@"), ord("$"), ord("*"), *range(0x30, 0x3A)]] = True
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[0x21:0x7F] = True
_PUNCTUATION &= ~(_ASCII_LETTER | _DIGIT)
# Lower case, with the signs that stand for letters put back.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
for _a, _b in zip("0134578@$", "oieastbas"):
    _FOLD[ord(_a)] = ord(_b)
_TAGS = np.arange(1, 8, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys: a row for each word with its hash and those of its beginnings, 0 where it's too short; starts; ends;
    first word of each text)."""
    solid = _WORD[data]
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = solid[1:] != solid[:-1]
    cut[bounds] = True
    starts, ends = np.flatnonzero(solid & cut[:-1]), np.flatnonzero(solid & cut[1:]) + 1
    lengths, folded = ends - starts, _FOLD[data]
    keys = np.zeros((len(starts), 1 + len(STARTS)), np.uint64)
    keys[:, 0] = hash_pieces(folded[solid], lengths)
    for k, n in enumerate(STARTS, 1):
        long = np.flatnonzero(lengths >= n)
        at = (starts[long][:, None] + np.arange(n)).ravel()
        keys[long, k] = hash_pieces(folded[at], np.full(len(long), n)) ^ _TAGS[k]
    return keys, starts, ends, np.searchsorted(starts, bounds)


def _hash_words(words: list[str]) -> np.ndarray:
    parts = [w.encode("utf-8") for w in words]
    return np.sort(hash_pieces(np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts])))


_SECOND = _hash_words(SECOND_PERSON)


def _lookup(keys: np.ndarray, table: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(keys.shape)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, values[at], 0.0)


@dataclass
class Lexicon:
    keys: np.ndarray  # ascending
    weights: np.ndarray

    def features(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """A row of FEATURES for each text of a block."""
        n = len(bounds) - 1
        keys, starts, ends, first = terms(data, bounds)
        doc = np.repeat(np.arange(n), np.diff(first))
        per = lambda v: np.bincount(doc, v, n)
        at = np.repeat(np.arange(n), np.diff(bounds))
        chars = lambda m: np.bincount(at[m], minlength=n).astype(float)
        count, size = np.maximum(np.diff(first), 1), np.maximum(np.diff(bounds), 1)
        weights = _lookup(keys, self.keys, self.weights)
        weight = weights.max(1, initial=0)
        hit = weight > 0
        second = np.isin(keys[:, 0], _SECOND)
        # Words since the last, and to the next, word of the second person, in the same text or not.
        where = np.append(np.flatnonzero(second), 1 << 40)
        k = np.searchsorted(where, np.arange(len(doc)))
        after, before = where[np.minimum(k, len(where) - 1)], where[np.maximum(k - 1, 0)]
        word = np.arange(len(doc))
        near = hit & (((after - word <= NEAR) & (after < first[doc + 1])) | ((word - before <= NEAR) & (word >= before) & (before >= first[doc])))
        highest = np.zeros(n)
        np.maximum.at(highest, doc, weight)
        runner = np.zeros(n)
        below = np.where(weight < highest[doc], weight, 0)
        np.maximum.at(runner, doc, below)
        pairs = np.unique(np.stack([doc[hit].astype(np.uint64), keys[hit, 0]], 1), axis=0) if hit.any() else np.zeros((0, 2), np.uint64)
        mask = np.concatenate([[0], np.cumsum(_MASK[data])])
        letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
        upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
        masked = (mask[ends] > mask[starts]) & (letters[ends] - letters[starts] > 1)
        shouted = (upper[ends] - upper[starts] == ends - starts) & (ends - starts > 1)
        same = np.zeros(len(data), bool)
        same[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & ~_SPACES[data[2:]]
        return np.stack(
            [
                per(weights[:, 0] > 0) / count, per(weights[:, 1:].max(1, initial=0) > 0) / count, per(weight) / count, highest, runner,
                np.log1p(per(hit)), np.log1p(np.bincount(pairs[:, 0].astype(np.int64), minlength=n)), per(near) / count,
                per(second) / count, chars(_UPPER[data]) / size, per(shouted) / count, chars(data == ord("!")) / size, chars(data == ord("?")) / size,
                chars(_PUNCTUATION[data]) / size, per(masked) / count, chars(_DIGIT[data]) / size, chars(same) / size, per(ends - starts) / count,
                np.log1p(np.diff(first)),
            ],
            axis=1,
        )


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees
    scores: np.ndarray
    probabilities: np.ndarray

    def score(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        margin = self.trees.margin(self.lexicon.features(data, bounds))
        # Beyond the steps, a little of the margin keeps the order of scores within one step.
        p = np.interp(margin, self.scores, self.probabilities) if len(self.scores) else 1 / (1 + np.exp(-margin))
        return np.clip(p * 0.98 + 0.02 / (1 + np.exp(-margin)), 0, 1)


def learn_lexicon(sample: DataFrame, most: int = LEXICON_ROWS, least: int = 3, ratio: float = 4.0) -> Lexicon:
    """The ``most`` words and beginnings with the highest weight: in ``least`` toxic documents or more, and ``ratio``
    times as frequent in toxic documents as in others. Document frequencies are counted as a Spark job."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy()
            for row, data, bounds in blocks(batch.column(0)):
                keys, _, _, first = terms(data, bounds)
                own = [np.setdiff1d(keys[a:b], [np.uint64(0)]) for a, b in zip(first[:-1], first[1:])]
                sizes = [len(k) for k in own]
                yield pa.RecordBatch.from_arrays(
                    [int64(np.concatenate(own).astype(np.uint64)), int64(np.repeat(toxic[row : row + len(own)], sizes))], names=["key", "toxic"]
                )

    totals = sample.groupBy("label").count().collect()
    bad = sum(r["count"] for r in totals if r["label"] == 1)
    good = sum(r["count"] for r in totals if r["label"] != 1)
    counted = (
        sample.select("text", F.col("label").cast("long").alias("toxic")).mapInArrow(rows, "key long, toxic long")
        .groupBy("key").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    )
    weight = F.log((F.col("bad") + 0.5) / (bad + 1) / ((F.col("good") + 0.5) / (good + 1)))
    best = counted.withColumn("weight", weight).filter((F.col("bad") >= least) & (F.col("weight") >= float(np.log(ratio))))
    best = best.orderBy(F.desc(F.col("weight") * F.sqrt("bad")), "key").limit(most).toPandas().sort_values("key")
    keys = best["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Lexicon(keys[order], best["weight"].to_numpy(float)[order])


def fit(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS, label: str = "toxic") -> Model:
    """Learns from at most ``training_rows`` labelled documents outside the held-out fold; of each, the driver gets a
    row of features. Features for fitting come from a lexicon that the other half of the documents made, so that trees
    don't trust a lexicon that knows their rows; the model's own lexicon is of all. Three quarters fit the trees and
    one quarter the calibration; with fewer than 200 of these, all do both."""
    sample = stored(labelled_sample(docs, labels, (F.col(label) > 0).cast("int"), training_rows), "toxicity-sample")
    halves = [learn_lexicon(sample.filter(F.col("part") % 2 == k)) for k in (0, 1)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column(3).to_numpy()
            for row, data, bounds in blocks(batch.column(0)):
                even, odd = (h.features(data, bounds) for h in halves)
                n = len(even)
                x = np.where((part[row : row + n] % 2 == 0)[:, None], odd, even)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(row, n), batch.column(2).slice(row, n), batch.column(3).slice(row, n), pa.array([r.tobytes() for r in x])],
                    names=["doc_id", "label", "part", "x"],
                )

    got = sample.select("text", "doc_id", "label", "part").mapInArrow(rows, "doc_id long, label int, part int, x binary").toPandas()
    got = got.sort_values(["doc_id", "label", "x"])
    x = np.frombuffer(b"".join(map(bytes, got["x"])), np.float64).reshape(-1, len(FEATURES))
    y, steps = got["label"].to_numpy(float), got["part"].to_numpy() == 3
    if steps.sum() < 200 or y[steps].min() == y[steps].max():
        trees, steps = fit_trees(x, y), np.ones(len(y), bool)
    else:
        trees = fit_trees(x[~steps], y[~steps])
    return Model(learn_lexicon(sample), trees, *fit_isotonic(trees.margin(x[steps]), y[steps]))


def score(docs: DataFrame, model: Model, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for each document. Null texts score as empty ones; rows without an id are
    scored and count as not held out. Other columns are left out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, bounds in blocks(batch.column(1)):
                p = model.score(data, bounds)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(p)), pa.array(p)], names=["doc_id", "score"])

    scored = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(rows, "doc_id long, score double")
    held_out = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
