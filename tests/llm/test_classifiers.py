"""Quality and toxicity: held-out accuracy on the given labels, and the fitting against simple truths."""

import numpy as np
import pytest

from snaplake.llm import boosting, quality, toxicity
from snaplake.llm.common import table
from snaplake.llm.queries import QUERIES

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}


def test_op10_held_out(spark, labels):
    rows = QUERIES["op10_toxicity"](spark, DATA).collect()
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r, labels[r.doc_id].toxic) for r in rows if r.held_out and r.doc_id in labels]
    hits = sum(r.predicted and t for r, t in held)
    # Some of the given labels mark junk without an insult; a random guess would hit one in eight.
    assert hits / sum(t for _, t in held) > 0.9
    assert hits / sum(r.predicted for r, _ in held) > 0.95


def test_op1_held_out(spark, labels):
    rows = QUERIES["op1_quality"](spark, DATA).collect()
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    held = [(r, labels[r.doc_id].quality) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [r for r, q in held if q], [r for r, q in held if not q]
    assert sum(r.selected for r in good) / len(good) > 0.98
    assert sum(r.selected for r in bad) / len(bad) < 0.1
    assert np.mean([r.expected_grade for r in good]) > np.mean([r.expected_grade for r in bad]) + 1


def test_select_is_rate(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = quality.fit(docs, quality.ratings(table(spark, "/root/testdata/sf0.001", "labels")))
    kept = quality.select_documents(docs, model)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.rate(docs, model).filter("selected").collect()}


def test_ordinal_recovers_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    w = np.array([1.5, -1, 0.5, 0, 0])
    y = np.digitize(x @ w + rng.logistic(size=4000), [-1, 0.5, 2])
    model = quality.fit_ordinal(np.tile(np.arange(5, dtype=np.int32), 4000), x.ravel(), np.arange(4001) * 5, y, 5, steps=300)
    assert np.abs(model.weights - w).max() < 0.15 and np.abs(model.thresholds - [-1, 0.5, 2]).max() < 0.2
    tails = model.tails(np.arange(5, dtype=np.int32), x[0], np.array([0, 5]))
    assert (np.diff(tails[0]) < 0).all()


def test_ordinal_with_one_grade_or_none():
    for grades in ([], [3.0, 3.0]):
        model = quality.fit_ordinal(np.zeros(len(grades), np.int32), np.ones(len(grades)), np.arange(len(grades) + 1), np.array(grades))
        assert model.tails(np.zeros(1, np.int32), np.ones(1), np.array([0, 1])).shape == (1, 0)


def test_trees_and_calibration():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = boosting.fit_trees(x[:2000], y[:2000])
    assert ((trees.margin(x[2000:]) > 0) == y[2000:]).mean() > 0.97
    assert boosting.fit_trees(x[:0], y[:0]).margin(x[:3]).tolist() == [0.0] * 3
    assert len(boosting.fit_trees(x, np.ones(3000)).leaves) == 0
    xs, ys = boosting.fit_isotonic(np.array([1, 2, 3, 4, 4, 5.0]), np.array([0, 1, 0, 1, 1, 1.0]))
    assert (np.diff(xs) > 0).all() and (np.diff(ys) >= 0).all() and 0 < ys.min() and ys.max() < 1


def odd(spark):
    rows = [(1, None, 0), (2, "", 1), (None, "you idiot", 1), (4, "word " * 30_000, 0), (4, "a twin", 0), (6, "ÄÖÜ ñ 日本 " * 3, 0), (7, "\n\t ", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def test_odd_rows(spark):
    docs = odd(spark)
    tox = toxicity.fit(docs, docs.select("doc_id", docs.label.alias("toxic")))
    rows = toxicity.score(docs, tox).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    model = quality.fit(docs, docs.select("doc_id", docs.label.alias("grade")))
    assert len(quality.rate(docs, model).collect()) == 7
    assert quality.select_documents(docs, model).columns == docs.columns
    empty, none = docs.limit(0), docs.limit(0).select("doc_id", docs.label.alias("toxic"))
    assert toxicity.score(empty, toxicity.fit(empty, none)).count() == 0
    model = quality.fit(empty, none.withColumnRenamed("toxic", "grade"))
    assert quality.rate(docs, model).count() == 7 and quality.select_documents(empty, model).count() == 0


def test_features_near_second_person():
    lexicon = toxicity.Lexicon(toxicity._hash_words(["idiot"]), np.ones(1))
    texts = ["you are an idiot", "x x x x x x x x x idiot", "the 1D10T here", "", "IDIOT!! IDIOT!!"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    x = lexicon.features(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    f = {n: x[:, k] for k, n in enumerate(toxicity.FEATURES)}
    assert f["near_second_person"].tolist() == [0.25, 0, 0, 0, 0]
    assert (f["word_density"] > 0).tolist() == [True, True, True, False, True]
    assert f["obfuscation"][2] > 0 and f["exclamations"][4] > 0.1 and f["capital_words"][4] == 1 and not x[3].any()
