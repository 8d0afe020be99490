"""How many rows the steps of repeated passages make, and that those of few and of many runs are the same."""

import random

import pytest
from pyspark.sql import functions as F

from snaplake.llm import common, passages


def test_two_documents_make_a_row_however_many_windows_they_share(spark):
    rng = random.Random(21)
    text = lambda n: ["".join(rng.choices("abcdefghij", k=6)) for _ in range(n)]
    passage = text(400)
    docs = [(k, " ".join(text(60) + passage + text(60))) for k in range(40)]
    base = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    met = passages.candidates(base, 50, 5, 4, 8).cache()
    pairs = met.select("a", "b").distinct().count()
    assert pairs >= 39 and met.count() == pairs
    seeds = met.select("a", "b", "fs", F.explode("seeds").alias("s"))
    assert seeds.count() >= 20 * 39
    bits = seeds.groupBy("a", "b").agg(F.bit_or("fs").alias("fs"), F.collect_set("s.f").alias("f")).collect()
    assert all(r.fs == sum(1 << f for f in r.f) for r in bits)
    met.unpersist()


@pytest.mark.parametrize("few, hot", [(1 << 20, 1 << 12), (0, 1 << 12), (0, 5)])
def test_first_met_against_all_pairs(spark, monkeypatch, few, hot):
    monkeypatch.setattr(common, "BROADCAST_ROWS", few)
    monkeypatch.setattr(passages, "HOT_ROWS", hot)
    rng = random.Random(22)
    rows = [(rng.randrange(300) if k % 3 else 7, rng.randrange(50), rng.randrange(100), k % 2 == 0) for k in range(600)]
    first, want = {}, []
    for run, doc, c, _ in rows:
        first[run] = min(first.get(run, (doc, c)), (doc, c))
    for run, doc, c, is_open in rows:
        if doc != first[run][0]:
            want.append((first[run][0], doc, first[run][1], c, is_open))
    met = passages._met(spark.createDataFrame(rows, passages.RUN))
    assert sorted(tuple(r) for r in met.collect()) == sorted(want)
    if few:  # all rows were once passed through a join just to leave out those of very frequent runs
        assert "LeftAnti" not in met._jdf.queryExecution().optimizedPlan().toString()
    assert passages._met(spark.createDataFrame([], passages.RUN)).count() == 0
