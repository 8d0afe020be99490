"""What repeated passages keep on disk while they are looked for."""

import random
import time

import pytest

from snaplake.llm import common, passages

KEPT = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(k).getName() for k in range(files.size()))
    return {x for x in names if x.startswith("shuffle_")}


def test_what_is_stored_leaves_no_shuffle_files(spark):
    kept = spark.conf.get(KEPT)
    before, frame = shuffle_files(spark), spark.range(50_000).selectExpr("id % 1000 as k", "id").repartition(7, "k")
    out, until = common.stored(frame, "test-shuffles"), time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and out.count() == 50_000
    assert spark.conf.get(KEPT) == kept


@pytest.mark.parametrize("hot", [1 << 12, 48])
def test_many_runs_are_shuffled_once(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(passages, "HOT_ROWS", hot)
    rng = random.Random(23)
    rows = [(rng.randrange(300) if k % 3 else 7, rng.randrange(50), rng.randrange(100), k % 2 == 0) for k in range(600)]
    met = passages._met(spark.createDataFrame(rows, passages.RUN))
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(run") == (2 if hot == 48 else 1)  # the other one has a row for each run and task
    assert met.count() == sum(doc != min(d for r, d, *_ in rows if r == run) for run, doc, *_ in rows)


def test_texts_go_only_where_they_are_compared(spark, monkeypatch):
    rng = random.Random(24)
    text = lambda n: ["".join(rng.choices("abcdefghij", k=6)) for _ in range(n)]
    one, two = text(70), text(70)
    docs = [(1, one), (2, one + text(20)), (3, text(20) + one + two), (4, text(9) + two)]
    seen, stored = {}, passages.stored
    monkeypatch.setattr(passages, "stored", lambda frame, name: seen.setdefault(name, stored(frame, name)))
    base = spark.createDataFrame([(k, " ".join(t)) for k, t in docs], "doc_id long, text string")
    seeds = [(0, 10, 0, 65, 10, 0, 65), (1, 10, 0, 65, 10, 0, 65)]
    shifted = lambda a, b: [(f, c + a, x + a, y + a, d + b, z + b, w + b) for f, c, x, y, d, z, w in seeds]
    pairs = [(1, 2, shifted(0, 0)), (1, 3, shifted(0, 20)), (3, 4, shifted(90, 9))]
    schema = f"a long, b long, seeds array<struct<{', '.join(f'{x}: int' for x in passages.SEED)}>>"
    found = passages._verified(base, spark.createDataFrame(pairs, schema), 50, 5, 2, 0.8).collect()
    assert sorted((r.first_doc_id, r.doc_id, r.words) for r in found) == [(1, 2, 70), (1, 3, 70), (3, 4, 70)]
    assert {r.doc_id: r.roles for r in seen["passage-texts"].collect()} == {1: 1, 2: 2, 3: 3, 4: 2}
