"""The pipeline, stage by stage against what each is to do with its own input."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_near_dedup import brute
from test_tokens import packed_well

from snaplake.llm import decontaminate, passages, quality
from snaplake.llm.common import stored, table

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """The input of each stage, and the last one's result."""
    docs = [table(spark, DATA, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], DATA), "test"))
    return docs


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "MinHash near-dedup", "substring dedup", "benchmark decontamination", "best-fit packing",
    ]


def test_all_but_the_last_return_documents(steps):
    for docs in steps[1:-1]:
        assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in steps[0].schema]
        assert docs.count() == docs.select("doc_id").distinct().count()


def test_quality_stage(spark, steps):
    before, after = rows(steps[0]), rows(steps[1])
    assert all(before[k] == r for k, r in after.items())
    labels = {r.doc_id: r.quality for r in table(spark, DATA, "labels").collect()}
    good, bad = [k for k, q in labels.items() if q], [k for k, q in labels.items() if not q]
    assert sum(k in after for k in good) >= 0.98 * len(good) and sum(k in after for k in bad) <= 0.1 * len(bad)
    model = quality.fit(table(spark, DATA, "documents"), quality.ratings(table(spark, DATA, "labels")))
    assert after.keys() == {r.doc_id for r in quality.rate(steps[0], model).filter("selected").collect()}


def test_near_dedup_stage(steps):
    before, after = rows(steps[1]), rows(steps[2])
    want = {k for k, _, _, kept in brute([(k, r.text) for k, r in before.items()], 80) if kept}
    assert after.keys() == want and all(before[k] == r for k, r in after.items())


def test_substring_stage(steps):
    before, after = rows(steps[2]), rows(steps[3])
    assert before.keys() == after.keys()
    found = {}
    for r in passages.repeated_passages(steps[2]).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.start + r.length))
    for k, r in before.items():
        spans, kept, done = sorted(found.get(k, [])), [], 0
        for a, b in spans:
            kept.append(r.text[done : max(done, a)])
            done = max(done, b)
        assert after[k].text == "".join(kept) + r.text[done:]
        assert (after[k].lang, after[k].source) == (r.lang, r.source)
    assert found
    # No run of 60 words is left that an earlier document has.
    seen, left, runs = {}, 0, 0
    for k in sorted(after):
        w = after[k].text.lower().split()
        own = {tuple(w[i : i + 60]) for i in range(len(w) - 59)}
        left += sum(seen.get(x, k) != k for x in own)
        runs += len(own)
        seen.update(dict.fromkeys(own - seen.keys(), k))
    assert left <= 0.0005 * runs


def test_decontamination_stage(spark, steps):
    before, after = rows(steps[3]), rows(steps[4])
    leaks = {r.doc_id for r in decontaminate.benchmark_passages(steps[3], table(spark, DATA, "benchmark")).collect()}
    assert after.keys() == before.keys() - leaks and all(before[k] == r for k, r in after.items())
    items = [" ".join(r.text.lower().split()) for r in table(spark, DATA, "benchmark").collect()]
    texts = [" ".join(r.text.lower().split()) for r in after.values()]
    assert not any(i in t for i in items for t in texts)


def test_packing_stage(steps):
    docs = [(r.doc_id, r.text) for r in steps[4].collect()]
    pieces = steps[5].withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    n = packed_well([r.asDict() for r in pieces.collect()], docs)
    assert n <= pieces.agg(F.sum("length")).first()[0] / 4096 * 1.05 + 2


def test_run_is_its_stages(spark, steps):
    key = ["doc_id", "piece", "start", "length", "ids"]
    got, want = corpus_pipeline.run(spark, DATA).select(key), steps[5].select(key)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_odd_tables(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, and columns that clash with what the operators make."""
    odd = [
        (None, "some words of a text without an id that is kept " * 5, "en", "s", 1), (1, None, None, None, None), (2, "", "en", "s", 0),
        (3, "same text again " * 30, "en", "s", 9), (3, "same text again " * 30, "en", "s", 9), (4, "w" * 100_000, "en", "s", 100_000),
        (5, "long " * 50_000, "en", "s", 250_000),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = spark.createDataFrame(odd, schema).withColumns({c: F.lit("x") for c in ("key", "node", "spans", "component", "part", "ids", "digest", "__doc", "__hash", "__spans", "__gone")})
    for name, frame in (("full", full), ("empty", full.limit(0))):
        folder = f"{tmp_path}/{name}"
        frame.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (3, 0, 1), (9, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        docs = table(spark, folder, "documents")
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            after = stored(stage(spark, docs, folder), "odd")
            assert k == 4 or after.columns == docs.columns
            assert name != "empty" or after.count() == 0
            docs = after
