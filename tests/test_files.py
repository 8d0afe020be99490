"""Slices of file tables: which files they open, how even they are; profiles of many tables."""

import bisect
import functools
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from checks.tables import CFG, new_sink
from snaplake import FileSource, FileTable, MYSQL, POSTGRESQL, load_table, plan_source
from snaplake.operators.load import target_of
from snaplake.plans import even
from snaplake.sources.files import MAX_STEPS
from snaplake.workspace import shared_dir


def opened(df):
    """Files that the scans of a plan open."""
    return {f.toPath().toString() for p in df._jdf.queryExecution().toRdd().partitions() for f in p.files()}


def of(spark, frame, keys, **options):
    folder = shared_dir(spark, "given")
    frame.write.parquet(folder)
    src = FileSource(spark, MYSQL, {("shop", "t"): FileTable(folder, keys)}, **options)
    return src, plan_source(src, CFG).first()


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_key_slice_opens_the_files_that_overlap_it(spark):
    rows = spark.range(4_000).withColumn("x", F.col("id") * 2).repartitionByRange(8, "id")
    src, entry = of(spark, rows, ("id",), slice_by="plan")
    assert (entry["strategy"], entry["batches"]) == ("range_batches", 8)
    pieces = src.pieces(entry)
    files = [opened(src.read_slice(entry, p)) for p in pieces]
    assert max(map(len, files)) <= 3 and len(set().union(*files)) == 8 and sum(map(len, files)) <= 16
    sink = new_sink(spark)
    assert load_table(src, sink, entry, publish="incremental") == 4_000
    assert same_rows(sink.read(target_of(src, "shop", "t")), rows)


def test_rows_beyond_the_profile_and_null_keys_are_in_a_slice(spark):
    rows = spark.range(2_000).selectExpr("IF(id % 100 = 0, NULL, id) AS id", "id AS x").repartition(6)
    src, entry = of(spark, rows, ("id",), slice_by="plan")
    spark.range(-50, 0).selectExpr("id", "id AS x").union(spark.range(9_000, 9_050).selectExpr("id", "id AS x")).write.mode("append").parquet(src.tables["shop", "t"].path)
    src = FileSource(spark, MYSQL, src.tables, slice_by="plan")
    parts = [src.read_slice(entry, p) for p in src.pieces(entry)]
    assert sum(p.count() for p in parts) == 2_100 and parts[0].filter("id IS NULL").count() == 20


def test_paths_with_spaces_and_signs(spark):
    folder = shared_dir(spark, "odd names") + "/a b%20c+d"
    spark.range(2_000).repartitionByRange(4, "id").write.parquet(folder)
    src = FileSource(spark, MYSQL, {("shop", "t"): FileTable(folder, ("id",))}, slice_by="plan")
    entry = plan_source(src, CFG).first()
    assert sum(src.read_slice(entry, p).count() for p in src.pieces(entry)) == 2_000


def test_file_groups_are_of_about_equal_bytes(spark):
    rows = spark.range(40_000).withColumn("h", F.sha2(F.col("id").cast("string"), 256)).repartition(16)
    src, entry = of(spark, rows, ("id",))
    entry = Row(**entry.asDict() | {"batches": 5})
    pieces = src.pieces(entry)
    files = [opened(src.read_slice(entry, p)) for p in pieces]
    assert [p["slice_no"] for p in pieces] == [0, 1, 2, 3, 4] and sorted(map(len, files)) == [3, 3, 3, 3, 4]
    assert len(set().union(*files)) == 16
    with pytest.raises(ValueError):
        FileSource(spark, MYSQL, {}, slice_by="rows")


@pytest.mark.parametrize("keys", ["pow(id, 3)", "cast(pow(id % 37, 2) as bigint)", "if(id < 3000, 7, id)", "-id * 1000000007"])
def test_even_slices_cover_the_table_evenly(spark, keys):
    rows = spark.range(9_000).selectExpr(f"CAST({keys} AS bigint) AS k", "id AS line").repartitionByRange(6, "k", "line")
    src, entry = of(spark, rows, ("k", "line"), slice_by="even")
    entry = Row(**entry.asDict() | {"strategy": "range_batches", "batches": 18})
    pieces = src.pieces(entry)
    parts = [src.read_slice(entry, p) for p in pieces]
    counts = [p.count() for p in parts]
    assert len(counts) == 18 and sum(counts) == 9_000 and 475 <= min(counts) <= max(counts) <= 525
    tie = even.tie_of(["line"], even.tie_bits(entry["lo"], entry["hi"]))
    numbers = src.scan("shop", "t").groupBy(even.slice_of(F.col("k"), tie, [p["low"] for p in pieces[1:]]).alias("s")).count()
    assert {r["s"]: r["count"] for r in numbers.collect()} == dict(enumerate(counts))


def test_even_slices_in_two_rounds(spark, monkeypatch):
    monkeypatch.setattr(even, "AT_ONCE", 6)
    rows = spark.range(6_000).selectExpr("CAST(pow(id, 2) AS bigint) AS k", "id AS line")
    found = even.even_boundaries(rows, "k", 0, 5_999**2, 30, ["line"])
    counts = [r["count"] for r in rows.groupBy(even.slice_of(F.col("k"), F.lit(0), found).alias("s")).count().collect()]
    assert len(counts) == 30 and 180 <= min(counts) <= max(counts) <= 220


def test_numbering_by_many_boundaries_is_a_small_expression(spark):
    bounds = [even.Boundary(3 * (i // 2), 5 * (i % 2)) for i in range(4_000)]
    rows = spark.range(-1, 6_002).selectExpr("IF(id < 0, NULL, id) AS k", "id % 7 AS t")
    numbered = rows.select("k", "t", even.slice_of(F.col("k"), F.col("t"), bounds).alias("s"))
    nodes = numbered._jdf.queryExecution().analyzed().expressions().head().treeString().count("\n")
    assert nodes < 60
    for r in numbered.collect():
        assert r["s"] == (0 if r["k"] is None else bisect.bisect_right(bounds, (r["k"], r["t"]), key=lambda b: (b.key, b.tie)))


def test_two_rounds_give_as_many_slices_as_asked_for(spark, monkeypatch):
    monkeypatch.setattr(even, "AT_ONCE", 6)
    rows = spark.range(6_200).selectExpr("CAST(pow(id, 2) AS bigint) AS k", "id AS line")
    found = even.even_boundaries(rows, "k", 0, 6_199**2, 31, ["line"])
    counts = [r["count"] for r in rows.groupBy(even.slice_of(F.col("k"), F.lit(0), found).alias("s")).count().collect()]
    assert len(counts) == 31 and 180 <= min(counts) <= max(counts) <= 220


def test_even_slices_of_odd_keys(spark):
    rows = spark.createDataFrame([(-(2**63), 1), (2**63 - 1, 2), (0, 3), (None, 4)] * 50, "k long, x long")
    found = even.even_boundaries(rows, "k", -(2**63), 2**63 - 1, 3, ["x"])
    tie = even.tie_of(["x"], even.tie_bits(-(2**63), 2**63 - 1))
    counts = {r["s"]: r["count"] for r in rows.groupBy(even.slice_of(F.col("k"), tie, found).alias("s")).count().collect()}
    assert sum(counts.values()) == 200 and 2 <= len(counts) <= 3
    assert even.even_boundaries(rows.limit(0), "k", 0, 0, 5) == [] and even.even_boundaries(rows, "k", 0, 5, 1) == []
    same = spark.range(1_000).selectExpr("5L AS k")
    assert len(even.even_boundaries(same, "k", 5, 5, 4)) <= 1  # nothing to cut one key by


def test_only_changed_tables_are_profiled_anew(spark, monkeypatch):
    kept, folder = shared_dir(spark, "profiles") + "/profiles.json", shared_dir(spark, "many")
    tables = {("shop", f"t{k}"): FileTable(f"{folder}/t{k}", ("id",)) for k in range(12)}
    for k in range(12):
        spark.range(100 + k).write.parquet(f"{folder}/t{k}")
    profiled = []
    of_one = FileSource._profile_one
    monkeypatch.setattr(FileSource, "_profile_one", lambda self, key: profiled.append(key["table"]) or of_one(self, key))

    def planned():
        profiled.clear()
        started = time.perf_counter()
        plan = plan_source(FileSource(spark, MYSQL, dict(tables), profiles=kept), CFG).collect()
        return {r["table"]: (r["rows"], r["hi"]) for r in plan}, time.perf_counter() - started

    first, _ = planned()
    assert first == {f"t{k}": (100 + k, 99 + k) for k in range(12)} and len(profiled) == 12
    again, seconds = planned()
    assert again == first and profiled == [] and seconds < 2
    time.sleep(0.01)
    spark.range(5_000, 5_010).write.mode("append").parquet(f"{folder}/t3")
    changed, _ = planned()
    assert profiled == ["t3"] and changed == first | {"t3": (113, 5_009)}
    tables["shop", "t3"] = FileTable(f"{folder}/t3")  # other keys make another profile
    assert planned()[0]["t3"] == (113, 0) and profiled == ["t3"]


@pytest.mark.parametrize("dialect, keys, strategy, slice_by", [
    (MYSQL, ("id",), "range_batches", "plan"), (MYSQL, ("id",), "range_batches", "even"), (MYSQL, ("id",), "range_batches", "files"),
    (MYSQL, ("name",), "hash_batches", "plan"), (POSTGRESQL, (), "page_batches", "plan"),
])
def test_incremental_loads_of_files_take_few_steps(spark, dialect, keys, strategy, slice_by):
    rows = spark.range(25_000).selectExpr("id", "IF(id % 9 = 0, NULL, concat('n', id % 4000)) AS name").repartition(20, "id")
    folder, sink = shared_dir(spark, "given"), new_sink(spark)
    rows.write.parquet(folder)
    src = FileSource(spark, dialect, {("shop", "t"): FileTable(folder, keys)}, slice_by=slice_by)
    entry = plan_source(src, CFG).first()
    assert (entry["strategy"], entry["batches"] > MAX_STEPS) == (strategy, True)
    steps = []
    replace, append = sink.replace, sink.append
    sink.replace = lambda *a: steps.append("replace") or replace(*a)
    sink.append = lambda *a: steps.append("append") or append(*a)
    assert load_table(src, sink, entry, publish="incremental") == 25_000
    assert steps[0] == "replace" and 2 <= len(steps) <= MAX_STEPS and set(steps[1:]) == {"append"}
    assert same_rows(sink.read(target_of(src, "shop", "t")), rows)


def test_a_page_slice_opens_the_files_that_have_its_pages(spark):
    rows = spark.range(9_000).repartitionByRange(6, "id")
    folder = shared_dir(spark, "given")
    rows.write.parquet(folder)
    src = FileSource(spark, POSTGRESQL, {("app", "t"): FileTable(folder)}, rows_per_page=500, slice_by="plan")
    entry = plan_source(src, CFG).first()
    parts = [src.read_slice(entry, p) for p in src.pieces(entry)]
    assert len(parts) == entry["batches"] == 18
    assert max(len([f for f in p.inputFiles() if folder in f]) for p in parts) <= 2
    assert same_rows(functools.reduce(lambda a, b: a.unionByName(b), parts), rows)
    spark.range(9_000, 9_700).write.mode("append").parquet(folder)
    assert sum(src.read_slice(entry, p).count() for p in src.pieces(entry)) == 9_700  # each load looks anew


def test_numbering_pages_does_not_shuffle_the_table(spark):
    folder = shared_dir(spark, "given")
    spark.range(9_000).repartition(6).write.parquet(folder)
    src = FileSource(spark, POSTGRESQL, {("app", "t"): FileTable(folder)}, rows_per_page=500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as if the files' rows were estimated to be many
    try:
        plan = src.paged("app", "t")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
