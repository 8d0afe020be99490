import os
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from snaplake import IcebergSink, ParquetSink, Target, session_conf
from snaplake.functions.digest import rows_digest
from snaplake.sinks.base import Written
from snaplake.workspace import shared_dir

T = Target.of("mysql", "shop", "t")


def sizes_of(sink, target):
    return [os.path.getsize(urlparse(f).path) for f in sink.read(target).inputFiles()]


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_targets():
    assert T.path == "mysql/shop/t"
    assert Target.of("postgresql", "public", "t", "app").path == "postgresql/app/public/t"


def test_replace_and_append(spark, sink):
    first = spark.range(100)
    assert sink.replace(first, T) == 100
    assert sink.replace(first, T) == 100 and sink.read(T).count() == 100
    assert sink.append(spark.range(100, 105), T) == 5
    assert same_rows(sink.read(T), spark.range(105))


def test_replace_follows_the_schema(spark, sink):
    sink.replace(spark.range(3), T)
    other = spark.createDataFrame([("a", None, [1.5])], "id string, `odd name` timestamp_ntz, xs array<float>")
    sink.replace(other, T)
    assert sink.read(T).collect() == other.collect()
    assert [f.dataType for f in sink.read(T).schema] == [f.dataType for f in other.schema]


def test_append_matches_columns_by_name(spark, sink):
    sink.replace(spark.createDataFrame([(1, "a")], "x int, y string"), T)
    sink.append(spark.createDataFrame([("b", 2)], "y string, x int"), T)
    assert sorted(tuple(r) for r in sink.read(T).collect()) == [(1, "a"), (2, "b")]


def test_a_failed_replace_leaves_the_old_rows(spark, sink):
    sink.replace(spark.range(10), T)
    broken = spark.range(10).selectExpr("CASE WHEN id = 7 THEN CAST(raise_error('boom') AS bigint) ELSE id END AS id")
    with pytest.raises(Exception, match="boom"):
        sink.replace(broken, T)
    assert sink.read(T).count() == 10


def test_a_table_can_replace_itself(spark, sink):
    sink.replace(spark.range(10), T)
    sink.replace(sink.read(T).filter("id < 4"), T)
    assert sink.read(T).count() == 4


def test_empty_tables(spark, sink):
    assert sink.replace(spark.range(0), T) == 0
    assert sink.read(T).count() == 0
    sink.compact(T)
    assert sink.read(T).columns == ["id"]


def test_compaction(spark, sink):
    rows = spark.range(12_000).select("id", F.concat(F.lit("row "), "id").alias("s"))
    sink.replace(rows.repartition(12), T)
    assert sink.footprint(T) == (12, sum(sizes_of(sink, T)), max(sizes_of(sink, T)))
    sink.compact(T)
    assert sink.footprint(T)[0] == 1 and same_rows(sink.read(T), rows)
    before = sink.location(T)
    sink.compact(T)  # nothing left to save
    assert sink.location(T) == before


def test_compaction_respects_the_target_size(spark):
    folder = shared_dir(spark, "compaction")
    rows = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    small = ParquetSink(spark, folder, prefix="c_", target_bytes=4 << 20)
    small.replace(rows.repartition(40), T)
    total = sum(sizes_of(small, T))
    small.compact(T)
    sizes = sizes_of(small, T)
    assert total / (4 << 20) <= len(sizes) <= total / (4 << 20) + 2 and max(sizes) <= 5 << 20
    assert same_rows(small.read(T), rows)


def test_compaction_has_no_shuffle(spark, sink):
    sink.replace(spark.range(1_000).repartition(6), T)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("compaction-check", "compaction")
    sink.compact(T)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = tracker.getJobIdsForGroup("compaction-check")
    assert jobs and all(len(tracker.getJobInfo(j).stageIds) == 1 for j in jobs)


def test_statistics(spark, sink):
    sink.replace(spark.range(42), T)
    assert sink.statistics_rows(T) is None
    sink.refresh_statistics(T)
    assert sink.statistics_rows(T) == 42


class FakeSpark:
    """Notes SQL statements: there is no Iceberg jar here to run them."""

    def __init__(self, answer=None):
        self.said, self.answer = [], answer

    def sql(self, text):
        self.said.append(text)
        return self

    def first(self):
        return {"added": self.answer}


class FakeWriter:
    def __init__(self, log):
        self.log = log

    def __getattr__(self, name):
        def call(*args):
            self.log.append((name, *args))
            return self

        return call


def test_compaction_splits_large_files(spark):
    folder = shared_dir(spark, "split")
    rows = spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    sink = ParquetSink(spark, folder, prefix="s_", target_bytes=1 << 20)
    spark.conf.set("parquet.block.size", str(1 << 20))  # row groups are what a file can be split by
    try:
        sink.replace(rows.coalesce(1), T)
    finally:
        spark.conf.unset("parquet.block.size")
    assert len(sizes_of(sink, T)) == 1 and max(sizes_of(sink, T)) > 8 << 20
    sink.compact(T)
    assert len(sizes_of(sink, T)) >= 8 and max(sizes_of(sink, T)) <= 4 << 20
    assert same_rows(sink.read(T), rows)


def test_rows_of_a_file_are_bounded(spark):
    sink = ParquetSink(spark, shared_dir(spark, "rows"), prefix="r_", file_rows=1_000)
    assert sink.replace(spark.range(0, 5_000, 1, 1), T) == 5_000
    assert len(sizes_of(sink, T)) == 5


def test_waves_are_published_together(spark, sink):
    sink.replace(spark.range(3), T)
    assert sink.replace([spark.range(0, 10), spark.range(10, 15), spark.range(15, 16)], T) == 16
    assert sorted(r.id for r in sink.read(T).collect()) == list(range(16))


def test_another_application_finds_the_current_version(spark, sink):
    sink.replace(spark.range(5), T)
    sink.replace(spark.range(7), T)
    other = ParquetSink(spark, sink.warehouse, prefix=f"other_{sink.prefix}")  # a catalog that knows nothing of it
    assert other.current_version(T) == sink.current_version(T) and other.current_version(T) in sink.location(T)
    assert other.exists(T) and other.read(T).count() == 7
    other.append(spark.range(2), T)
    assert sink.read(T).count() == 9
    assert not other.exists(Target(("nowhere",), "t")) and other.current_version(Target(("nowhere",), "t")) is None


class Refuses(FakeSpark):
    """Iceberg's answer if ``main`` has moved on since the branch was made."""

    def sql(self, text):
        super().sql(text)
        if "fast_forward" in text:
            raise RuntimeError("Cannot fast-forward: main is not an ancestor of load_t1")
        return self


class Frame(FakeWriter):
    def limit(self, n):
        self.log.append(("limit", n))
        return self


@pytest.fixture
def no_counting(monkeypatch):
    monkeypatch.setattr("snaplake.sinks.iceberg.counted", lambda df, digest: (df, None))
    monkeypatch.setattr("snaplake.sinks.iceberg.written_of", lambda seen, digest: Written(7))
    monkeypatch.setattr("snaplake.sinks.iceberg.F.lit", lambda value: f"lit {value}")


def test_iceberg_statements(no_counting):
    spark, written = FakeSpark("7"), []
    sink = IcebergSink(spark, "lake")
    target = Target.of("postgresql", "public", "o`rders", "app")
    assert sink.replace(FakeWriter(written), target) == 7
    sink.append(FakeWriter(written), target)
    sink.compact(target)
    sink.refresh_statistics(target)
    name = "`lake`.`postgresql`.`app`.`public`.`o``rders`"
    assert written == [("writeTo", name), ("using", "iceberg"), ("createOrReplace",), ("writeTo", name), ("append",)]
    assert sink.written(target) == Written(14)
    assert spark.said[:3] == [
        "CREATE NAMESPACE IF NOT EXISTS `lake`.`postgresql`",
        "CREATE NAMESPACE IF NOT EXISTS `lake`.`postgresql`.`app`",
        "CREATE NAMESPACE IF NOT EXISTS `lake`.`postgresql`.`app`.`public`",
    ]
    assert spark.said[-2] == (
        "CALL `lake`.system.rewrite_data_files(table => '`postgresql`.`app`.`public`.`o``rders`',"
        " options => map('target-file-size-bytes', '268435456'))"
    )
    assert spark.said[-1].startswith("CALL `lake`.system.compute_table_stats(")


def waves_of(spark, written, monkeypatch, there=True, committed=None, n=3):
    """Write ``n`` waves of load t1; returns what was said and written."""
    sink = IcebergSink(spark, "lake")
    monkeypatch.setattr(sink, "exists", lambda target: there)
    monkeypatch.setattr(sink, "_committed", lambda target, token, wave: (committed or {}).get(wave))
    return sink, sink.replace((Frame(written) for _ in range(n)), T, token="t1")


def test_iceberg_waves_are_written_once_to_a_branch(no_counting, monkeypatch):
    spark, written = FakeSpark(), []
    sink, rows = waves_of(spark, written, monkeypatch)
    table = "`lake`.`mysql`.`shop`.`t`"
    assert rows == 21 and sink.written(T) == Written(21)
    assert [w for w in written if w[0] == "writeTo"] == [("writeTo", f"{table}.`branch_load_t1`")] * 3  # no other copy of a row
    assert [w for w in written if w[0] in ("overwrite", "append")] == [("overwrite", "lit True"), ("append",), ("append",)]
    assert [w[2] for w in written if w[:2] == ("option", "snapshot-property.snaplake-wave")] == ["0", "1", "2"]
    assert spark.said[2:] == [
        f"ALTER TABLE {table} SET TBLPROPERTIES ('write.spark.accept-any-schema' = 'true')",
        f"ALTER TABLE {table} CREATE BRANCH IF NOT EXISTS `load_t1`",
        "CALL `lake`.system.fast_forward('`mysql`.`shop`.`t`', 'main', 'load_t1')",
        f"ALTER TABLE {table} DROP BRANCH IF EXISTS `load_t1`",
    ]


def test_iceberg_goes_on_after_the_waves_that_are_committed(no_counting, monkeypatch):
    written = []
    _, rows = waves_of(FakeSpark(), written, monkeypatch, committed={0: Written(5), 1: Written(6)})
    assert rows == 18 and [w for w in written if w[0] in ("overwrite", "append")] == [("append",)]


def test_iceberg_makes_a_new_table_before_its_branch(no_counting, monkeypatch):
    written = []
    waves_of(FakeSpark(), written, monkeypatch, there=False)
    assert written[:4] == [("limit", 0), ("writeTo", "`lake`.`mysql`.`shop`.`t`"), ("using", "iceberg"), ("create",)]


def test_iceberg_refuses_the_second_of_two_loads_that_clash(no_counting, monkeypatch):
    spark = Refuses()
    with pytest.raises(RuntimeError, match="not an ancestor"):
        waves_of(spark, [], monkeypatch)
    assert "DROP BRANCH" not in spark.said[-1]  # its rows stay there, to be looked at or gone on with


def test_a_repeated_append_adds_its_rows_once(spark, sink):
    sink.replace(spark.range(10), T)
    assert sink.append(spark.range(10, 15), T, token="batch-7") == 5
    assert sink.append(spark.range(10, 15), T, token="batch-7") == 5
    other = ParquetSink(spark, sink.warehouse, prefix=f"again_{sink.prefix}")  # the driver that repeats it may be another one
    assert other.append(spark.range(10, 15), T, token="batch-7") == 5
    assert sorted(r.id for r in sink.read(T).collect()) == list(range(15)) and other.read(T).count() == 15
    assert sink.append(spark.range(15, 16), T, token="batch-8") == 1 and sink.written(T) == Written(16)


def test_an_append_that_broke_off_is_written_anew(spark, sink):
    sink.replace(spark.range(3), T)
    broken = spark.range(10).selectExpr("CASE WHEN id = 7 THEN CAST(raise_error('boom') AS bigint) ELSE id END AS id")
    with pytest.raises(Exception, match="boom"):
        sink.append(broken, T, token="b")
    assert sink.append(spark.range(3, 5), T, token="b") == 2
    assert sorted(r.id for r in sink.read(T).collect()) == list(range(5))


def test_a_repeated_replace_is_done_once(spark, sink):
    assert sink.replace([spark.range(4), spark.range(4, 9)], T, token="load-1") == 9
    before = sink.location(T)
    sink.append(spark.range(20, 22), T)
    assert sink.replace([spark.range(4), spark.range(4, 9)], T, token="load-1") == 9
    assert sink.location(T) == before and sink.read(T).count() == 11


def test_appends_at_one_time(spark, sink):
    from concurrent.futures import ThreadPoolExecutor

    sink.replace(spark.range(0), T)
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda k: sink.append(spark.range(k * 10, k * 10 + 10), T), range(6)))
    assert sorted(r.id for r in sink.read(T).collect()) == list(range(60)) and sink.written(T) == Written(60)


def test_the_record_counts_not_the_catalog(spark, sink):
    """A driver that was lost after the record was written leaves a catalog that still has the old folder."""
    sink.replace(spark.range(5), T)
    stage = sink.stage(T)
    stage.write(0, spark.range(8))
    sink.marks.replace(sink._current(T), '{"version": "%s", "rows": 8, "digest": null}' % stage.folder)
    assert sink.read(T).count() == 8
    assert not [n for n in os.listdir(urlparse(f"{sink.warehouse}/{T.path}").path) if n.startswith("_CURRENT.")]


def test_statistics_do_not_scan_the_table(spark, sink):
    sink.replace([spark.range(30), spark.range(30, 42)], T)
    sink.append(spark.range(3), T)
    spark.sparkContext.setJobGroup("statistics-check", "statistics")
    sink.refresh_statistics(T)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("statistics-check")
    assert sink.statistics_rows(T) == 45
    sink.replace(spark.range(2), T)
    assert sink.statistics_rows(T) is None


def test_digests_of_what_was_written(spark):
    sink = ParquetSink(spark, shared_dir(spark, "digests"), prefix="d_", digests=True)
    rows = spark.range(1_000).selectExpr(
        "id", "IF(id % 3 = 0, NULL, CAST(id AS string)) AS s", "array(id, NULL) AS xs", "map('a', id, 'b', 1L) AS m", "CAST(id AS decimal(20,3)) AS d"
    )
    digest = lambda df: int(df.agg(rows_digest(df.schema).alias("d")).first()["d"])
    sink.replace(rows.repartition(7), T)
    assert sink.written(T) == Written(1_000, digest(rows)) and digest(sink.read(T)) == digest(rows)
    sink.replace([rows.filter("id < 300"), rows.filter("id >= 300")], T)
    assert sink.written(T) == Written(1_000, digest(rows))
    changed = rows.withColumn("s", F.when(F.col("id") == 5, F.lit(None)).otherwise(F.col("s")))
    assert len({digest(rows), digest(changed), digest(rows.limit(999)), digest(rows.union(rows.limit(1)))}) == 4
    assert digest(rows.select("id", "s")) != digest(rows.select("s", "id")) and digest(rows.limit(0)) == 0
    swapped = spark.createDataFrame([(None, 5), (5, None)], "a long, b long")
    one, two = swapped.limit(1), swapped.filter("a = 5")
    assert digest(one) != digest(two)


def test_session_conf():
    conf = session_conf(catalog="lake", warehouse="s3a://b/w", endpoint="http://store:9000", ssl_enabled=True)
    assert conf["spark.sql.catalog.lake.type"] == "hadoop" and conf["spark.sql.catalog.lake.warehouse"] == "s3a://b/w"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert not any("secret" in k or "access.key" in k for k in conf)
