"""What the JDBC source asks Spark for. No database is started here: reads are recorded, not run."""

import pytest
from pyspark.sql import Row

from snaplake import JdbcSource, LoadConfig, MYSQL, POSTGRESQL, dialect_of
from snaplake.frames import local_frame
from snaplake.plans.load_plan import PROFILE_SCHEMA, plan_loads
from snaplake.plans.slices import plan_slices
from snaplake.sources.catalog_sql import CATALOG_SQL

CFG = LoadConfig(num_threads=4, chunk_size=200, large_table_threshold=1_000, large_table_batch_size=500)


class Recorder:
    """Stands in for ``spark.read``: notes what was asked and answers with a given frame."""

    def __init__(self, spark, answer=None):
        self.spark, self.answer, self.asked = spark, answer, []
        self.rows = 2_000  # what a count at the source says

    @property
    def read(self):
        return self

    def __getattr__(self, name):
        return getattr(self.spark, name)

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.asked.append(options)
        return self

    def load(self):
        if "COUNT(*) AS n FROM" in self.asked[-1]["dbtable"]:
            self.asked.pop()
            return self.spark.range(self.rows).selectExpr("count(*) AS n")
        return self.answer if self.answer is not None else self.spark.range(0)

    def jdbc(self, url, table, predicates, properties):
        self.asked.append({"url": url, "dbtable": table, "predicates": predicates, **properties})
        return self.spark.range(0, len(predicates), 1, len(predicates))


def mysql(spark, answer=None, **more):
    recorder = Recorder(spark, answer)
    return JdbcSource(recorder, MYSQL, "db.example.org", 3306, user="u", password="p", **more), recorder


def postgresql(spark, answer=None, **more):
    recorder = Recorder(spark, answer)
    return JdbcSource(recorder, POSTGRESQL, "db.example.org", 5432, user="u", password="p", database="app", **more), recorder


def entry(spark, source, kind, rows, lo, hi, pages, salt=None):
    profile = [(source, "shop", "orders", "id" if kind != "page" else None, salt, kind, rows, lo, hi, pages)]
    return plan_loads(local_frame(spark, profile, PROFILE_SCHEMA), CFG).first()


def test_full_scan(spark):
    source, seen = mysql(spark)
    source.scan("shop", "orders")
    assert seen.asked == [{
        "url": "jdbc:mysql://db.example.org:3306/?serverTimezone=UTC&useCursorFetch=true",
        "driver": "com.mysql.cj.jdbc.Driver", "user": "u", "password": "p", "fetchsize": "10000",
        "preferTimestampNTZ": "true", "sessionInitStatement": "START TRANSACTION WITH CONSISTENT SNAPSHOT",
        "dbtable": "`shop`.`orders`",
    }]


def test_postgresql_session(spark):
    source, seen = postgresql(spark, fetch_size=500)
    source.scan("public", "orders")
    asked = seen.asked[0]
    assert asked["url"] == "jdbc:postgresql://db.example.org:5432/app"
    assert asked["sessionInitStatement"] == "SET SESSION CHARACTERISTICS AS TRANSACTION ISOLATION LEVEL REPEATABLE READ"
    assert asked["dbtable"] == '"public"."orders"' and asked["fetchsize"] == "500"
    pinned, seen = postgresql(spark, session_statement="SET TRANSACTION SNAPSHOT '0003'")
    pinned.scan("public", "orders")
    assert seen.asked[0]["sessionInitStatement"] == "SET TRANSACTION SNAPSHOT '0003'"


def test_key_partitioned_scan(spark):
    source, seen = mysql(spark)
    source.read(entry(spark, "mysql", "numeric", 900, 1, 1_000, 0))
    assert {k: seen.asked[0][k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000", "numPartitions": "4",
    }
    source.scan_by_key("shop", "orders", "id", 5, 5, 4)
    assert "partitionColumn" not in seen.asked[1]


def test_every_reader_is_a_task_of_its_own(spark):
    source, seen = mysql(spark)
    df = source.read(entry(spark, "mysql", "numeric", 2_000, 1, 2_000, 0))
    assert seen.asked[0]["dbtable"] == "`shop`.`orders`" and len(seen.asked[0]["predicates"]) == 16
    assert seen.asked[0]["predicates"][:2] == ["(`id` <= 125 OR `id` IS NULL)", "`id` >= 126 AND `id` <= 250"]
    assert df.rdd.getNumPartitions() == 16


def test_waves_bound_the_connections(spark):
    """Four thousand readers stay four thousand tasks; no job has more than ``connections``."""
    source, seen = mysql(spark, connections=6)
    waves = list(source.waves(entry(spark, "mysql", "numeric", 500_000, 1, 500_000, 0)))
    asked = [a["predicates"] for a in seen.asked if "predicates" in a]
    assert sum(map(len, asked)) == 4_000 and max(map(len, asked)) == 6
    assert [w.rdd.getNumPartitions() for w in waves[-2:]] == [6, 4]
    group = {"conditions": [{"field": "id", "op": "gte", "value": 3}]}
    waves = list(source.waves(entry(spark, "mysql", "numeric", 2_000, 1, 2_000, 0), group))
    assert len(waves) == 3 and all("isnotnull" in w._jdf.queryExecution().toString().lower() or ">= 3" in w._jdf.queryExecution().toString() for w in waves)


def test_a_million_readers_are_planned_as_they_are_reached(spark, monkeypatch):
    """No more than the frames that were taken are open, and no more slices planned than those of one look ahead."""
    planned = []
    monkeypatch.setattr("snaplake.sources.jdbc.MAX_WAVES", 10**6)
    monkeypatch.setattr("snaplake.sources.jdbc.plan_slices", lambda plan, start, n: planned.append((start, n)) or plan_slices(plan, start, n))
    source, seen = mysql(spark, connections=16)
    huge = entry(spark, "mysql", "numeric", 125_000_000, 1, 125_000_000, 0)
    assert huge["batches"] * huge["parts"] == 10**6
    waves = source.waves(huge)
    for n in range(1, 4):
        next(waves)
        assert len(seen.asked) == n and planned == [(0, 1_024)]
    assert sum(len(a["predicates"]) for a in seen.asked) == 48
    late = source.waves(huge, first=500)
    next(late)
    assert len(seen.asked) == 4 and seen.asked[-1]["predicates"][0] == f"`id` >= {500 * 16 * 125 + 1} AND `id` <= {500 * 16 * 125 + 125}"


def test_waves_are_bounded_and_still_cover_the_table(spark, monkeypatch):
    monkeypatch.setattr("snaplake.sources.jdbc.MAX_WAVES", 5)
    source, seen = mysql(spark, connections=4)
    one = entry(spark, "mysql", "numeric", 60_000, 1, 60_000, 0)
    assert one["batches"] * one["parts"] == 480 and len(list(source.waves(one))) <= 5
    texts = [t for a in seen.asked for t in a["predicates"]]
    keys = spark.range(-5, 60_010)
    keys.createOrReplaceTempView("wave_keys")
    found = spark.sql("SELECT " + " + ".join(f"CAST({t.replace('`id`', 'id')} AS int)" for t in texts) + " AS n FROM wave_keys")
    assert [tuple(r) for r in found.groupBy("n").count().collect()] == [(1, 60_015)]


def test_boundaries_are_asked_for_once_and_of_a_bounded_sample(spark, monkeypatch):
    boundaries = local_frame(spark, [(1, 1, 1), (50, 1, 9), (70, 1, 17)], "k bigint, copies bigint, r bigint")
    source, seen = mysql(spark, boundaries, connections=2)
    sparse = entry(spark, "mysql", "numeric", 4_000_000, 1, 10**12, 0)
    kept = source.layout(sparse)
    assert "AND MOD(CRC32(CONCAT_WS('|', `id`)), 20) = 19" in seen.asked[0]["dbtable"]  # about 200,000 keys
    assert "MOD(r - 1, 100) = 0" in seen.asked[0]["dbtable"]  # 2,000 readers of 2,000 rows
    before = len(seen.asked)
    waves = list(source.waves(sparse, layout=kept))
    assert [len(a["predicates"]) for a in seen.asked[before:]] == [2, 1] and len(waves) == 2
    list(source.waves(sparse, first=1, layout=kept))
    assert seen.asked[-1]["predicates"] == ["`id` >= 70"] and len(seen.asked) == before + 3
    assert source.layout(entry(spark, "mysql", "numeric", 2_000, 1, 2_000, 0)) is None


def test_a_back_slash_goes_to_the_source_as_it_reads_it(spark):
    """MySQL reads a back-slash in a literal as an escape; the text that Spark renders doesn't allow for that."""
    names = local_frame(spark, [], "id bigint, name string")
    source, seen = mysql(spark, names)
    group = {"groups": [{"conditions": [{"field": "name", "op": "in", "value": ["a\\b'c", "x"]}]}]}
    list(source.waves(entry(spark, "mysql", "numeric", 2_000, 1, 2_000, 0), group))
    sent = [a["predicates"] for a in seen.asked if "predicates" in a][0]
    assert sent[1] == "(`id` >= 126 AND `id` <= 250) AND ((`name` IN ('a\\\\b''c', 'x')))"
    source.scan_where("shop", "orders", group)
    assert seen.asked[-1]["predicates"] == ["(1 = 1) AND ((`name` IN ('a\\\\b''c', 'x')))"]
    source, seen = postgresql(spark, names)
    source.scan_where("public", "orders", group)
    assert not any("predicates" in a for a in seen.asked)


def test_a_hot_key_is_split_by_any_column(spark):
    boundaries = local_frame(spark, [(40, 3, 300), (1, 1, 1)], "k bigint, copies bigint, r bigint")
    source, seen = postgresql(spark, boundaries)
    source.read(entry(spark, "postgresql", "numeric", 2_000, 1, 1_000_000, 0, salt="line"))
    texts = [a["predicates"] for a in seen.asked if "predicates" in a][0]
    assert '"id" = 40 AND MOD(ABS(HASHTEXT(("line")::text)::bigint), 3) = 1' in texts


def test_repeated_keys_of_one_pass_are_read_between_boundaries(spark):
    boundaries = local_frame(spark, [(5, 3, 1)], "k bigint, copies bigint, r bigint")
    source, seen = mysql(spark, boundaries)
    source.read(entry(spark, "mysql", "numeric", 900, 1, 100, 0, salt="line"))
    assert any("AS boundaries" in a["dbtable"] for a in seen.asked)


def test_boundaries_follow_the_true_count(spark):
    """A table that has grown a thousandfold since its estimate gets readers of the planned size."""
    boundaries = local_frame(spark, [(1, 1, 1)], "k bigint, copies bigint, r bigint")
    source, seen = mysql(spark, boundaries)
    seen.rows = 2_000_000
    source.read(entry(spark, "mysql", "text", 1_200, 0, 0, 0))
    assert "MOD(r - 1, 400) = 0" in seen.asked[0]["dbtable"]


def test_pages_of_a_table_that_was_never_analysed(spark):
    answer = local_frame(spark, [("public", "log", 10**9, None, None)], "ns string, tbl string, rows_v bigint, lo_v bigint, hi_v bigint")
    source, _ = postgresql(spark, answer)
    key = Row(source="postgresql", ns="public", table="log", key_column=None, salt_column=None, key_kind="page", rows=None, pages=0, row_width=80)
    profile = source.profile([key]).collect()
    assert profile[0]["pages"] == 10**9 * 80 // 8192
    planned = plan_loads(local_frame(spark, [tuple(profile[0])], PROFILE_SCHEMA), LoadConfig()).first()
    assert planned["batches"] > 900 and planned["parts"] == 4


def test_slices_one_by_one(spark):
    source, seen = mysql(spark)
    one = entry(spark, "mysql", "numeric", 2_000, 1, 2_000, 0)
    pieces = list(source.pieces(one))
    assert [p["slice_no"] for p in pieces] == [0, 1, 2, 3] and all(len(p["predicates"]) == 4 for p in pieces)
    source.read_slice(one, pieces[3])
    assert seen.asked[0]["predicates"][-1] == "`id` >= 1876"


def test_uneven_keys_ask_for_boundaries(spark):
    boundaries = local_frame(spark, [(90_000, 1, 1_900), (40, 3, 300), (1, 1, 1)], "k bigint, copies bigint, r bigint")
    source, seen = mysql(spark, boundaries)
    source.read(entry(spark, "mysql", "numeric", 2_000, 1, 1_000_000, 0, salt="line"))
    assert seen.asked[0]["dbtable"] == (
        "(SELECT MIN(k) AS k, COUNT(*) AS copies, MIN(r) AS r FROM (SELECT `id` AS k,"
        " ROW_NUMBER() OVER (ORDER BY `id`) AS r FROM `shop`.`orders` WHERE `id` IS NOT NULL) AS ranked"
        " WHERE MOD(r - 1, 125) = 0 GROUP BY k) AS boundaries"
    )
    assert seen.asked[1]["predicates"] == [
        "(`id` < 40 OR `id` IS NULL)",
        "`id` = 40 AND (MOD(CRC32(`line`), 3) = 0 OR `line` IS NULL)",
        "`id` = 40 AND MOD(CRC32(`line`), 3) = 1",
        "`id` = 40 AND MOD(CRC32(`line`), 3) = 2",
        "`id` > 40 AND `id` < 90000",
        "`id` >= 90000",
    ]


def test_text_keys_are_read_between_boundaries(spark):
    boundaries = local_frame(spark, [("a", 1, 1), ("it's", 1, 501), ("m\\", 1, 1_001)], "k string, copies bigint, r bigint")
    source, seen = mysql(spark, boundaries)
    source.read(entry(spark, "mysql", "text", 1_200, 0, 0, 0))
    assert seen.asked[1]["predicates"] == [
        "(`id` < 'it\'\'s' OR `id` IS NULL)", "`id` >= 'it\'\'s' AND `id` < 'm\\\\'", "`id` >= 'm\\\\'",
    ]
    binary = local_frame(spark, [(b"a", 1, 1)], "k binary, copies bigint, r bigint")
    source, seen = mysql(spark, binary)
    source.read(entry(spark, "mysql", "text", 1_200, 0, 0, 0))
    assert seen.asked[1]["predicates"][1] == "MOD(CRC32(`id`), 3) = 1"


def test_hash_and_page_reads(spark):
    source, seen = mysql(spark, even_reads=False)
    source.read(entry(spark, "mysql", "text", 1_200, 0, 0, 0))
    source.read(entry(spark, "mysql", "text", 1_200, 0, 0, 0, salt="line"))
    source.read(entry(spark, "mysql", "numeric", 2_000, 1, 1_000_000, 0))
    assert seen.asked[0]["predicates"] == [
        "(MOD(CRC32(`id`), 3) = 0 OR `id` IS NULL)", "MOD(CRC32(`id`), 3) = 1", "MOD(CRC32(`id`), 3) = 2",
    ]
    assert seen.asked[1]["predicates"][1] == "MOD(CRC32(CONCAT_WS('|', `id`, `line`)), 3) = 1"
    assert len(seen.asked[2]["predicates"]) == 4 * 4
    source, seen = postgresql(spark)
    source.read(entry(spark, "postgresql", "page", 400, 0, 0, 3))
    assert seen.asked[0]["predicates"] == [
        "ctid >= '(0,0)'::tid AND ctid < '(2,0)'::tid", "ctid >= '(2,0)'::tid",
    ]


def test_filtered_reads(spark):
    group = {"conditions": [{"field": "id", "op": "gte", "value": 3}]}
    source, seen = postgresql(spark)
    source.scan_where_at_source("public", "orders", group)
    assert seen.asked[0]["dbtable"] == '(SELECT * FROM "public"."orders" WHERE ("id" >= 3)) AS filtered'
    assert source.scan_where("public", "orders", group).filter("id is not null").count() == 0
    with pytest.raises(ValueError):
        source.scan_where("public", "orders", {"conditions": [{"field": "nope", "op": "is_null"}]})


def test_profile_text(spark):
    def key(**fields):
        return Row(**({"source": "mysql", "ns": "shop", "table": "o'rders", "key_column": None, "salt_column": None,
                       "key_kind": "none", "rows": None, "pages": None} | fields))

    source, _ = mysql(spark)
    assert source.profile_text(key(key_column="id", key_kind="numeric", rows=7)) == (
        "SELECT 'shop' AS ns, 'o''rders' AS tbl, 7 AS rows_v, MIN(`id`) AS lo_v, MAX(`id`) AS hi_v FROM `shop`.`o'rders`"
    )
    assert source.profile_text(key()) == (
        "SELECT 'shop' AS ns, 'o''rders' AS tbl, COUNT(*) AS rows_v, 0 AS lo_v, 0 AS hi_v FROM `shop`.`o'rders`"
    )
    assert source.profile_text(key(rows=7)) == "SELECT 'shop' AS ns, 'o''rders' AS tbl, 7 AS rows_v, 0 AS lo_v, 0 AS hi_v"
    answer = local_frame(spark, [("shop", "o'rders", 7, None, None)],
                         "ns string, tbl string, rows_v bigint, lo_v bigint, hi_v bigint")
    source, seen = mysql(spark, answer)
    got = source.profile([key(key_column="id", key_kind="numeric", rows=7)]).collect()
    assert [(r["rows"], r["lo"], r["hi"], r["pages"]) for r in got] == [(7, 0, 0, 0)]
    assert seen.asked[0]["dbtable"].startswith("(SELECT 'shop' AS ns")


def test_catalog_frames(spark):
    source, seen = postgresql(spark)
    frames = source.catalog()
    assert len(seen.asked) == len(CATALOG_SQL["postgresql"]) == 8
    assert all("source" in getattr(frames, name).columns for name in CATALOG_SQL["postgresql"])


def test_dialects():
    assert dialect_of("MySQL") is MYSQL and dialect_of("postgresql") is POSTGRESQL
    with pytest.raises(ValueError):
        dialect_of("oracle")
