import threading

import pytest
from pyspark.sql import functions as F

from checks.tables import source
from snaplake import Jobs, LoadConfig, RunConflict, RunLedger, Target
from snaplake.jobs import source_of

DATA = "/root/testdata/sf0.001"
REQUEST = {"db_type": "mysql", "host": "db1", "port": 3306, "user": "u", "password": "p"}


@pytest.fixture
def jobs(spark, sink):
    return Jobs(spark, sink, RunLedger(spark, sink), source=lambda s, r: source(s, DATA, r["db_type"]))


def test_full_run(jobs, sink):
    run_id = jobs.run(REQUEST)
    done = jobs.wait(run_id, 120)
    assert {r.status for r in done.results} == {"success"}
    state = jobs.status(run_id)
    assert (state["status"], state["db_type"], state["host"]) == ("success", "mysql", "db1")
    assert [r["run_id"] for r in jobs.list().collect()] == [run_id]
    kept = {r["table"]: r for r in jobs.ledger.table_results().collect()}
    assert kept["orders"]["rows"] == 1_500 and kept["orders"]["run_id"] == run_id and kept["orders"]["compaction_problem"] is None
    assert sink.read(Target(("mysql", "shop"), "orders")).count() == 1_500
    with pytest.raises(KeyError):
        jobs.status("nobody")
    with pytest.raises(ValueError):
        jobs.cancel(run_id)


def test_filtered_run(jobs, sink):
    group = {"logic": "and", "conditions": [
        {"field": "o_orderstatus", "op": "eq", "value": "F"}, {"field": "o_orderdate", "op": "gte", "value": "1998-01-01"},
    ], "groups": []}
    run_id = jobs.run_filtered(REQUEST | {"source_db": "shop", "source_table": "orders", "filter_group": group})
    rows = jobs.wait(run_id, 120)
    assert 0 < rows == sink.read(Target(("mysql", "shop"), "orders")).count()
    assert jobs.status(run_id)["status"] == "success"
    with pytest.raises(ValueError):
        jobs.run_filtered(REQUEST | {"source_db": "shop", "source_table": "orders", "filter_group": {}})


def test_overlap_and_cancel(spark, sink):
    begun = threading.Event()

    class Slow:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def waves(self, entry, group=None, first=0, layout=None):
            begun.set()
            yield spark.range(0, 1, 1, 1).select(F.expr("java_method('java.lang.Thread', 'sleep', 30000L)").alias("x"))

    jobs = Jobs(spark, sink, RunLedger(spark, sink), source=lambda s, r: Slow(source(s, DATA, r["db_type"])))
    run_id = jobs.run(REQUEST)
    assert begun.wait(60)
    with pytest.raises(RunConflict, match=run_id):
        jobs.run(REQUEST)
    jobs.cancel(run_id)
    done = jobs.wait(run_id, 60)
    assert {r.status for r in done.results} == {"cancelled"} and done.compacted == []
    state = jobs.status(run_id)
    assert state["status"] == "cancelled" and state["cancelled_at"] is not None and state["elapsed"] is None


def test_requests_name_their_source(spark):
    made = source_of(spark, REQUEST)
    assert made.dialect.name == "mysql" and made.options["url"].startswith("jdbc:mysql://db1:3306/?")
    made = source_of(spark, REQUEST | {"db_type": "PostgreSQL", "port": 5432, "pg_database": "appdb"})
    assert made.options["url"] == "jdbc:postgresql://db1:5432/appdb" and made.database == "appdb"
    with pytest.raises(ValueError):
        source_of(spark, REQUEST | {"db_type": "oracle"})


def test_settings():
    assert LoadConfig.of({"num_threads": 8, "large_table_workers": 1}) == LoadConfig(num_threads=8, large_table_workers=1)
    with pytest.raises(ValueError):
        LoadConfig.of({"threads": 8})
