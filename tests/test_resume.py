"""Loads that stop and go on, runs that others cancel, sources that one run at a time has."""

import threading
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from checks.tables import CFG, source
from snaplake import Jobs, ParquetSink, Run, RunConflict, RunLedger, Target, load_all, load_table, snapshot
from snaplake.marks import Marks
from snaplake.operators.lease import Lease
from snaplake.operators.load import RunCancelled
from snaplake.operators.progress import LoadProgress
from snaplake.plans.load_plan import plan_frame
from snaplake.workspace import shared_dir

DATA = "/root/testdata/sf0.001"
ENTRY = Row(
    source="mysql", ns="shop", table="t", key_column="id", salt_column=None, key_kind="numeric", rows=60, lo=0, hi=59, pages=0,
    parts=1, large=True, strategy="range_batches", slice_width=10, batches=6,
)


class Waves:
    """A source of one table in six waves; reading wave ``broken`` fails ``times`` times."""

    database = ""

    def __init__(self, spark, broken=None, times=1, inner=None, columns="id"):
        self.spark, self.broken, self.left, self.inner, self.columns = spark, broken, times, inner, columns
        self.opened, self.entries = [], []

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def layout(self, entry):
        return "cut by tens"

    def waves(self, entry, group=None, first=0, layout=None):
        assert layout == "cut by tens"
        self.entries.append(entry)
        for n in range(first, 6):
            self.opened.append(n)
            df = self.spark.range(n * 10, n * 10 + 10, 1, 2).selectExpr(self.columns)
            if n == self.broken and self.left:
                self.left -= 1
                df = df.filter(F.raise_error(F.lit("lost connection")).isNull())
            yield df


@pytest.fixture
def src(spark):
    return Waves(spark, inner=source(spark, DATA, "mysql"))


def ids(sink):
    return sorted(r[0] for r in sink.read(Target(("mysql", "shop"), "t")).collect())


def test_a_load_that_was_killed_in_wave_3_goes_on_there(spark, sink, src):
    src.broken = 3
    with pytest.raises(Exception, match="lost connection"):
        load_table(src, sink, ENTRY, progress=LoadProgress(spark, sink, "run-1"))
    assert src.opened == [0, 1, 2, 3] and not sink.exists(Target(("mysql", "shop"), "t"))
    # Another driver, whose plan of the table is another one by now.
    later = ParquetSink(spark, sink.warehouse, prefix=f"later_{sink.prefix}")
    progress, src.opened = LoadProgress(spark, later, "run-2"), []
    newer = Row(**ENTRY.asDict() | {"rows": 99, "hi": 98, "batches": 3})
    assert load_table(src, later, newer, progress=progress) == 60
    assert src.opened == [3, 4, 5] and src.entries[-1]["hi"] == 59
    assert ids(later) == list(range(60)) == ids(sink)
    steps = [(r["step"], r["wave"], r["rows"]) for r in progress.rows().orderBy("ts").collect()]
    assert steps == [("started", None, None), *[("wrote", n, 10) for n in range(6)], ("published", None, None)]
    src.opened = []
    assert load_table(src, later, ENTRY, progress=LoadProgress(spark, later, "run-3")) == 60
    assert src.opened == [0, 1, 2, 3, 4, 5]  # a load that was published is over


def test_a_wave_that_was_written_but_not_noted_is_not_doubled(spark, sink, src):
    progress = LoadProgress(spark, sink)
    wrote = progress.wrote
    progress.wrote = lambda load, wave, written: wrote(load, wave, written) if wave < 2 else (_ for _ in ()).throw(OSError("driver lost"))
    with pytest.raises(OSError):
        load_table(src, sink, ENTRY, progress=progress)
    assert load_table(src, sink, ENTRY, progress=LoadProgress(spark, sink)) == 60
    assert ids(sink) == list(range(60))


def test_a_load_whose_publication_was_not_noted_is_not_repeated(spark, sink, src):
    progress = LoadProgress(spark, sink)
    progress.published = lambda load: (_ for _ in ()).throw(OSError("driver lost"))
    with pytest.raises(OSError):
        load_table(src, sink, ENTRY, progress=progress)
    src.opened = []
    assert load_table(src, sink, ENTRY, progress=LoadProgress(spark, sink)) == 60
    assert src.opened == [] and ids(sink) == list(range(60))


def test_old_loads_and_changed_tables_start_anew(spark, sink, src):
    src.broken = 2
    with pytest.raises(Exception, match="lost connection"):
        load_table(src, sink, ENTRY, progress=LoadProgress(spark, sink))
    src.columns, src.opened = "CAST(id AS string) AS id", []
    load_table(src, sink, ENTRY, progress=LoadProgress(spark, sink))
    assert src.opened == [2, 0, 1, 2, 3, 4, 5] and len(ids(sink)) == 60
    src.broken, src.left, src.opened = 4, 1, []
    with pytest.raises(Exception, match="lost connection"):
        load_table(src, sink, ENTRY, progress=LoadProgress(spark, sink))
    time.sleep(1.1)
    src.opened = []
    load_table(src, sink, ENTRY, progress=LoadProgress(spark, sink, max_age_seconds=1))
    assert src.opened == [0, 1, 2, 3, 4, 5]


def test_the_second_try_of_a_table_goes_on(spark, sink, src):
    src.broken = 4
    results = load_all(spark, src, sink, plan_frame(spark, [ENTRY]), CFG, progress=LoadProgress(spark, sink))
    assert [(r.status, r.attempts, r.rows) for r in results] == [("success", 2, 60)]
    assert src.opened == [0, 1, 2, 3, 4, 4, 5] and ids(sink) == list(range(60))


def test_one_frame_ahead_at_most(spark, sink, src):
    """When a wave is written, no more than the next one is open."""
    stage = sink.stage
    written = []

    class Watching:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def write(self, wave, df):
            written.append((wave, max(src.opened)))
            return self.inner.write(wave, df)

    sink.stage = lambda *a: Watching(stage(*a))
    load_table(src, sink, ENTRY)
    assert all(latest <= wave + 1 for wave, latest in written) and len(written) == 6


def test_another_driver_cancels_a_run_between_waves(spark, sink, src):
    ledger, elsewhere = RunLedger(spark, sink), RunLedger(spark.newSession(), ParquetSink(spark.newSession(), sink.warehouse, prefix="else_"))
    run = ledger.new_run("run-9")
    ledger.record("run-9", "running", "mysql", "db1")
    jobs = Jobs(elsewhere.spark, elsewhere.sink, elsewhere)
    with pytest.raises(ValueError):
        jobs.cancel("run-8")
    stage = sink.stage

    def cancelling(*a):
        made = stage(*a)
        write = made.write
        made.write = lambda wave, df: (write(wave, df), jobs.cancel("run-9") if wave == 2 else None)[0]
        return made

    sink.stage = cancelling
    with pytest.raises(RunCancelled):
        load_table(src, sink, ENTRY, run=run)
    assert run.cancelled and max(src.opened) <= 4 and not sink.exists(Target(("mysql", "shop"), "t"))
    results = load_all(spark, src, sink, plan_frame(spark, [ENTRY]), CFG, run=ledger.new_run("run-9"))
    assert [(r.status, r.attempts) for r in results] == [("cancelled", 0)]


def test_marks(spark):
    marks = Marks(spark, shared_dir(spark, "marks"))
    assert marks.read("a/b") is None and not marks.exists("a/b") and marks.names("a/") == []
    assert marks.create("a/b", "one") and not marks.create("a/b", "two") and marks.read("a/b") == "one"
    marks.replace("a/b", "thrée")
    marks.replace("a/c", "")
    assert marks.read("a/b") == "thrée" and marks.names("a/") == ["a/b", "a/c"]
    assert marks.take_away("a/b") and not marks.take_away("a/b") and marks.names("a/") == ["a/c"]


def test_one_of_many_gets_a_lease(spark):
    folder = shared_dir(spark, "leases")
    got = []
    gate = threading.Barrier(8)

    def go(k):
        lease = Lease(Marks(spark, folder), "place", f"run-{k}")
        gate.wait()
        if lease.acquire():
            got.append(k)

    for _ in range(5):
        threads = [threading.Thread(target=go, args=(k,)) for k in range(8)]
        [t.start() for t in threads]
        [t.join() for t in threads]
        assert len(got) == 1
        Lease(Marks(spark, folder), "place", "x").current()
        got.clear()
        late = Lease(Marks(spark, folder), "place", "late", clock=lambda: time.time() + 10**6)
        assert late.acquire()  # the one before has expired by then
        late.clock = lambda: time.time() - 10**9
        late.renew()
        late.clock = time.time
        assert not late.current().active(time.time())


def test_a_lease_is_taken_over_once_and_its_holder_learns_of_it(spark):
    folder, now = shared_dir(spark, "leases"), [1_000.0]
    a, b, c = (Lease(Marks(spark, folder), "place", k, 60, clock=lambda: now[0]) for k in "abc")
    assert a.acquire() and not b.acquire() and a.renew()
    now[0] += 59
    assert not b.acquire() and a.renew()
    now[0] += 61
    assert b.acquire() and not c.acquire() and not a.renew()
    a.release()  # has nothing to give up any more
    assert b.current().owner == "b" and b.current().active(now[0])
    b.release()
    assert c.acquire() and c.current().owner == "c"
    lost = threading.Event()
    d = Lease(Marks(spark, folder), "beat", "d", 0.3)
    assert d.acquire()
    d.keep(lost.set)
    time.sleep(1)
    assert not Lease(Marks(spark, folder), "beat", "e", 0.3).acquire()  # kept up
    d.marks.create("beat.00000001", '{"owner": "e", "until": 1e12}')
    assert lost.wait(5)


def test_two_drivers_start_at_once_and_one_runs(spark):
    """Two sessions with sinks and ledgers of their own over one warehouse."""
    folder = shared_dir(spark, "two")
    begun, release = threading.Event(), threading.Event()
    src = source(spark, DATA, "mysql")

    class Held:
        def __getattr__(self, name):
            return getattr(src, name)

        def profile(self, keys):
            begun.set()
            release.wait(60)
            return src.profile([k for k in keys if k["table"] == "region"])

    made, refused = [], []

    def drive(k):
        session = spark.newSession()
        mine = ParquetSink(session, folder, prefix=f"two{k}_")
        try:
            made.append(snapshot(Held(), mine, CFG, host="db1", ledger=RunLedger(session, mine)))
        except RunConflict as problem:
            refused.append(str(problem))
            release.set()

    threads = [threading.Thread(target=drive, args=(k,)) for k in range(2)]
    [t.start() for t in threads]
    assert begun.wait(60)
    [t.join(120) for t in threads]
    assert len(made) == 1 and len(refused) == 1 and "holds mysql at db1" in refused[0]
    assert {r.status for r in made[0].results} == {"success"}
    again = ParquetSink(spark, folder, prefix="again_")
    ledger = RunLedger(spark, again)
    assert [r["status"] for r in ledger.runs().collect()] == ["success"]
    lease = ledger.claim(Run(spark), "mysql", "db1")  # free again
    lease.release()


def test_a_run_of_a_lost_driver_does_not_bar_its_source_for_ever(spark, sink):
    lost = RunLedger(spark, sink, lease_seconds=0.2)
    run = lost.new_run()
    held = Lease(lost.marks, "lease-mysql-db1", run.run_id, 0.2)
    assert held.acquire()
    lost.ensure_free_but(run, "mysql", "db1")
    lost.record(run.run_id, "running", "mysql", "db1")  # and nothing more is heard of it
    time.sleep(0.5)
    next_one = RunLedger(spark, sink)
    next_one.ensure_free("mysql", "db1")
    next_one.claim(next_one.new_run(), "mysql", "db1").release()


def test_failed_tables_are_rows(spark, sink):
    class Failing(Waves):
        def waves(self, entry, group=None, first=0, layout=None):
            if entry["table"] == "supplier":
                raise ValueError("no such table")
            return self.inner.waves(entry, group, first, layout)

        def layout(self, entry):
            return None

    jobs = Jobs(spark, sink, RunLedger(spark, sink), CFG, source=lambda s, r: Failing(spark, inner=source(spark, DATA, "mysql")))
    run_id = jobs.run({"db_type": "mysql", "host": "db1", "port": 1, "user": "u", "password": "p"})
    with pytest.raises(Exception, match="supplier"):
        jobs.wait(run_id, 180)
    bad = jobs.failed_tables(run_id).collect()
    assert [(r["table"], r["attempts"], r["status"], r["error"]) for r in bad] == [("supplier", 2, "failed", "no such table")]
    assert jobs.failed_tables("another").count() == 0
