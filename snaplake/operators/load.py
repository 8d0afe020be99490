"""Load jobs: one table, all tables in two lanes, one filtered table."""

from __future__ import annotations

import itertools
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext
from dataclasses import astuple, dataclass, replace
from datetime import datetime, timezone
from typing import Any, TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from snaplake.config import DEFAULT_LARGE_TABLE_WORKERS, LoadConfig
from snaplake.frames import local_frame
from snaplake.operators.progress import LoadProgress
from snaplake.plans.load_plan import BATCHED
from snaplake.sinks.base import Sink, Target
from snaplake.sources.base import Source

X = TypeVar("X")

RESULT_SCHEMA = (
    "source string, ns string, table string, strategy string, rows bigint, status string, attempts int, error string, "
    "digest string"
)


@dataclass(frozen=True)
class TableLoad:
    source: str
    ns: str
    table: str
    strategy: str
    rows: int | None
    status: str  # success, failed or cancelled
    attempts: int
    error: str | None = None
    digest: str | None = None  # of the rows, where the sink takes one


# What a run sets on a thread: its pool and its job group.
RUN_PROPERTIES = (
    "spark.scheduler.pool", "spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel",
)


class LoadFailed(RuntimeError):
    """Some tables failed twice; ``results`` has every table's outcome."""

    def __init__(self, results: list[TableLoad]):
        bad = [f"{r.ns}.{r.table}" for r in results if r.status == "failed"]
        super().__init__(f"{len(bad)} table(s) failed after a retry: {', '.join(sorted(bad))}")
        self.results = results


class RunCancelled(RuntimeError):
    """The run was cancelled between two waves."""


class Run:
    """Handle of one run: its Spark jobs share a job group, so it can be cancelled from any thread.

    With ``asked``, another driver can cancel it too: it says whether that has been asked for, and is called between
    tables and between waves.
    """

    def __init__(self, spark: SparkSession, run_id: str | None = None, asked: Callable[[], bool] | None = None):
        self.spark = spark
        self.run_id = run_id or str(uuid.uuid4())
        self.asked = asked
        self.cancelled_at: datetime | None = None
        self._stop = threading.Event()

    @property
    def cancelled(self) -> bool:
        return self._stop.is_set()

    def poll(self) -> bool:
        """Whether the run is cancelled, by this driver or another one."""
        if not self.cancelled and self.asked is not None and self.asked():
            self.cancel()
        return self.cancelled

    def cancel(self) -> None:
        """Stop the jobs that run and start no further table. Published tables stay as they are."""
        self.cancelled_at = datetime.now(timezone.utc)
        self._stop.set()
        # Also the jobs a thread is about to submit: it may have looked at the flag just before it was set.
        self.spark.sparkContext._jsc.sc().cancelJobGroupAndFutureJobs(self.run_id)

    @contextmanager
    def jobs(self, pool: str, description: str) -> Iterator[None]:
        """The calling thread's jobs belong to this run and to a scheduler pool, for the time being."""
        context = self.spark.sparkContext
        before = {name: context.getLocalProperty(name) for name in RUN_PROPERTIES}
        context.setLocalProperty("spark.scheduler.pool", pool)
        context.setJobGroup(self.run_id, description, interruptOnCancel=True)
        try:
            yield
        finally:
            for name, value in before.items():
                context.setLocalProperty(name, value)


def target_of(source: Source, ns: str, table: str) -> Target:
    return Target.of(source.dialect.name, ns, table, source.database)


def load_table(
    source: Source, sink: Sink, entry: Row, *, publish: str = "atomic", progress: LoadProgress | None = None, run: Run | None = None
) -> int:
    """Load one planned table and return the rows written.

    ``atomic`` reads every slice, as many at a time as the source bears, and publishes once. ``incremental`` replaces
    the table with its first slice and appends the others; a cancelled one leaves the slices that were published. Slices
    are as planned, or wider where the source bears it (``step_entry``).
    With ``progress``, a load of several waves that did not come to its end is gone on with after its last wave.
    """
    target = target_of(source, entry["ns"], entry["table"])
    if publish == "atomic":
        return _load_waves(source, sink, entry, target, progress, run)
    if publish != "incremental":
        raise ValueError(f"unknown publish mode {publish!r}")
    rows, entry = 0, source.step_entry(entry)
    for piece in source.pieces(entry):
        _go_on(run)
        write = sink.append if piece["slice_no"] else sink.replace
        rows += write(source.read_slice(entry, piece), target)
    return rows


def _go_on(run: Run | None) -> None:
    if run is not None and run.poll():
        raise RunCancelled(f"run {run.run_id} was cancelled")


def _load_waves(source: Source, sink: Sink, entry: Row, target: Target, progress: LoadProgress | None, run: Run | None) -> int:
    """One wave after the other, each opened when the one before is written, and published together."""
    load = progress.open_load(entry) if progress else None
    if load is not None:
        frames = source.waves(load.entry, first=load.first, layout=load.layout)
        frame = next(frames, None)
        if frame is not None and frame.schema.json() != load.columns:
            load = None  # the table has changed since
    if load is None:
        layout = source.layout(entry)
        frames = source.waves(entry, layout=layout)
        frame = next(frames)
        ahead = next(frames, None)
        if ahead is None:
            return sink.replace(frame, target)
        frames = itertools.chain([ahead], frames)
        if progress is not None:
            load = progress.start(entry, layout, frame.schema.json())
    stage = sink.stage(target, load.token if load else None)
    wave = 0
    if load is not None:
        wave = load.first
        for n in range(wave):
            stage.skip(load.waves[n])
    while frame is not None:
        _go_on(run)
        written = stage.write(wave, frame)
        if load is not None:
            progress.wrote(load, wave, written)
        wave, frame = wave + 1, next(frames, None)
    stage.publish()
    if load is not None:
        progress.published(load)
    return stage.written.rows


def load_all(
    spark: SparkSession,
    source: Source,
    sink: Sink,
    plan: DataFrame,
    cfg: LoadConfig,
    *,
    run: Run | None = None,
    publish: str = "atomic",
    progress: LoadProgress | None = None,
) -> list[TableLoad]:
    """Load every planned table, small and large ones side by side, each lane in its own scheduler pool.

    Failed tables are tried once more after the others; ``LoadFailed`` is raised when one fails again. With
    ``progress``, a table's second try, or that of a later run, goes on where the first one stopped.
    """
    run = run or Run(spark)
    entries = plan.collect()  # one row per table
    results = _pass(entries, source, sink, cfg, run, publish, progress, attempt=1)
    failed = {(r.ns, r.table) for r in results if r.status == "failed"}
    if failed and not run.cancelled:
        again = [e for e in entries if (e["ns"], e["table"]) in failed]
        second = _pass(again, source, sink, cfg, run, publish, progress, attempt=2)
        results = [r for r in results if (r.ns, r.table) not in failed] + second
    if any(r.status == "failed" for r in results) and not run.cancelled:
        raise LoadFailed(results)
    return results


def _pass(
    entries: list[Row], source: Source, sink: Sink, cfg: LoadConfig, run: Run, publish: str, progress: LoadProgress | None,
    attempt: int,
) -> list[TableLoad]:
    lanes = {
        "small": (cfg.num_threads, [e for e in entries if not e["large"]]),
        "large": (cfg.large_table_workers, [e for e in entries if e["large"]]),
    }

    def one(lane: str, entry: Row) -> TableLoad:
        done = TableLoad(entry["source"], entry["ns"], entry["table"], entry["strategy"], None, "cancelled", attempt)
        if run.poll():
            return replace(done, attempts=attempt - 1)
        try:
            with run.jobs(lane, f"load {entry['ns']}.{entry['table']}"):
                rows = load_table(source, sink, entry, publish=publish, progress=progress, run=run)
            seen = sink.written(target_of(source, entry["ns"], entry["table"]))
            digest = None if seen is None or seen.digest is None else str(seen.digest)
            return replace(done, rows=rows, status="success", digest=digest)
        except Exception as problem:  # noqa: BLE001 - one table's failure must not stop the others
            status = "cancelled" if run.cancelled else "failed"
            return replace(done, status=status, error=str(problem).splitlines()[0])

    pools = [(ThreadPoolExecutor(max_workers=n), lane, todo) for lane, (n, todo) in lanes.items() if todo]
    try:
        # Asked anew for every table: each call copies the local properties, which the table's jobs then own.
        futures = [
            pool.submit(inheritable_thread_target(run.spark)(one), lane, entry)
            for pool, lane, todo in pools
            for entry in todo
        ]
        return [f.result() for f in futures]
    finally:
        for pool, _, _ in pools:
            pool.shutdown()


def results_frame(spark: SparkSession, results: Iterable[TableLoad]) -> DataFrame:
    """Outcomes as a DataFrame, for the ledger and the manifest."""
    return local_frame(spark, [astuple(r) for r in results], RESULT_SCHEMA)


def failed_tables(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status") == "failed")


def load_filtered(
    source: Source,
    sink: Sink,
    ns: str,
    table: str,
    group: Mapping[str, Any],
    *,
    entry: Row | None = None,
    target: Target | None = None,
    run: Run | None = None,
) -> int:
    """Snapshot the rows of one table that pass a filter, then compact them.

    Lands on the table's own target unless another is given: it then takes the place of a full load. With a
    plan ``entry`` (``plan_table`` makes one) the source is read in parallel; the filter goes to every reader.
    """
    if run and run.poll():
        raise RuntimeError("the run was cancelled before the load started")
    with run.jobs("small", f"load {ns}.{table} filtered") if run else nullcontext():
        where = target or target_of(source, ns, table)
        frames = source.scan_where(ns, table, group) if entry is None else source.waves(entry, group)
        rows = sink.replace(frames, where)
        if not (run and run.cancelled):
            compact_table(sink, where)
    return rows


def compact_table(sink: Sink, target: Target) -> str | None:
    """Compact one table; returns what went wrong, if anything. The rows are safe either way."""
    try:
        sink.compact(target)
    except Exception as problem:  # noqa: BLE001 - an uncompacted table is still a good table
        return str(problem).splitlines()[0]
    return None


def compact_loaded(
    source: Source, sink: Sink, plan: DataFrame, run: Run | None = None, workers: int = DEFAULT_LARGE_TABLE_WORKERS
) -> list[tuple[str, str, str | None]]:
    """Compact the tables that were loaded in batches, ``workers`` at a time; starts none once the run is cancelled."""

    def one(entry: Row) -> tuple[str, str, str | None] | None:
        if run and run.poll():
            return None
        with run.jobs("small", f"compact {entry['ns']}.{entry['table']}") if run else nullcontext():
            return entry["ns"], entry["table"], compact_table(sink, target_of(source, entry["ns"], entry["table"]))

    entries = plan.filter(F.col("strategy").isin(*BATCHED)).collect()
    return [r for r in in_lanes(source.spark, one, entries, workers) if r is not None]


def in_lanes(spark: SparkSession, work: Callable[[Row], X], entries: list[Row], workers: int) -> list[X]:
    """``work`` of every entry, ``workers`` at a time, each in a thread with local properties of its own."""
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(work), e) for e in entries]
        return [f.result() for f in futures]
