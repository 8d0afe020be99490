"""Run ledger: an append-only table of what happened to each run, and what can be asked of it."""

from __future__ import annotations

import re
import time
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import astuple
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.frames import local_frame
from snaplake.functions.expressions import elapsed_text
from snaplake.marks import Marks
from snaplake.operators.lease import Lease
from snaplake.operators.load import RESULT_SCHEMA, Run, TableLoad, failed_tables
from snaplake.sinks.base import Sink, Target

# The states of a run.
PENDING, RUNNING, SUCCESS, FAILED, CANCELLED = "pending", "running", "success", "failed", "cancelled"
ACTIVE = (PENDING, RUNNING)

EVENT_SCHEMA = (
    "run_id string, ts timestamp, status string, db_type string, host string, elapsed_s bigint, error string, "
    "cancelled_at timestamp"
)


OUTCOME_SCHEMA = f"run_id string, {RESULT_SCHEMA}, compaction_problem string"


def latest_runs(events: DataFrame) -> DataFrame:
    """Current state of every run. Elapsed time is told for runs that succeeded, the error for those that failed."""
    stage = F.when(F.col("status") == PENDING, 0).when(F.col("status") == RUNNING, 1).otherwise(2)
    last = F.max_by(F.struct("status", "db_type", "host", "elapsed_s", "error"), F.struct("ts", stage))
    runs = events.groupBy("run_id").agg(
        last.alias("last"), F.min("ts").alias("started_at"), F.max("cancelled_at").alias("cancelled_at")
    )
    status = F.col("last.status")
    return runs.select(
        "run_id",
        status.alias("status"),
        F.col("last.db_type").alias("db_type"),
        F.col("last.host").alias("host"),
        "started_at",
        F.when(status == SUCCESS, elapsed_text(F.col("last.elapsed_s"))).alias("elapsed"),
        F.when(status == FAILED, F.col("last.error")).alias("error"),
        "cancelled_at",
    )


def active_runs(events: DataFrame) -> DataFrame:
    """Runs that are pending or running: each bars a full run of the same source type and host."""
    return latest_runs(events).filter(F.col("status").isin(*ACTIVE)).select("run_id", "db_type", "host", "status")


class RunConflict(RuntimeError):
    """A run for the same source is already pending or running."""


class RunLedger:
    """The ledger as a table of a sink."""

    def __init__(
        self, spark: SparkSession, sink: Sink, target: Target = Target(("ledger",), "runs"), *,
        marks: str | None = None, lease_seconds: float = 120.0,
    ):
        """``marks`` is a folder for leases and cancel marks that all drivers reach: the sink's warehouse, where it has one.
        Without one, a run's claim on its source is only looked up in the ledger and no other driver can cancel it."""
        self.spark = spark
        self.sink = sink
        self.target = target
        folder = marks or getattr(sink, "warehouse", None)
        self.marks = Marks(spark, f"{folder}/{'/'.join(target.namespace)}/_{target.table}") if folder else None
        self.lease_seconds = lease_seconds
        self.outcomes = Target(target.namespace, "table_results")
        self._exists: bool | None = None

    def record(
        self,
        run_id: str,
        status: str,
        db_type: str,
        host: str,
        *,
        elapsed_s: int | None = None,
        error: str | None = None,
        cancelled_at: datetime | None = None,
    ) -> None:
        row = (run_id, datetime.now(timezone.utc), status, db_type, host, elapsed_s, error, cancelled_at)
        event = local_frame(self.spark, [row], EVENT_SCHEMA).coalesce(1)
        (self.sink.append if self.exists() else self.sink.replace)(event, self.target)
        self._exists = True

    def record_results(self, run_id: str, results: Iterable[TableLoad], compacted: Iterable[tuple[str, str, str | None]]) -> None:
        """Keep each table's outcome and observed rows, and what went wrong when it was compacted."""
        problems = {(ns, table): problem for ns, table, problem in compacted}
        rows = [(run_id, *astuple(r), problems.get((r.ns, r.table))) for r in results]
        frame = local_frame(self.spark, rows, OUTCOME_SCHEMA).coalesce(1)
        (self.sink.append if self.sink.exists(self.outcomes) else self.sink.replace)(frame, self.outcomes)

    def table_results(self) -> DataFrame:
        """Outcomes of the tables of every run."""
        return self.sink.read(self.outcomes) if self.sink.exists(self.outcomes) else local_frame(self.spark, [], OUTCOME_SCHEMA)

    def exists(self) -> bool:
        if self._exists is None:
            self._exists = self.sink.exists(self.target)
        return self._exists

    def events(self) -> DataFrame:
        return self.sink.read(self.target) if self.exists() else local_frame(self.spark, [], EVENT_SCHEMA)

    def runs(self) -> DataFrame:
        return latest_runs(self.events())

    def run(self, run_id: str) -> DataFrame:
        return latest_runs(self.events().filter(F.col("run_id") == run_id))

    @contextmanager
    def follow(self, run: Run, db_type: str, host: str) -> Iterator[None]:
        """Record what becomes of the work done inside."""
        self.record(run.run_id, RUNNING, db_type, host)
        started = time.monotonic()
        try:
            yield
        except BaseException as problem:
            if run.cancelled:
                self.record(run.run_id, CANCELLED, db_type, host, cancelled_at=run.cancelled_at)
            else:
                lines = str(problem).splitlines() or [type(problem).__name__]
                self.record(run.run_id, FAILED, db_type, host, error=lines[0])
            raise
        if run.poll():
            self.record(run.run_id, CANCELLED, db_type, host, cancelled_at=run.cancelled_at)
        else:
            self.record(run.run_id, SUCCESS, db_type, host, elapsed_s=int(time.monotonic() - started))

    def ensure_free(self, db_type: str, host: str) -> None:
        """Refuse a full run while the ledger has another one for the same source. Looks, and claims nothing: a run whose
        lease has expired, with its driver, doesn't count."""
        same = (F.col("db_type") == db_type) & (F.col("host") == host)
        held = self._lease(db_type, host, "").current() if self.marks else None
        gone = held.owner if held and not held.active(time.time()) else None
        busy = active_runs(self.events()).filter(same & ~F.col("run_id").eqNullSafe(F.lit(gone))).first()
        if busy:
            raise RunConflict(f"run {busy['run_id']} is {busy['status']} for {db_type} at {host}")

    def _lease(self, db_type: str, host: str, run_id: str) -> Lease:
        name = re.sub("[^0-9A-Za-z-]", lambda c: f"_{ord(c.group()):x}_", host)
        return Lease(self.marks, f"lease-{db_type}-{name}", run_id, self.lease_seconds)

    def claim(self, run: Run, db_type: str, host: str) -> Lease | None:
        """Make the source this run's own until the lease is released: of several drivers that try at once, one succeeds
        and the others get a ``RunConflict``. If the lease is lost, the run is cancelled."""
        if self.marks is None:
            self.ensure_free(db_type, host)
            return None
        lease = self._lease(db_type, host, run.run_id)
        if not lease.acquire():
            held = lease.current()
            raise RunConflict(f"run {held.owner if held else 'unknown'} holds {db_type} at {host}")
        try:
            self.ensure_free_but(run, db_type, host)
        except BaseException:
            lease.release()
            raise
        lease.keep(run.cancel)
        return lease

    def ensure_free_but(self, run: Run, db_type: str, host: str) -> None:
        """Refuse beside a run that the ledger has and that holds no lease of this kind: one of a driver without marks."""
        same = (F.col("db_type") == db_type) & (F.col("host") == host) & (F.col("run_id") != run.run_id)
        for busy in active_runs(self.events()).filter(same).collect():
            if not self.marks.exists(self._claimed(busy["run_id"])):
                raise RunConflict(f"run {busy['run_id']} is {busy['status']} for {db_type} at {host}")
        self.marks.replace(self._claimed(run.run_id), "")

    @staticmethod
    def _claimed(run_id: str) -> str:
        return f"claimed-{run_id}"

    def ask_to_cancel(self, run_id: str) -> None:
        """Leave a mark for a run of any driver, which looks for it between tables and between waves."""
        if self.marks is None:
            raise ValueError("the ledger has no folder for marks")
        self.marks.replace(f"cancel-{run_id}", "")

    def asked_to_cancel(self, run_id: str) -> bool:
        return self.marks is not None and self.marks.exists(f"cancel-{run_id}")

    def new_run(self, run_id: str | None = None) -> Run:
        """A run that other drivers can cancel."""
        run = Run(self.spark, run_id)
        run.asked = lambda: self.asked_to_cancel(run.run_id)
        return run

    def failed_tables(self, run_id: str | None = None) -> DataFrame:
        """The tables of a run, or of all runs, that failed, with what was tried and the last error."""
        failed = failed_tables(self.table_results())
        return failed if run_id is None else failed.filter(F.col("run_id") == run_id)
