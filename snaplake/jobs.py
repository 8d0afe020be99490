"""Snapshot jobs by request: start one in the background, look it up, cancel it.

A request is a mapping with ``db_type, host, port, user, password`` and optionally ``pg_database``, ``single_shot``, and
for the documents of a full run ``position`` (a mapping) and ``documents`` (a folder); a filtered one adds ``source_db,
source_table`` and ``filter_group``.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession

from snaplake.config import LoadConfig
from snaplake.functions.filters import validate_filter
from snaplake.operators.ledger import ACTIVE, PENDING, RunConflict, RunLedger
from snaplake.operators.lease import Lease
from snaplake.operators.load import LoadFailed, Run, load_filtered
from snaplake.operators.snapshot import Snapshot, plan_source, snapshot
from snaplake.sinks.base import Sink
from snaplake.sources.base import Source
from snaplake.sources.dialects import dialect_of
from snaplake.sources.jdbc import JdbcSource

Request = Mapping[str, Any]


def source_of(spark: SparkSession, request: Request, cfg: LoadConfig = LoadConfig()) -> JdbcSource:
    """The relational source a request names, with the settings that its readers take."""
    dialect = dialect_of(request["db_type"])
    database = request.get("pg_database", "postgres") if dialect.physical_pages else ""
    return JdbcSource(
        spark, dialect, request["host"], request["port"],
        user=request["user"], password=request["password"], database=database,
        fetch_size=cfg.fetch_size, connections=cfg.connections, even_reads=cfg.even_reads,
    )


class Jobs:
    def __init__(
        self,
        spark: SparkSession,
        sink: Sink,
        ledger: RunLedger,
        cfg: LoadConfig = LoadConfig(),
        *,
        source: Callable[[SparkSession, Request], Source] | None = None,
        max_jobs: int = 4,
    ):
        self.spark, self.sink, self.ledger, self.cfg = spark, sink, ledger, cfg
        self.source = source or (lambda session, request: source_of(session, request, cfg))
        self._pool = ThreadPoolExecutor(max_workers=max_jobs, thread_name_prefix="snaplake-job")
        self._own: dict[str, tuple[Run, Future, tuple[str, str]]] = {}

    def run(self, request: Request) -> str:
        """Start a full snapshot and return its run id; refused while another run for the source is active."""
        source = self.source(self.spark, request)
        cfg = dataclasses.replace(self.cfg, single_shot=bool(request.get("single_shot", False)))
        run = self.ledger.new_run()
        self._ensure_free(source.dialect.name, request["host"])
        lease = self.ledger.claim(run, source.dialect.name, request["host"])
        position = Row(**request["position"]) if request.get("position") else None
        documents = request.get("documents")

        def work(run: Run) -> Snapshot:
            try:
                done = snapshot(source, self.sink, cfg, position=position, documents=documents, run=run)
            except LoadFailed as problem:
                self.ledger.record_results(run.run_id, problem.results, [])
                raise
            self.ledger.record_results(run.run_id, done.results, done.compacted)
            return done

        return self._start(request, source, work, run, lease)

    def run_filtered(self, request: Request) -> str:
        """Start a filtered snapshot of one table and return its run id."""
        ns, table, group = (request[k] for k in ("source_db", "source_table", "filter_group"))
        validate_filter(group)
        source = self.source(self.spark, request)

        def work(run: Run) -> int:
            with run.jobs("small", f"plan {ns}.{table}"):
                entry = plan_source(source, self.cfg, (ns, table)).first()
            return load_filtered(source, self.sink, ns, table, group, entry=entry, run=run)

        return self._start(request, source, work, self.ledger.new_run(), None)

    def _start(self, request: Request, source: Source, work: Callable[[Run], Any], run: Run, lease: Lease | None) -> str:
        db_type, host = source.dialect.name, request["host"]

        def followed() -> Any:
            try:
                with self.ledger.follow(run, db_type, host):
                    return work(run)
            finally:
                if lease:
                    lease.release()

        try:
            self.ledger.record(run.run_id, PENDING, db_type, host)
        except BaseException:
            if lease:
                lease.release()
            raise
        future = self._pool.submit(inheritable_thread_target(self.spark)(followed))
        self._own[run.run_id] = run, future, (db_type, host)
        return run.run_id

    def _ensure_free(self, db_type: str, host: str) -> None:
        """Ask this driver's own jobs, filtered ones too, before the source is claimed."""
        for run_id, (_, future, place) in self._own.items():
            if place == (db_type, host) and not future.done():
                raise RunConflict(f"run {run_id} is active for {db_type} at {host}")

    def status(self, run_id: str) -> Row:
        found = self.ledger.run(run_id).first()
        if found is None:
            raise KeyError(f"no run {run_id}")
        return found

    def list(self) -> DataFrame:
        return self.ledger.runs()

    def cancel(self, run_id: str) -> None:
        """Cancel a running job: one of this driver at once, however busy the cluster, for no job is needed for it; one of
        another driver when that next looks for a mark, between tables or waves."""
        run, future, _ = self._own.get(run_id, (None, None, None))
        if run is not None and not future.done():
            run.cancel()  # one that waits for its turn will find that it is cancelled
            return
        found = self.ledger.run(run_id).first() if run is None and self.ledger.marks else None
        if found is None or found["status"] not in ACTIVE:
            raise ValueError(f"run {run_id} is not running")
        self.ledger.ask_to_cancel(run_id)

    def failed_tables(self, run_id: str) -> DataFrame:
        """The tables of a run that failed, as rows: attempts and the last error of each."""
        return self.ledger.failed_tables(run_id)

    def wait(self, run_id: str, timeout: float | None = None) -> Any:
        """What the job returned, once it is done; raises what it raised."""
        return self._own[run_id][1].result(timeout)
