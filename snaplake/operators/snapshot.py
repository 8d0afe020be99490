"""Full snapshot of a source: catalog, profile, plan, load, compaction."""

from __future__ import annotations

from contextlib import nullcontext
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from snaplake.config import LoadConfig
from snaplake.frames import local_frame
from snaplake.operators.ledger import PENDING, RunLedger
from snaplake.operators.load import LoadFailed, Run, TableLoad, compact_loaded, in_lanes, load_all, results_frame, target_of
from snaplake.operators.progress import LoadProgress
from snaplake.operators.manifest import replication_documents, save_document, snapshot_manifests
from snaplake.plans.catalog import (
    TABLE_ID, assign_page_keys, discover_keys, estimate_pages, list_tables, row_widths, stale_tables,
)
from snaplake.plans.load_plan import PROFILE_COLUMNS, PROFILE_SCHEMA, plan_frame, plan_loads
from snaplake.sinks.base import Sink
from snaplake.sources.base import Source


@dataclass(frozen=True)
class Snapshot:
    plan: DataFrame
    results: list[TableLoad]
    compacted: list[tuple[str, str, str | None]]
    refreshed: list[tuple[str, str]]


def plan_source(source: Source, cfg: LoadConfig, only: tuple[str, str] | None = None) -> DataFrame:
    """Load plan of every table of a source, or of ``only`` one. Only catalog rows, one per table, pass through the
    driver. Row counts that the catalog hasn't, or that are as old as ``stats_max_age_seconds``, are counted anew."""
    spark, catalog = source.spark, source.catalog()
    tables = list_tables(catalog.tables, catalog.namespaces)
    if only is not None:
        tables = tables.filter((F.col("ns") == only[0]) & (F.col("table") == only[1]))
    keys = discover_keys(tables, catalog.constraints, catalog.key_usage, catalog.columns)
    known = estimate_pages(catalog.relations, catalog.column_stats)
    stale = stale_tables(tables.select(*TABLE_ID), catalog.stats_times, F.current_timestamp(), cfg.stats_max_age_seconds)
    aged = keys.join(known, TABLE_ID, "left").join(row_widths(catalog.column_stats), TABLE_ID, "left")
    aged = aged.join(stale.select(*TABLE_ID, F.lit(True).alias("stale")), TABLE_ID, "left")
    found = aged.withColumn("rows", F.when(F.col("stale").isNull(), F.col("rows"))).collect()
    if not found:
        return plan_frame(spark, [])
    profile = _profiled(source, found)
    return plan_frame(spark, plan_loads(local_frame(spark, profile, PROFILE_SCHEMA), cfg).collect())


def _profiled(source: Source, keys: list[Row]) -> list[Row]:
    """Profiles of all tables. Where one can't be profiled, such as an invalid view, halves find it, and it gets a plan
    without figures: its own load will fail and be reported, and the others are loaded."""
    try:
        return assign_page_keys(source.profile(keys)).select(*PROFILE_COLUMNS).collect()
    except Exception as problem:  # noqa: BLE001 - whatever the source says against one of them
        if not _of_source(problem):
            raise
        if len(keys) == 1:
            known = {c: keys[0][c] for c in (*TABLE_ID, "salt_column")}
            return [Row(**{c: known.get(c, {"key_kind": "none", "key_column": None}.get(c, 0)) for c in PROFILE_COLUMNS})]
        half = len(keys) // 2
        return _profiled(source, keys[:half]) + _profiled(source, keys[half:])


def _of_source(problem: Exception) -> bool:
    """Whether a source said no, to one of its tables perhaps: halving the tables helps against nothing else, and least of
    all against a lost cluster."""
    if isinstance(problem, AnalysisException) or not isinstance(problem, (PySparkException, Py4JError)):
        return not isinstance(problem, ConnectionError)
    said = str(problem)
    return any(name in said for name in ("java.sql.", "FileNotFound", "FAILED_READ_FILE", "not a Parquet file"))


def snapshot(
    source: Source,
    sink: Sink,
    cfg: LoadConfig,
    *,
    host: str = "",
    position: Row | None = None,
    documents: str | None = None,
    ledger: RunLedger | None = None,
    run: Run | None = None,
    publish: str = "atomic",
) -> Snapshot:
    """Load every table of ``source`` into ``sink``.

    ``position`` is the log position the caller took from the source; with a ``documents`` folder it is saved
    before loading, and a manifest with the observed row counts after. The ledger refuses a second full run
    for the same source and records this one.
    """
    db_type = source.dialect.name
    if not ledger:
        return _snapshot(source, sink, cfg, position, documents, run or Run(source.spark), publish, None)
    run = run or ledger.new_run()
    lease = ledger.claim(run, db_type, host)
    try:
        ledger.record(run.run_id, PENDING, db_type, host)
        with ledger.follow(run, db_type, host):
            return _snapshot(source, sink, cfg, position, documents, run, publish, ledger)
    finally:
        if lease:
            lease.release()


def _snapshot(
    source: Source, sink: Sink, cfg: LoadConfig, position: Row | None, documents: str | None, run: Run, publish: str,
    ledger: RunLedger | None,
) -> Snapshot:
    """Loads of several waves are gone on with if an earlier run left them, unless ``resume_seconds`` is 0."""
    spark, positions = source.spark, None
    progress = LoadProgress(spark, sink, run.run_id, max_age_seconds=cfg.resume_seconds) if cfg.resume_seconds else None
    if position is not None and documents:
        positions = spark.createDataFrame([position])
        _save(replication_documents(positions), documents)
    with run.jobs("small", "plan"):
        plan = plan_source(source, cfg)
    try:
        results = load_all(spark, source, sink, plan, cfg, run=run, publish=publish, progress=progress)
    except LoadFailed as problem:
        if ledger:
            ledger.record_results(run.run_id, problem.results, [])
        raise
    compacted = [] if run.cancelled else compact_loaded(source, sink, plan, run, cfg.large_table_workers)
    refreshed = [] if run.cancelled else refresh_stale(source, sink, plan, cfg, run)
    if ledger:
        ledger.record_results(run.run_id, results, compacted)
    if positions is not None:
        _save(snapshot_manifests(positions, results_frame(spark, results)), documents)
    return Snapshot(plan, results, compacted, refreshed)


def _save(documents: DataFrame, folder: str) -> None:
    """Save the documents of one run: a handful of small texts."""
    for doc in documents.collect():
        save_document(documents.sparkSession, folder, doc["object_key"], doc["body"])


def refresh_stale(
    source: Source, sink: Sink, plan: DataFrame, cfg: LoadConfig, run: Run | None = None
) -> list[tuple[str, str]]:
    """Recompute the statistics of loaded tables whose source statistics are stale, some at a time; starts none once
    the run is cancelled."""
    now = F.current_timestamp()
    stale = stale_tables(plan.select(*TABLE_ID), source.catalog().stats_times, now, cfg.stats_max_age_seconds)

    def one(entry: Row) -> tuple[str, str] | None:
        if run and run.poll():
            return None
        with run.jobs("small", f"statistics of {entry['ns']}.{entry['table']}") if run else nullcontext():
            sink.refresh_statistics(target_of(source, entry["ns"], entry["table"]))
        return entry["ns"], entry["table"]

    done = in_lanes(source.spark, one, stale.collect(), cfg.large_table_workers)
    return [r for r in done if r is not None]
