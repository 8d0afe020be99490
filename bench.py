"""Seconds of the headline loads at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``, as one JSON line."""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.loads import EXPENSIVE_RETURNS  # noqa: E402
from checks.tables import NS, new_sink, plan_entries, source, sources  # noqa: E402
from snaplake import FileSource, FileTable, LoadConfig, load_all, load_filtered, load_table, plan_source  # noqa: E402
from snaplake.operators.load import target_of  # noqa: E402
from snaplake.workspace import shared_dir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

# Thresholds under which every strategy has work to do at the bench's scale.
CUT = LoadConfig(chunk_size=25_000, large_table_threshold=10_000, large_table_batch_size=50_000)
WHOLE = LoadConfig(chunk_size=25_000, large_table_threshold=10_000, large_table_batch_size=50_000, single_shot=True)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("snaplake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workloads(spark: SparkSession) -> dict[str, Callable[[], int]]:
    """Each returns the rows it handled."""
    mysql, postgresql = sources(spark, SF_DIR)
    mysql_files, postgresql_files = in_files(spark, mysql, "orders"), in_files(spark, postgresql, "lineitem")
    sliced = source(spark, SF_DIR, "mysql", slice_by="plan")
    keyed = plan_entries(sliced, CUT)
    whole, groups = plan_entries(postgresql_files, WHOLE), plan_entries(postgresql_files, CUT)
    orders_whole, orders_groups = plan_entries(mysql_files, WHOLE), plan_entries(mysql_files, CUT)
    assert min(e["batches"] for e in (groups["lineitem"], orders_groups["orders"], keyed["orders"])) > 1 or SF_DIR.endswith("01")
    fragments = new_sink(spark)
    target = target_of(postgresql, NS["postgresql"], "lineitem")

    kept = shared_dir(spark, "bench") + "/profiles.json"
    plan_source(many_tables(spark, profiles=kept), LoadConfig())

    def load(src, entry, publish="atomic"):
        return lambda: load_table(src, new_sink(spark), entry, publish=publish)

    def load_everything() -> int:
        done = 0
        for kind in ("mysql", "postgresql"):
            src = source(spark, SF_DIR, kind)
            done += sum(r.rows for r in load_all(spark, src, new_sink(spark), plan_source(src, LoadConfig()), LoadConfig()))
        return done

    def compact() -> int:
        fragments.replace(postgresql.scan(NS["postgresql"], "lineitem").repartition(40), target)
        started = time.perf_counter()
        fragments.compact(target)
        return started  # the clock starts after the fragments are written

    return {
        # Eight files of many row groups each: one job over all, and a job for each group of files.
        "load_lineitem_whole": load(postgresql_files, whole["lineitem"]),
        "load_lineitem_file_groups": load(postgresql_files, groups["lineitem"], "incremental"),
        "load_orders_whole": load(mysql_files, orders_whole["orders"]),
        "load_orders_file_groups": load(mysql_files, orders_groups["orders"], "incremental"),
        # One file, read again for each slice: what a source that is sliced by keys or hashes does.
        "load_orders_key_slices": load(sliced, keyed["orders"], "incremental"),
        "load_customer_hash_slices": load(sliced, keyed["customer"], "incremental"),
        "load_filtered_lineitem": lambda: load_filtered(
            postgresql, new_sink(spark), NS["postgresql"], "lineitem", EXPENSIVE_RETURNS
        ),
        "load_all_tables": load_everything,
        "plan_all_tables": lambda: sum(plan_source(source(spark, SF_DIR, k), LoadConfig()).count() for k in NS),
        "plan_60_tables": lambda: plan_source(many_tables(spark), LoadConfig()).count(),
        # The same with figures that an earlier session kept: no table has changed.
        "plan_60_unchanged_tables": lambda: plan_source(many_tables(spark, profiles=kept), LoadConfig()).count(),
        "compact_lineitem": compact,
    }


def in_files(spark: SparkSession, given: FileSource, table: str, files: int = 8) -> FileSource:
    """A source whose table is in several files of many row groups."""
    ns, folder = NS[given.dialect.name], shared_dir(spark, "bench")
    spark.conf.set("parquet.block.size", str(1 << 20))
    given.scan(ns, table).repartition(files).write.parquet(folder)
    spark.conf.unset("parquet.block.size")
    tables = {(ns, table): FileTable(folder, given.tables[ns, table].key_columns)}
    return FileSource(spark, given.dialect, tables, rows_per_page=given.rows_per_page)


def many_tables(spark: SparkSession, n: int = 60, profiles: str | None = None) -> FileSource:
    """A source with many declared tables, all over one folder of files."""
    given = source(spark, SF_DIR, "mysql")
    path = given.tables[NS["mysql"], "supplier"].path
    return FileSource(spark, given.dialect, {("shop", f"t{k}"): FileTable(path, ("s_suppkey",)) for k in range(n)}, profiles=profiles)


def main() -> None:
    spark = session()
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name, work in workloads(spark).items():
        taken = []
        for _ in range(REPEATS):
            started = time.perf_counter()
            result = work()
            if isinstance(result, float):
                started = result
            else:
                rows[name] = result
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken), 3)
    scale = re.search(r"sf([\d.]+)", SF_DIR)
    print(json.dumps({
        "metric": "snapshot load seconds, sum of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": {n: round(r / seconds[n]) for n, r in rows.items() if seconds[n]},
        "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
