"""How the registered scans read their tables."""

from pyspark.sql import functions as F

from checks import scans
from snaplake.workspace import shared_dir

DATA = "/root/testdata/sf0.01"


def test_a_page_range_scan_reads_the_table_once(spark):
    plan = scans.scan_page_range(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") <= 2  # the rows, and the files' row counts


def files_of(spark, folder):
    src = scans._in_files(spark, folder)
    rows = src.scan("app", "lineitem")
    return [r["count"] for r in rows.groupBy(F.col("_metadata.file_path").alias("f")).count().collect()]


def test_files_of_a_table_are_as_many_as_the_tasks_that_read_it(spark):
    assert files_of(spark, DATA) == [10_000] * 6
    many = shared_dir(spark, "many")
    spark.read.parquet(f"{DATA}/lineitem.parquet").repartition(24).write.parquet(f"{many}/lineitem.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task for each file
    try:
        found = files_of(spark, many)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(found) == 24 and sum(found) == 60_000
