"""Result tables, report files and annotation sheets."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lowtide.session import remove, scratch_dir

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def write_result(result: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The long result, one folder per mode, metric and term.

    Rows are rebalanced on the folder columns first: a folder gets few files of
    even size, and a cell that holds most of the rows is split.
    """
    result.hint("rebalance", "mode", "metric", "term").write.mode(mode).partitionBy("mode", "metric", "term").parquet(path)


def read_result(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    The lineage ends at the files, so a lost executor re-reads them instead of
    recomputing claims and services, and several readers share one pass. The
    files stand for the job's shuffles, which are removed when it ends.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete stage tables that nothing reads any more; what was staged from them stays."""
    for table in tables:
        remove(table.sparkSession, _paths.pop(table))


def write_report(report: DataFrame, path: str) -> None:
    """Comma-separated with a header; the report is already aggregated."""
    report.write.mode("overwrite").csv(path, header=True)


def write_sheets(sample: DataFrame, path: str) -> None:
    """One folder of comma-separated rows per metric, for the annotators."""
    sample.withColumn("sheet", F.col("metric")).hint("rebalance", "sheet").write.mode("overwrite").partitionBy("sheet").csv(path, header=True)


def stage_some(*names: str):
    """``stage`` for the named tables only; the others stay in the plan."""
    def pick(df: DataFrame, name: str) -> DataFrame:
        return stage(df, name) if name in names else df

    return pick
