"""Bounded scans and lookup files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def events_between(events: DataFrame, start: dt.date, end: dt.date, column: str = "EVT_DATE") -> DataFrame:
    """Events in ``[start, end)``; plain comparisons, so the scan can skip files."""
    at = F.col(column)
    return events.filter((at >= F.lit(start).cast("timestamp")) & (at < F.lit(end).cast("timestamp")))


def admissions_between(stays: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Admissions in ``[start, end]`` under their ``ADM_`` names."""
    at = F.col("ADM_DT")
    return stays.filter((at >= F.lit(start).cast("timestamp")) & (at <= F.lit(end).cast("timestamp"))).select(
        F.col("MRN").alias("ADM_MRN"), F.col("ENC_ID").alias("ADM_ENC_ID"), "ADM_DT", "DIS_DT")


def seen_patients(patients: DataFrame, encounters: list[tuple[DataFrame, str]], start: dt.date, end: dt.date) -> DataFrame:
    """Patients with an encounter in ``[start, end]`` in any of the tables."""
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    seen = None
    for table, column in encounters:
        rows = table.filter(F.col(column).between(low, high)).select("MRN")
        seen = rows if seen is None else seen.unionByName(rows)
    return patients.join(seen.distinct(), "MRN", "left_semi")


def read_lookup(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """A delimited lookup with a header line and a fixed schema."""
    return spark.read.schema(schema).csv(path, header=True, sep=sep, enforceSchema=False)


def read_warehouse(spark: SparkSession, url: str, table: str, column: str, start: dt.date, end: dt.date,
                   partitions: int = 64, **options: str) -> DataFrame:
    """A database table bounded on a date column, read in parallel date slices."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=column, lowerBound=start.isoformat(), upperBound=end.isoformat(),
        numPartitions=str(partitions), **options)
    return events_between(reader.load(), start, end, column)
