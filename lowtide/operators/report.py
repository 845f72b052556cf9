"""Reports over the long result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lowtide.functions import codes
from lowtide.functions.sizing import lookup

TERMS = ["numerator", "denominator"]
PREFIX = "CW_"


def tally(result: DataFrame) -> DataFrame:
    """Rows of each term per mode and metric."""
    counts = result.groupBy("mode", "metric").agg(
        *[F.count_if(F.col("term") == t).alias(t) for t in TERMS])
    return counts


def monthly_rate(result: DataFrame, months: list[str], demographics: DataFrame) -> DataFrame:
    """Distinct patients per month and term, their ratio, and the metric's limits.

    Two grouping steps: patients are made distinct first (combined map-side),
    then counted, so both terms come out of one pass.
    """
    patients = (result.filter(F.col("TEST_DATE_month").isin(months))
                .groupBy("mode", "metric", "TEST_DATE_month", "MRN")
                .agg(*[F.max((F.col("term") == t).cast("int")).alias(t) for t in TERMS]))
    rate = patients.groupBy("mode", "metric", "TEST_DATE_month").agg(*[F.sum(t).alias(t) for t in TERMS])
    rate = rate.withColumn("proportion", F.coalesce(F.try_divide("numerator", "denominator"), F.lit(0.0)))
    rules = lookup(demographics)
    return rate.join(rules, F.col("metric") == F.col("key"), "left").drop("key")


def monthly_patients(result: DataFrame, term: str, months: list[str], demographics: DataFrame) -> DataFrame:
    """Patient list per month for one term."""
    rows = result.filter((F.col("term") == term) & F.col("TEST_DATE_month").isin(months))
    long_name = F.concat(F.lit(PREFIX), "metric")
    return (rows.select("mode", long_name.alias("Long_Metric"), codes.strip_metric_prefix(long_name).alias("Metric"),
                        "MRN", "TEST_DATE_month")
            .join(lookup(demographics), F.col("Metric") == F.col("key"), "left").drop("key"))


def stitched(result: DataFrame, term: str) -> DataFrame:
    """All metrics of a term side by side, patient ids without leading zeros."""
    return result.filter(F.col("term") == term).select(
        "mode", F.concat(F.lit(PREFIX), "metric").alias("Metric"), "ENC_ID", codes.trim_leading_zeros(F.col("MRN")).alias("MRN"),
        "TEST_CODE", "TEST_DATE_a", "TEST_DATE_month", "CLAIM_DATE", "ADM_DT_a", "AgeAtTest")


def count_table(result: DataFrame, modes: list[str], count: str = "*") -> DataFrame:
    """Rows per (metric, term), one column per mode."""
    return (result.groupBy("metric", "term").pivot("mode", modes)
            .agg(F.count(F.lit(1) if count == "*" else F.col(count))).fillna(0))
