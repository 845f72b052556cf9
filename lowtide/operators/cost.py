"""Dollar estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lowtide.functions.sizing import lookup

DRUG_METRICS = ("psyc", "narc")
FLAT_METRIC = "vitd"


def fee_schedule(fees: DataFrame) -> DataFrame:
    """Rows without a modifier: code, description, total, dollars."""
    return fees.filter(F.col("MOD").isNull()).select(
        "HCPCS", "DESCRIPTION", "FACILITY TOTAL", F.col("Calc_reimb_GPCIof1").alias("dollar_reimb"))


def service_cost(rows: DataFrame, schedule: DataFrame) -> DataFrame:
    price = lookup(schedule.select(F.col("HCPCS").alias("_code"), "dollar_reimb"))
    return rows.join(price, F.col("TEST_CODE") == F.col("_code"), "left").drop("_code")


def drug_cost(rows: DataFrame, prices: DataFrame) -> DataFrame:
    """Unit price per row; a drug with two price lines counts twice."""
    price = lookup(prices.select(F.col("Drug Codes").alias("_code"), F.col("Median_Per_Unit_Cost").alias("dollar_reimb")))
    return rows.join(price, F.col("TEST_CODE") == F.col("_code"), "left").drop("_code")


def flat_cost(rows: DataFrame, dollars: float) -> DataFrame:
    return rows.withColumn("dollar_reimb", F.lit(dollars))


def costed(result: DataFrame, schedule: DataFrame, prices: DataFrame, vitd_dollars: float) -> DataFrame:
    """Every row with its price: one join on (kind, code) over a combined price list."""
    kind = F.when(F.col("metric").isin(*DRUG_METRICS), "drug").otherwise("fee")
    lines = schedule.select(F.lit("fee").alias("_kind"), F.col("HCPCS").alias("_code"), "dollar_reimb").unionByName(
        prices.select(F.lit("drug").alias("_kind"), F.col("Drug Codes").alias("_code"),
                      F.col("Median_Per_Unit_Cost").alias("dollar_reimb")))
    priced = result.join(lookup(lines), (F.col("_code") == F.col("TEST_CODE")) & (F.col("_kind") == kind), "left")
    flat: Column = F.when(F.col("metric") == FLAT_METRIC, F.lit(vitd_dollars)).otherwise(F.col("dollar_reimb"))
    return priced.withColumn("dollar_reimb", flat).drop("_kind", "_code")


def dollar_table(priced: DataFrame, modes: list[str]) -> DataFrame:
    """Total dollars per metric and term, one column per mode, missing as zero."""
    return (priced.groupBy("metric", "term").pivot("mode", modes).agg(F.sum("dollar_reimb")).fillna(0.0))
