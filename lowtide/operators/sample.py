"""Stratified review samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lowtide.functions import dates

SEED = 54


def draw_order(*columns: str, seed: int = SEED) -> Column:
    """A repeatable pseudo-random order over the row's own values."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


STRATA = ("metric", "label")


def stratified(rows: DataFrame, quota: DataFrame, key: list[str], seed: int = SEED, strata: tuple[str, ...] = STRATA) -> DataFrame:
    """Up to the quota per stratum, without replacement; the label is hidden.

    ``quota`` has the strata and needed. The outer bound on the rank is a
    literal, so Spark limits every group before the shuffle and a group that
    holds most of the rows still sends only ``max(needed)`` rows per task.
    """
    most = quota.agg(F.max("needed")).first()[0] or 0
    order = W.partitionBy(*strata).orderBy(draw_order(*key, seed=seed), *key)
    ranked = rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= int(most))
    chosen = ranked.join(quota, list(strata)).filter(F.col("_rank") <= F.col("needed"))
    return chosen.drop("_rank", "needed")


def blinded(sampled: DataFrame) -> DataFrame:
    """The sample as annotators see it."""
    return sampled.drop("label").orderBy("metric", "TEST_DATE_a")


def missed_quota(rows: DataFrame, quota: DataFrame, strata: tuple[str, ...] = STRATA) -> DataFrame:
    """Strata with fewer rows than asked for."""
    have = rows.groupBy(*strata).agg(F.count(F.lit(1)).alias("available"))
    return (quota.join(have, list(strata), "left").withColumn("available", F.coalesce("available", F.lit(0)))
            .filter("available < needed"))


def with_month(annotations: DataFrame) -> DataFrame:
    """Annotations tagged with the month of their service day."""
    return annotations.withColumn("TEST_DATE_month", dates.month_label(F.col("TEST_DATE_a")))


def in_period(annotations: DataFrame, months: list[str]) -> DataFrame:
    return annotations.filter(F.col("TEST_DATE_month").isin(months))
