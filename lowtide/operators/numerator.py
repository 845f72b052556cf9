"""Red flags, indications and the last filters of a numerator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lowtide.functions import dates
from lowtide.functions.bitmaps import filtered, key_set
from lowtide.functions.sizing import lookup
from lowtide.operators.cohort import mark_codes
from lowtide.operators.intervals import exists_within
from lowtide.operators.normalize import add_month, first_per_key
from lowtide.operators.skew import deal, join_facts


def matching_claims(claims: DataFrame, rules: DataFrame, code: str = "ICD10_subcode") -> DataFrame:
    """Claims a rule names by its own class: CCS, HCC or ICD, and ICD stems.

    The three tests are semi-joins against lookups; a claim that passes several
    is listed once.
    """
    marks = []
    out = claims
    for cls, column in (("HCC", "hcclev"), ("CCS", "ccslev")):
        wanted = rules.filter(F.col("cls") == cls).select(F.col("subcode").alias(f"_{cls}"), F.lit(True).alias(f"_in{cls}")).distinct()
        out = out.join(lookup(wanted), F.col(column) == F.col(f"_{cls}"), "left").drop(f"_{cls}")
        marks.append(F.col(f"_in{cls}"))
    out = mark_codes(out, code, rules.filter(F.col("cls") == "ICD"), "_inICD")
    marks.append(F.col("_inICD"))
    return out.filter(F.greatest(*[F.coalesce(m, F.lit(False)) for m in marks])).select(*claims.columns)


def matching_patients(claims: DataFrame, rules: DataFrame, code: str = "ICD10_subcode") -> DataFrame:
    return matching_claims(claims, rules, code).select("MRN").distinct()


def without_red_flags(tests: DataFrame, flagged: DataFrame, lookback_days: int) -> DataFrame:
    """Drop every test of a patient who has a flagged claim within lookback of any test."""
    by = deal(tests, ["MRN"])
    marked = exists_within(tests.select("MRN", "TEST_DATE").distinct(), flagged.select("MRN", F.col("EVT_DATE").alias("at")),
                           ["MRN"], F.lit(lookback_days), "_red", by=by)
    return join_facts(tests, marked.filter("_red").select("MRN").distinct(), ["MRN"], "left_anti", by)


def with_indication(tests: DataFrame, indicated: DataFrame) -> DataFrame:
    """Keep the tests of patients that match the indication list."""
    return join_facts(tests, indicated.select("MRN").distinct(), ["MRN"], "left_semi")


def fresh_secondary(gap: Column, window_days: int, code: Column) -> Column:
    """The secondary code unless it is older than the window."""
    return F.when(gap <= window_days, code)


def without_old_complaints(tests: DataFrame, claims: DataFrame, indications: DataFrame, window_days: int,
                           code: str = "ICD10_subcode") -> DataFrame:
    """Keep a test that has a claim younger than the window, or any earlier claim
    that is not an indication (whole codes; a stem counts by its own text)."""
    marks = []
    for cls, column in (("ICD", code), ("HCC", "hcclev"), ("CCS", "ccslev")):
        if column in claims.columns:
            marks.append((cls, column))
    out = claims = filtered(claims, "MRN", key_set(tests, "MRN"))
    for cls, column in marks:
        wanted = indications.filter(F.col("cls") == cls).select(F.col("subcode").alias("_c"), F.lit(True).alias(f"_is{cls}")).distinct()
        out = out.join(lookup(wanted), F.col(column) == F.col("_c"), "left").drop("_c")
    old = F.coalesce(*[F.col(f"_is{cls}") for cls, _ in marks], F.lit(False))
    first_new = out.filter(~old).groupBy("MRN").agg(F.min("EVT_DATE").alias("_new"))
    by = deal(tests, ["MRN"])
    times = tests.select("MRN", "TEST_DATE").distinct()
    recent = exists_within(times, claims.select("MRN", F.col("EVT_DATE").alias("at")), ["MRN"], F.lit(window_days),
                           "_recent", open_end=True, by=by)
    kept = join_facts(recent, first_new, ["MRN"], "left", by).filter(F.col("_recent") | (F.col("_new") <= F.col("TEST_DATE")))
    return tests.join(kept.select("MRN", "TEST_DATE"), ["MRN", "TEST_DATE"], "left_semi")


def not_recently_admitted(tests: DataFrame, flag: str = "adms_flag") -> DataFrame:
    return tests.filter(~F.col(flag))


def one_per_service(tests: DataFrame) -> DataFrame:
    """One row per (patient, day, code), with the month label."""
    dated = tests.withColumn("TEST_DATE_a", F.to_date("TEST_DATE"))
    return add_month(first_per_key(dated, ["MRN", "TEST_DATE_a", "TEST_CODE"], ["TEST_DATE"]), "TEST_DATE")


def one_per_month(services: DataFrame) -> DataFrame:
    """One row per (patient, month): the earliest service."""
    labelled = services.withColumn("TEST_DATE_month", dates.month_label(F.col("TEST_DATE")))
    return first_per_key(labelled, ["MRN", "TEST_DATE_month"], ["TEST_DATE"])


