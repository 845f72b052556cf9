"""Joins of services with earlier events of the same patient."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lowtide.functions import dates
from lowtide.operators.intervals import following_summary, prior_summary
from lowtide.operators.skew import deal, join_facts
from lowtide.sources.sinks import stage


def claim_history(services: DataFrame, claims: DataFrame, keep_all: bool = False) -> DataFrame:
    """Each service with its earlier claims summed up: number, first, last, gaps.

    ``keep_all`` keeps services without an earlier claim (null dates, zero
    claims); otherwise they are dropped. Claims without a code do not count.
    """
    coded = claims.filter(F.col("ICD10_subcode").isNotNull()).select("MRN", F.col("EVT_DATE").alias("at"))
    out = prior_summary(services, coded, ["MRN"], {
        "n_claims": ("sum", F.lit(1)), "first_claim": ("min", F.col("at")), "last_claim": ("max", F.col("at"))})
    out = out.withColumn("first_gap", dates.day_gap(F.col("TEST_DATE"), F.col("first_claim")))
    out = out.withColumn("last_gap", dates.day_gap(F.col("TEST_DATE"), F.col("last_claim")))
    return out if keep_all else out.filter("n_claims > 0")


def recently_admitted(index_day: Column, test: Column, admitted: Column, discharged: Column, window: Column) -> Column:
    """Admission day or discharge less than ``window`` days before; no admission means no."""
    near = (F.datediff(index_day, admitted) < window) | (dates.day_gap(test, discharged) < window)
    return F.coalesce(near, F.lit(False))


def _stays(admissions: DataFrame) -> DataFrame:
    """Admissions with the instant from which both ends are past."""
    return admissions.select("MRN", F.greatest("ADM_DT", "DIS_DT").alias("at"),
                             F.to_date("ADM_DT").alias("ADM_DT_a"), "DIS_DT")


def best_admission(rows: DataFrame, admissions: DataFrame, unmatched: str = "reference") -> DataFrame:
    """Latest admission that started and ended by ``TEST_DATE``: ``ADM_DT_a``, ``DIS_DT``.

    A patient without admissions is kept with nulls. One whose admissions all
    come later is dropped (``unmatched='reference'``) or kept (``'keep'``).
    """
    if unmatched not in ("reference", "keep"):
        raise ValueError(f"unknown policy {unmatched!r}")
    out = prior_summary(rows, _stays(admissions), ["MRN"], {"_a": ("max", F.struct("ADM_DT_a", "DIS_DT"))})
    if unmatched == "reference":
        ever = admissions.select("MRN").distinct().withColumn("_ever", F.lit(True))
        out = join_facts(out, ever, ["MRN"], "left").filter(F.col("_a").isNotNull() | F.col("_ever").isNull()).drop("_ever")
    return out.select("*", "_a.*").drop("_a")


def surgery_admission(surgeries: DataFrame, admissions: DataFrame, keys: list[str]) -> DataFrame:
    """Latest admission before each surgery; one on the surgery day itself is blanked.

    A blanked admission counts as none (row kept with nulls); a patient with
    only later admissions loses the row. Returns ``keys``, ``SURG_DATE``,
    ``ADM_DT_a``, ``DIS_DT``, one row per surgery time.
    """
    distinct = surgeries.select(*keys, "SURG_DATE").distinct()
    stays = _stays(admissions)
    # A stay that began earlier counts from the instant it ended; one that began
    # and ended the same day must wait for the next day to count.
    same_day = F.to_date("at") == F.col("ADM_DT_a")
    stays = stays.withColumn("at", F.when(same_day, F.date_add(F.col("ADM_DT_a"), 1).cast("timestamp")).otherwise(F.col("at")))
    out = prior_summary(distinct, stays, ["MRN"], {"_a": ("max", F.struct("ADM_DT_a", "DIS_DT"))}, at="SURG_DATE")
    by = deal(distinct, ["MRN"])
    on_day = admissions.select("MRN", F.to_date("ADM_DT").alias("_day")).distinct().withColumn("_blank", F.lit(True))
    ever = admissions.select("MRN").distinct().withColumn("_ever", F.lit(True))
    out = join_facts(out.withColumn("_day", F.to_date("SURG_DATE")), on_day, ["MRN", "_day"], "left", by)
    out = join_facts(out, ever, ["MRN"], "left", by).filter(
        F.col("_a").isNotNull() | F.col("_blank").isNotNull() | F.col("_ever").isNull())
    return out.select(*keys, "SURG_DATE", F.col("_a.ADM_DT_a").alias("ADM_DT_a"), F.col("_a.DIS_DT").alias("DIS_DT"))


def kept_surgeries(surgeries: DataFrame, admissions: DataFrame) -> DataFrame:
    """Surgeries that share the patient's latest prior admission.

    For one test the measure keeps, among the later surgeries, those whose prior
    admission is the most recent. Prior admissions only get later from surgery
    to surgery, so that admission is the same for every test of the patient and
    can be found per patient, without pairing tests and surgeries.
    """
    keys = ["MRN", "metric"]
    rated = stage(surgery_admission(surgeries, admissions, keys), "rated")
    stay = F.when(F.col("ADM_DT_a").isNotNull(), F.struct("ADM_DT_a", "DIS_DT"))
    latest = rated.groupBy(*keys).agg(F.max(stay).alias("_best"))
    return join_facts(rated, latest, keys).filter(stay.eqNullSafe(F.col("_best"))).drop("_best")


def surgeries_ahead(tests: DataFrame, surgeries: DataFrame) -> DataFrame:
    """Tests with at least one later surgery: how many, the next and the last one."""
    out = following_summary(tests, surgeries, ["MRN"], {
        "n_surgeries": ("sum", F.lit(1)), "next_surgery": ("min", F.col("at")), "last_surgery": ("max", F.col("at"))})
    return out.filter("n_surgeries > 0")


def before_surgery(tests: DataFrame, window_days: int) -> DataFrame:
    """Tests whose next surgery is at most ``window_days`` away."""
    return tests.filter(dates.day_gap(F.col("next_surgery"), F.col("TEST_DATE")) <= window_days)


def secondary_history(tests: DataFrame, secondary: DataFrame, unmatched: str = "reference") -> DataFrame:
    """Tests with their earlier reference services: number, latest code and its gap.

    A patient whose reference services all come later loses the test
    (``unmatched='reference'``) or keeps it (``'keep'``); one with none keeps it.
    """
    if unmatched not in ("reference", "keep"):
        raise ValueError(f"unknown policy {unmatched!r}")
    out = prior_summary(tests, secondary, ["MRN"], {
        "n_secondary": ("sum", F.lit(1)), "_last": ("max", F.struct(F.col("at"), F.col("CODE").alias("code")))})
    if unmatched == "reference":
        ever = secondary.select("MRN").distinct().withColumn("_ever", F.lit(True))
        out = join_facts(out, ever, ["MRN"], "left").filter((F.col("n_secondary") > 0) | F.col("_ever").isNull()).drop("_ever")
    return out.select(*tests.columns, "n_secondary", F.col("_last.code").alias("rCODE"),
                      dates.day_gap(F.col("TEST_DATE"), F.col("_last.at")).alias("rgap"))
