"""Base-table builds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lowtide.functions.sizing import lookup
from lowtide.operators import crosswalk as X

# Fixed values of the admission selection.
EXCLUDED_CLASSES = ("O", "B", "E", "P", "N", "U")
OBSERVATION_SERVICES = ("GMD", "HEM", "PGS", "TXN")
MIN_AGE_DAYS = 5475


def _with_patient(df: DataFrame, patients: DataFrame, when: str) -> DataFrame:
    who = patients.select("MRN", "GENDER", "DOB")
    return df.join(who, "MRN").withColumn("AGEATCLAIM", F.datediff(F.col(when), F.col("DOB")))


def prescriptions(raw: DataFrame, patients: DataFrame, entered_after: dt.date) -> DataFrame:
    """Prescriptions entered after a date, with birth date, gender and age in days."""
    recent = raw.filter(F.col("ENTRY_DATE") > F.lit(entered_after).cast("timestamp"))
    return _with_patient(recent, patients, "ENTRY_DATE")


def claims(raw: DataFrame, xwalk: DataFrame, patients: DataFrame) -> DataFrame:
    """ICD-10 claims with their ICD-9 codes: unmapped claims go, several targets fan out."""
    pairs = lookup(xwalk.select(F.col("ICD10_CODE").alias("_ten"), "ICD9_CODE"))
    mapped = raw.drop("ICD9_CODE").join(pairs, F.col("CODE") == F.col("_ten")).drop("_ten")
    return _with_patient(mapped, patients, "EVT_DATE")


def active_crosswalk(xwalk: DataFrame) -> DataFrame:
    return X.active(xwalk)


def older_claims(raw: DataFrame, xwalk: DataFrame, patients: DataFrame, after: dt.date, before: dt.date) -> DataFrame:
    """Older ICD-9 claims re-expressed in ICD-10; both date bounds are exclusive."""
    at = F.col("EVT_DATE")
    bounded = raw.filter((at > F.lit(after).cast("timestamp")) & (at < F.lit(before).cast("timestamp")))
    pairs = lookup(X.active(xwalk).select(F.col("ICD9_CODE").alias("_nine"), F.col("ICD10_CODE").alias("_ten")))
    mapped = bounded.join(pairs, F.col("CODE") == F.col("_nine"))
    mapped = mapped.select("MRN", "ENC_ID", "EVT_DATE", F.col("_ten").alias("CODE"), F.col("_nine").alias("ICD9_CODE"))
    return _with_patient(mapped, patients, "EVT_DATE")


def unified_claims(current: DataFrame, older: DataFrame) -> DataFrame:
    """Both claim tables, patients over fifteen."""
    both = current.unionByName(older.select(*current.columns))
    return both.filter(F.col("AGEATCLAIM") > MIN_AGE_DAYS)


def services(raw: DataFrame, patients: DataFrame) -> DataFrame:
    return _with_patient(raw, patients, "EVT_DATE")


def scans(raw: DataFrame, codes: list[str]) -> DataFrame:
    return raw.filter(F.col("CODE").isin(codes))


def qualifying_admissions(stays: DataFrame) -> DataFrame:
    """Inpatient classes, and observation stays under a few services."""
    kind, service = F.col("PT_CLASS"), F.col("SRV_CODE")
    return stays.filter(~kind.isin(*EXCLUDED_CLASSES) | ((kind == "O") & service.isin(*OBSERVATION_SERVICES)))
