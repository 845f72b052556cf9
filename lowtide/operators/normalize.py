"""Normalisation of codes, levels, drugs, ages and rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lowtide.functions import codes, dates
from lowtide.functions.sizing import lookup


def mark_x_stems(df: DataFrame, code: str = "code") -> DataFrame:
    """ICD-9 style: a trailing ``x`` marks a stem; every ``x`` is then removed."""
    plain = codes.strip_dots(F.col(code))
    return df.withColumn("startWith", codes.ends_in_x(plain)).withColumn("subcode", codes.drop_x(plain))


def mark_underscore_stems(df: DataFrame, code: str = "code") -> DataFrame:
    """ICD-10 style: ``_`` anywhere marks a stem; it is then removed."""
    plain = codes.strip_dots(F.col(code))
    return (df.withColumn("startWith", codes.has_underscore(plain))
            .withColumn("subcode", codes.drop_underscore(plain)))


def normalise_rules(written: DataFrame, generation: int) -> DataFrame:
    """(role, metric, cls, code) -> rules with subcode and stem flag, no repeats."""
    marked = mark_x_stems(written) if generation == 9 else mark_underscore_stems(written)
    return marked.select("role", "metric", "cls", "subcode", "startWith").distinct()


def first_per_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the least row by ``order``, then by every other column.

    The order is total, so the kept row does not depend on partitioning, and
    the minimum is combined map-side, so a hot key never reaches one task whole.
    """
    order = order or []
    rest = order + [c for c in df.columns if c not in keys and c not in order]
    if not rest:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*[_nulls_last(c) for c in rest])).alias("_best"))
    picked = [F.col(f"_best.{c}.v").alias(c) for c in rest]
    return best.select(*keys, *picked).select(*df.columns)


def _nulls_last(column: str):
    return F.struct(F.col(column).isNull().alias("n"), F.col(column).alias("v")).alias(column)


def clean_levels(raw: DataFrame, subcode: str, level: str, name: str) -> DataFrame:
    """Level map with quotes, blanks and decimals removed."""
    return raw.select(F.regexp_replace(F.col(subcode), "[' ]", "").alias("subcode"),
                      codes.clean_level(F.col(level)).alias(name))


def extend_levels(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Level map plus a supplementary one (columns matched by name)."""
    return base.unionByName(extra, allowMissingColumns=True)


def attach_levels(claims: DataFrame, hcc: DataFrame, ccs: DataFrame, code: str = "ICD10_subcode") -> DataFrame:
    """Claims with ``hcclev`` and ``ccslev``; a code with two levels fans out."""
    out = claims
    for levels, name in ((hcc, "hcclev"), (ccs, "ccslev")):
        right = lookup(levels.select(F.col("subcode").alias("_code"), name))
        out = out.join(right, F.col(code) == F.col("_code"), "left").drop("_code")
    return out


def code_drugs(prescriptions: DataFrame, names: DataFrame, overrides: list[tuple[str, str]]) -> DataFrame:
    """Drug code from the first word of the name; literal overrides; uncoded rows dropped."""
    right = lookup(names.select(F.lower(F.col("Drug Names")).alias("_token"), F.col("Drug Codes").alias("CODE")))
    med = F.lower(F.col("MED_NAME"))
    code = F.col("CODE")
    for name, drug in overrides:
        code = F.when(med == name, drug).otherwise(code)
    return (
        prescriptions.withColumn("FIRST_NAME", codes.first_token(F.col("MED_NAME")))
        .join(right, F.col("FIRST_NAME") == F.col("_token"), "left")
        .withColumn("MED_NAME", med)
        .withColumn("CODE", code)
        .filter(F.col("CODE").isNotNull())
        .withColumnRenamed("ENTRY_DATE", "EVT_DATE")
        .drop("_token")
    )


def add_claim_age(df: DataFrame, days: str = "AGEATCLAIM") -> DataFrame:
    return df.withColumn("AgeAtTest", dates.age_from_days(F.col(days)))


def add_age(events: DataFrame, patients: DataFrame) -> DataFrame:
    """Gender and age at the event for tables that carry neither."""
    who = patients.select("MRN", "GENDER", "DOB")
    return events.join(who, "MRN", "left").withColumn("AgeAtTest", dates.age_at(F.col("EVT_DATE"), F.col("DOB")))


def current_age(patients: DataFrame, as_of: dt.date) -> DataFrame:
    return patients.withColumn("current_age", dates.whole_years(F.lit(as_of), F.col("DOB")))


def add_month(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(f"{column}_month", dates.month_label(F.col(column)))


def with_encounter(services: DataFrame) -> DataFrame:
    """Services whose encounter is not the empty text; an unknown one stays."""
    return services.filter(F.col("ENC_ID").isNull() | (F.col("ENC_ID") != ""))


def prepare_claims(claims: DataFrame) -> DataFrame:
    """Dot-free codes of both generations and the age at the claim."""
    return add_claim_age(
        claims.withColumn("ICD10_subcode", codes.strip_dots(F.col("CODE")))
        .withColumn("ICD9_subcode", codes.strip_dots(F.col("ICD9_CODE")))
    )
