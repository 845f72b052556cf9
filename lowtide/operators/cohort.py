"""Cohort filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lowtide.functions.sizing import lookup
from lowtide.operators.crosswalk import match_codes
from lowtide.operators.skew import join_facts


def in_limits(age: Column, gender: Column, agemin: Column, agemax: Column, wanted: Column) -> Column:
    """Age in [min, max) and gender as wanted; a null limit does not limit."""
    old_enough = agemin.isNull() | (age >= agemin)
    young_enough = agemax.isNull() | (age < agemax)
    return old_enough & young_enough & ((wanted == "All") | (gender == wanted))


def within_demographics(events: DataFrame, rules: DataFrame, metric: str) -> DataFrame:
    """Events inside one metric's age and gender limits."""
    limit = F.struct("agemin", "agemax", "gendercrit")
    limits = rules.filter(F.col("key") == metric).agg(F.collect_list(limit)).first()[0]
    if len(limits) != 1:
        raise ValueError(f"{len(limits)} demographic rules for {metric!r}")
    low, high, gender = limits[0]
    return events.filter(in_limits(F.col("AgeAtTest"), F.col("GENDER"), F.lit(low), F.lit(high), F.lit(gender)))


def of_metric(rules: DataFrame, metric: str, column: str = "metric") -> DataFrame:
    return rules.filter(F.col(column) == metric)


def resolve_codes(events: DataFrame, code: str, rules: DataFrame) -> DataFrame:
    """Distinct event codes that a rule matches, by equality or stem.

    Only the code list is cut into leading parts; events are matched to the
    resolved codes by equality.
    """
    universe = events.select(F.col(code)).filter(F.col(code).isNotNull()).distinct()
    return match_codes(universe, code, rules).select(code).distinct()


def mark_codes(events: DataFrame, code: str, rules: DataFrame, mark: str) -> DataFrame:
    """Add ``mark``: the event's code is under a rule, by equality or stem.

    One equi-join with the whole codes and one per stem length that occurs, all
    against the rule table: events are not multiplied. The table is raw at the
    join, so a frequent code is split by adaptive execution where the rules are
    too many to be sent to all tasks.
    """
    small = lookup(rules.select("subcode", "startWith").filter(F.length("subcode") > 0).distinct())
    lengths = small.filter("startWith").agg(F.collect_set(F.length("subcode"))).first()[0]
    parts = [(F.col(code), small.filter(~F.col("startWith")))]
    parts += [(F.left(F.col(code), F.lit(n)), small.filter(F.col("startWith") & (F.length("subcode") == n)))
              for n in sorted(lengths)]
    out, hits = events, []
    for i, (probe, part) in enumerate(parts):
        wanted = part.select(F.col("subcode").alias(f"_c{i}"), F.lit(True).alias(f"_h{i}"))
        out = out.join(wanted, probe == F.col(f"_c{i}"), "left").drop(f"_c{i}")
        hits.append(f"_h{i}")
    return out.withColumn(mark, F.coalesce(*hits, F.lit(False))).drop(*hits)


def first_diagnosis(claims: DataFrame, rules: DataFrame, code: str) -> DataFrame:
    """Patients with a claim under the rules and the time of the first one."""
    hits = mark_codes(claims, code, rules, "_dx").filter("_dx")
    return hits.groupBy("MRN").agg(F.min("EVT_DATE").alias("first_dx"))


def after_diagnosis(services: DataFrame, cohort: DataFrame) -> DataFrame:
    """Services on or after the patient's first qualifying diagnosis."""
    return join_facts(services, cohort, ["MRN"]).filter(F.col("EVT_DATE") >= F.col("first_dx"))


def with_codes(services: DataFrame, rules: DataFrame, code: str = "CODE") -> DataFrame:
    """Services whose code is in the set."""
    wanted = rules.select(F.col("subcode").alias("_code")).distinct()
    return services.join(lookup(wanted), F.col(code) == F.col("_code"), "left_semi")


def trim_claims(claims: DataFrame, rules: DataFrame, code: str) -> DataFrame:
    """Claims whose code, hcc or ccs equals a whole rule code, or whose code is under a stem.

    Rule classes are ignored here, as in the measure's definition.
    """
    whole = lookup(rules.filter(~F.col("startWith")).select(F.col("subcode").alias("_code")).distinct())
    out = mark_codes(claims, code, rules, "_under")
    marks = ["_under"]
    for i, column in enumerate(("hcclev", "ccslev")):
        right = whole.select(F.col("_code").alias(f"_l{i}"), F.lit(True).alias(f"_level{i}"))
        out = out.join(right, F.col(column) == F.col(f"_l{i}"), "left").drop(f"_l{i}")
        marks.append(f"_level{i}")
    return out.filter(F.greatest(*[F.coalesce(m, F.lit(False)) for m in marks])).select(*claims.columns)


def in_study(df: DataFrame, start: dt.date, end: dt.date, column: str = "TEST_DATE_a") -> DataFrame:
    return df.filter((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end)))
