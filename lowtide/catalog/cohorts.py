"""Registered queries: cohorts, joins, denominators, numerators, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lowtide.catalog import study
from lowtide.catalog.shape import present
from lowtide.catalog.tables import part_rules
from lowtide.functions import dates
from lowtide.operators import cohort as K
from lowtide.operators import history as H
from lowtide.operators import normalize as N
from lowtide.operators import numerator as U
from lowtide.operators.intervals import neighbours
from lowtide.operators.repeat import repeat_scans
from lowtide.plans import trace
from lowtide.plans.rulebook import rules_of
from lowtide.model import MODES
from lowtide.sources import clinical as C

S = study.STUDY


def _rules(spark: SparkSession, metric: str, role: str | None = None, mode: str = "10to10") -> DataFrame:
    rules = K.of_metric(rules_of((MODES[mode],), study.references(spark)), metric).drop("mode")
    return rules if role is None else rules.filter(F.col("role") == role)


def _levelled(spark: SparkSession, sf: str) -> DataFrame:
    return N.attach_levels(study.claims(spark, sf), C.level_map(spark, "hcc", 10), C.level_map(spark, "ccs", 10))


def _tests(spark: SparkSession, sf: str, metric: str | None = None) -> DataFrame:
    """Services under their test names, all or those of one metric."""
    services = study.services(spark, sf)
    if metric is not None:
        services = K.with_codes(services, _rules(spark, metric, "service"))
    return services.select("MRN", "ENC_ID", F.col("CODE").alias("TEST_CODE"), F.col("EVT_DATE").alias("TEST_DATE"))


def _drug_tests(spark: SparkSession, sf: str) -> DataFrame:
    return study.drugs(spark, sf).select("MRN", F.col("CODE").alias("TEST_CODE"), F.col("EVT_DATE").alias("TEST_DATE"))


def coh1_demographics(spark: SparkSession, sf: str) -> DataFrame:
    return present(K.within_demographics(study.services(spark, sf), C.demographics(spark), "bph"))


def coh2_metric_rules(spark: SparkSession, sf: str) -> DataFrame:
    return present(K.of_metric(part_rules(spark, sf), "lbp"), "p_partkey", "role", "cls", "subcode", "startWith")


def coh3_diagnosis_cohort(spark: SparkSession, sf: str) -> DataFrame:
    return present(K.first_diagnosis(study.claims(spark, sf), _rules(spark, "lbp", "indication"), "ICD10_subcode"))


def coh4_after_diagnosis(spark: SparkSession, sf: str) -> DataFrame:
    cohort = K.first_diagnosis(study.claims(spark, sf), _rules(spark, "narc", "indication"), "ICD10_subcode")
    return present(K.after_diagnosis(study.services(spark, sf), cohort), "MRN", "ENC_ID", "CODE", "EVT_DATE", "first_dx")


def coh5_service_codes(spark: SparkSession, sf: str) -> DataFrame:
    rows = K.with_codes(study.services(spark, sf), _rules(spark, "card", "service"))
    return present(rows, "MRN", "ENC_ID", "CODE", "EVT_DATE")


def coh6_trimmed_claims(spark: SparkSession, sf: str) -> DataFrame:
    rows = K.trim_claims(_levelled(spark, sf), _rules(spark, "card", mode="refto10_gems"), "ICD10_subcode")
    return present(rows, "MRN", "EVT_DATE", "ICD10_subcode", "hcclev", "ccslev")


def coh7_study_window(spark: SparkSession, sf: str) -> DataFrame:
    rows = study.services(spark, sf).withColumn("TEST_DATE_a", F.to_date("EVT_DATE"))
    return present(K.in_study(rows, S.start, S.end), "MRN", "ENC_ID", "CODE", "TEST_DATE_a")


def jn1_claim_history(spark: SparkSession, sf: str) -> DataFrame:
    return present(H.claim_history(_tests(spark, sf), study.claims(spark, sf)))


def jn2_claim_history_all(spark: SparkSession, sf: str) -> DataFrame:
    return present(H.claim_history(_tests(spark, sf), study.claims(spark, sf), keep_all=True))


def _surgeries(spark: SparkSession, sf: str) -> DataFrame:
    codes = K.of_metric(C.surgery(spark), "nonpreop").select(F.col("code").alias("subcode"))
    return K.with_codes(study.services(spark, sf), codes).select("MRN", F.col("EVT_DATE").alias("at"))


def jn3_test_surgery(spark: SparkSession, sf: str) -> DataFrame:
    return present(H.surgeries_ahead(_tests(spark, sf), _surgeries(spark, sf)))


def jn4_latest_admission(spark: SparkSession, sf: str) -> DataFrame:
    return present(H.best_admission(_drug_tests(spark, sf), study.admissions(spark, sf)))


def jn4_latest_admission_keep(spark: SparkSession, sf: str) -> DataFrame:
    return present(H.best_admission(_drug_tests(spark, sf), study.admissions(spark, sf), unmatched="keep"))


def jn4_surgery_admission(spark: SparkSession, sf: str) -> DataFrame:
    """As jn4, with the admission of the surgery day itself blanked."""
    surgeries = study.services(spark, sf).select("MRN", F.col("EVT_DATE").alias("SURG_DATE"))
    return present(H.surgery_admission(surgeries, study.admissions(spark, sf), ["MRN"]))


def jn5_recent_admission(spark: SparkSession, sf: str) -> DataFrame:
    rows = H.best_admission(_drug_tests(spark, sf), study.admissions(spark, sf))
    flag = H.recently_admitted(F.to_date("TEST_DATE"), F.col("TEST_DATE"), F.col("ADM_DT_a"), F.col("DIS_DT"), F.lit(60))
    return present(rows.withColumn("adms_flag", flag))


def _secondary(spark: SparkSession, sf: str) -> DataFrame:
    codes = _rules(spark, "vitd").filter(F.col("cls").isin("CPT", "DRUG") & (F.col("role") != "service"))
    return K.with_codes(study.services(spark, sf), codes).select("MRN", "CODE", F.col("EVT_DATE").alias("at"))


def jn6_secondary_codes(spark: SparkSession, sf: str) -> DataFrame:
    return present(H.secondary_history(_tests(spark, sf), _secondary(spark, sf)))


def jn6_secondary_codes_keep(spark: SparkSession, sf: str) -> DataFrame:
    return present(H.secondary_history(_tests(spark, sf), _secondary(spark, sf), unmatched="keep"))


def jn7_before_surgery(spark: SparkSession, sf: str) -> DataFrame:
    rows = H.before_surgery(H.surgeries_ahead(_tests(spark, sf), _surgeries(spark, sf)), 30)
    return present(rows, "MRN", "ENC_ID", "TEST_CODE", "TEST_DATE", "next_surgery")


def den1_patient_months(spark: SparkSession, sf: str) -> DataFrame:
    cohort = K.first_diagnosis(study.claims(spark, sf), _rules(spark, "lbp", "indication"), "ICD10_subcode")
    rows = K.after_diagnosis(study.services(spark, sf), cohort).withColumnsRenamed({"CODE": "TEST_CODE", "EVT_DATE": "TEST_DATE"})
    rows = rows.filter(F.col("TEST_DATE") >= F.lit(S.start).cast("timestamp"))
    return present(U.one_per_month(rows.select("MRN", "ENC_ID", "TEST_CODE", "TEST_DATE")))


def den2_services(spark: SparkSession, sf: str) -> DataFrame:
    """Vitamin D tests with an earlier claim, one row per patient, day and code."""
    rows = H.claim_history(_tests(spark, sf, "vitd"), study.claims(spark, sf))
    return present(U.one_per_service(rows.select("MRN", "ENC_ID", "TEST_CODE", "TEST_DATE")))


def num1_matching_patients(spark: SparkSession, sf: str) -> DataFrame:
    return U.matching_patients(_levelled(spark, sf), _rules(spark, "card", "redflag", "refto10_gems"))


def num2_red_flags(spark: SparkSession, sf: str) -> DataFrame:
    flagged = U.matching_claims(_levelled(spark, sf), _rules(spark, "card", "redflag", "refto10_gems"))
    return present(U.without_red_flags(_tests(spark, sf, "card"), flagged, 365))


def num3_stale_secondary(spark: SparkSession, sf: str) -> DataFrame:
    rows = H.secondary_history(_tests(spark, sf), _secondary(spark, sf), unmatched="keep").filter("n_secondary > 0")
    return present(rows.withColumn("rCODE", U.fresh_secondary(F.col("rgap"), 365, F.col("rCODE"))))


def num4_indications(spark: SparkSession, sf: str) -> DataFrame:
    patients = U.matching_patients(_levelled(spark, sf), _rules(spark, "bph", "indication"))
    return present(U.with_indication(_tests(spark, sf, "bph"), patients))


def num5_old_complaints(spark: SparkSession, sf: str) -> DataFrame:
    return present(U.without_old_complaints(_tests(spark, sf), study.claims(spark, sf), _rules(spark, "bph", "indication"), 60))


def num6_not_admitted(spark: SparkSession, sf: str) -> DataFrame:
    rows = H.best_admission(_drug_tests(spark, sf), study.admissions(spark, sf))
    flag = H.recently_admitted(F.to_date("TEST_DATE"), F.col("TEST_DATE"), F.col("ADM_DT_a"), F.col("DIS_DT"), F.lit(60))
    return present(U.not_recently_admitted(rows.withColumn("adms_flag", flag)), "MRN", "TEST_CODE", "TEST_DATE")


def num7_one_per_service(spark: SparkSession, sf: str) -> DataFrame:
    rows = _tests(spark, sf).filter(F.col("TEST_DATE") >= F.lit(S.start).cast("timestamp"))
    return present(U.one_per_service(rows))


def win1_event_gaps(spark: SparkSession, sf: str) -> DataFrame:
    scans = study.scans(spark, sf).select("MRN", "ENC_ID", "EVT_DATE").distinct()
    return present(neighbours(scans, "MRN", "EVT_DATE"), "MRN", "EVT_DATE", "to_next", "since_last")


def win2_repeat_scans(spark: SparkSession, sf: str) -> DataFrame:
    """Scan services whose patient and encounter belong to a repeat scan."""
    repeats = repeat_scans(study.scans(spark, sf), 730)
    tests = _tests(spark, sf, "dexa")
    begin = tests.agg(F.min("TEST_DATE")).scalar()
    late = repeats.filter(F.col("EVT_DATE") >= begin).select("MRN").distinct()
    rows = tests.join(late, "MRN", "left_semi").join(repeats.select("ENC_ID").distinct(), "ENC_ID", "left_semi")
    return present(rows, "MRN", "ENC_ID", "TEST_CODE", "TEST_DATE")


def win3_feeding_tubes(spark: SparkSession, sf: str) -> DataFrame:
    """Feeding-tube numerator with procedure-coded evidence."""
    rows = study.run(spark, sf, ("feed",), ("refto10_gems",), procedures=True)
    return present(rows.filter("term = 'numerator'"), "MRN", "TEST_CODE", "TEST_DATE_a", "based_on",
                   "CLAIM_DATE").withColumn("CLAIM_DATE", F.substring("CLAIM_DATE", 1, 10))


def trc1_attrition(spark: SparkSession, sf: str) -> DataFrame:
    """Steps of all metrics under all modes."""
    return present(trace.attrition(study.inputs(spark, sf), study.full_book(spark)))


QUERIES = {f.__name__: f for f in (
    coh1_demographics, coh2_metric_rules, coh3_diagnosis_cohort, coh4_after_diagnosis, coh5_service_codes,
    coh6_trimmed_claims, coh7_study_window, jn1_claim_history, jn2_claim_history_all, jn3_test_surgery,
    jn4_latest_admission, jn4_latest_admission_keep, jn4_surgery_admission, jn5_recent_admission, jn6_secondary_codes,
    jn6_secondary_codes_keep, jn7_before_surgery, den1_patient_months, den2_services, num1_matching_patients,
    num2_red_flags, num3_stale_secondary, num4_indications, num5_old_complaints, num6_not_admitted, num7_one_per_service,
    win1_event_gaps, win2_repeat_scans, win3_feeding_tubes, trc1_attrition)}
