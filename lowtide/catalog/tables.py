"""Registered queries: sources, base tables, normalisation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lowtide import model as M
from lowtide.catalog import study
from lowtide.catalog.shape import present
from lowtide.functions import codes
from lowtide.operators import normalize as N
from lowtide.session import scratch_dir
from lowtide.sources import builds, clinical as C, readers
from lowtide.sources import vocabulary as V

S = study.STUDY


def src1_bounded_scan(spark: SparkSession, sf: str) -> DataFrame:
    return present(readers.events_between(C.raw_service(spark, sf), S.service_from, S.end))


def src2_admission_scan(spark: SparkSession, sf: str) -> DataFrame:
    return present(readers.admissions_between(C.encounter(spark, sf), S.service_from, S.admissions_to))


def src3_seen_patients(spark: SparkSession, sf: str) -> DataFrame:
    stays, contacts = C.visits(spark, sf)
    seen = readers.seen_patients(C.patient(spark, sf), [(stays, "ADM_DT"), (contacts, "CONTACT_DT")],
                                 dt.date(1998, 1, 1), dt.date(1998, 3, 1))
    return present(N.current_age(seen, C.AS_OF))


def src4_lookup_files(spark: SparkSession, sf: str) -> DataFrame:
    """Write drug names as .csv and .tsv, read both under the fixed schema."""
    parts = C.table(spark, sf, "part")
    names = parts.select(F.col("p_name").alias("Drug Names"),
                         F.concat(F.lit("d"), F.lpad(F.col("p_partkey").cast("string"), 5, "0")).alias("Drug Codes"))
    out = None
    for label, sep in (("csv", ","), ("tsv", "\t")):
        path = scratch_dir(spark, f"lookup-{label}")
        names.write.mode("overwrite").csv(path, header=True, sep=sep)
        read = readers.read_lookup(spark, path, M.DRUG_MAP, sep).select(
            F.lit(label).alias("kind"), F.col("Drug Names").alias("name"), F.col("Drug Codes").alias("code"))
        out = read if out is None else out.unionByName(read)
    return out


def bld1_prescriptions(spark: SparkSession, sf: str) -> DataFrame:
    return present(builds.prescriptions(C.raw_rx(spark, sf), C.patient(spark, sf), dt.date(1996, 6, 30)))


def bld2_claims(spark: SparkSession, sf: str) -> DataFrame:
    return present(builds.claims(C.raw_claim(spark, sf), C.crosswalk(spark), C.patient(spark, sf)))


def bld3_active_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    return builds.active_crosswalk(C.wide_crosswalk(spark, sf)).select("ICD9_CODE", "ICD10_CODE", "RELATION_TYPE")


OLDER = (dt.date(1996, 12, 31), dt.date(1997, 4, 2))


def _older(spark: SparkSession, sf: str) -> DataFrame:
    return builds.older_claims(C.older_claim(spark, sf), C.crosswalk(spark), C.patient(spark, sf), *OLDER)


def bld4_older_claims(spark: SparkSession, sf: str) -> DataFrame:
    return present(_older(spark, sf))


def bld5_unified_claims(spark: SparkSession, sf: str) -> DataFrame:
    current = builds.claims(C.raw_claim(spark, sf), C.crosswalk(spark), C.patient(spark, sf))
    return present(builds.unified_claims(current, _older(spark, sf)))


def bld6_services(spark: SparkSession, sf: str) -> DataFrame:
    return present(builds.services(C.raw_service(spark, sf), C.patient(spark, sf)))


def bld7_scans(spark: SparkSession, sf: str) -> DataFrame:
    return present(builds.scans(C.raw_service(spark, sf), V.SCAN_CODES))


def bld8_admissions(spark: SparkSession, sf: str) -> DataFrame:
    return present(builds.qualifying_admissions(C.encounter(spark, sf)))


def nrm1_strip_dots(spark: SparkSession, sf: str) -> DataFrame:
    claims = C.claim(spark, sf)
    return claims.select("MRN", "ENC_ID", codes.strip_dots(F.col("CODE")).alias("ICD10_subcode"),
                         codes.strip_dots(F.col("ICD9_CODE")).alias("ICD9_subcode"))


def _part_codes(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    nine, ten = C.icd9_of(key % 24), C.icd10_of(key % 24)
    return C.table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.when(key % 5 == 0, "x").otherwise(""), nine,
                 F.when(key % 3 == 0, "x").when(key % 3 == 1, "X").otherwise("")).alias("nine"),
        F.concat(F.when(key % 7 == 0, "_").otherwise(""), ten, F.when(key % 3 == 0, "_").otherwise("")).alias("ten"))


def nrm2_x_stems(spark: SparkSession, sf: str) -> DataFrame:
    return present(N.mark_x_stems(_part_codes(spark, sf), "nine"), "p_partkey", "nine", "subcode", "startWith")


def nrm3_underscore_stems(spark: SparkSession, sf: str) -> DataFrame:
    return present(N.mark_underscore_stems(_part_codes(spark, sf), "ten"), "p_partkey", "ten", "subcode", "startWith")


def part_rules(spark: SparkSession, sf: str) -> DataFrame:
    """A rule table that grows with the data."""
    key = F.col("p_partkey")
    return C.table(spark, sf, "part").select(
        "p_partkey", "p_name",
        C.pick(["service", "redflag", "indication"], key % 3).alias("role"),
        C.pick(sorted(M.METRIC_NAMES), key % 11).alias("metric"),
        C.pick(["ICD", "CPT", "DRUG", "HCC", "CCS"], (key % 10) % 5).alias("cls"),
        F.when(key % 17 == 0, None).when(key % 19 == 0, "").otherwise(C.icd10_of(key % 24)).alias("subcode"),
        (key % 4 == 0).alias("startWith"))


def nrm4_dedupe_rules(spark: SparkSession, sf: str) -> DataFrame:
    kept = N.first_per_key(part_rules(spark, sf).drop("role"), ["cls", "metric", "subcode", "startWith"], ["p_partkey"])
    return present(kept)


def nrm5_clean_levels(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    raw = C.table(spark, sf, "part").select(
        F.concat(F.lit("'"), C.icd10_of(key % 24), F.lit("-"), key.cast("string"), F.lit(" '")).alias("'ICD-10-CM CODE'"),
        F.when(key % 7 == 0, "nan").otherwise(F.concat(F.lit("' "), (key % 300).cast("string"), F.lit(".0'"))).alias("'CCS CATEGORY'"))
    return N.clean_levels(raw, "`'ICD-10-CM CODE'`", "`'CCS CATEGORY'`", "ccslev")


def nrm6_extend_levels(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    parts = C.table(spark, sf, "part")
    base = parts.filter(key % 2 == 0).select(C.icd10_of(key % 24).alias("subcode"), (key % 300).cast("string").alias("hcclev"),
                                             F.col("p_name").alias("label"))
    extra = parts.filter(key % 2 == 1).select(C.icd10_of(key % 24).alias("subcode"), F.lit("8").alias("hcclev"))
    return N.extend_levels(base, extra)


def nrm7_attach_levels(spark: SparkSession, sf: str) -> DataFrame:
    rows = N.attach_levels(study.claims(spark, sf), C.level_map(spark, "hcc", 10), C.level_map(spark, "ccs", 10))
    return present(rows, "MRN", "EVT_DATE", "ICD10_subcode", "hcclev", "ccslev", "AgeAtTest")


def nrm8_drug_codes(spark: SparkSession, sf: str) -> DataFrame:
    coded = N.code_drugs(C.raw_rx(spark, sf), C.drug_map(spark), V.DRUG_OVERRIDES)
    return present(coded, "MRN", "EVT_DATE", "MED_NAME", "FIRST_NAME", "CODE")


def nrm9_claim_age(spark: SparkSession, sf: str) -> DataFrame:
    return present(N.add_claim_age(C.claim(spark, sf)), "MRN", "EVT_DATE", "AGEATCLAIM", "AgeAtTest")


def nrm10_scan_age(spark: SparkSession, sf: str) -> DataFrame:
    scans = builds.scans(C.raw_service(spark, sf), V.SCAN_CODES)
    return present(N.add_age(scans, C.patient(spark, sf)))


def nrm11_current_age(spark: SparkSession, sf: str) -> DataFrame:
    return present(N.current_age(C.patient(spark, sf), C.AS_OF))


def nrm12_month_label(spark: SparkSession, sf: str) -> DataFrame:
    return present(N.add_month(C.raw_claim(spark, sf), "EVT_DATE"), "MRN", "ENC_ID", "EVT_DATE_month")


def nrm13_with_encounter(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.raw_service(spark, sf).withColumn(
        "ENC_ID", F.when(F.col("ENC_ID").cast("long") % 13 == 0, "").otherwise(F.col("ENC_ID")))
    return present(N.with_encounter(rows))


def nrm14_trim_zeros(spark: SparkSession, sf: str) -> DataFrame:
    return C.patient(spark, sf).select("MRN", codes.trim_leading_zeros(F.col("MRN")).alias("short"))


def nrm15_metric_name(spark: SparkSession, sf: str) -> DataFrame:
    return C.gold(spark, sf).select("Metric", codes.strip_metric_prefix(F.col("Metric")).alias("name"), "MRN", "TEST_CODE")


QUERIES = {f.__name__: f for f in (
    src1_bounded_scan, src2_admission_scan, src3_seen_patients, src4_lookup_files, bld1_prescriptions, bld2_claims,
    bld3_active_crosswalk, bld4_older_claims, bld5_unified_claims, bld6_services, bld7_scans, bld8_admissions,
    nrm1_strip_dots, nrm2_x_stems, nrm3_underscore_stems, nrm4_dedupe_rules, nrm5_clean_levels, nrm6_extend_levels,
    nrm7_attach_levels, nrm8_drug_codes, nrm9_claim_age, nrm10_scan_age, nrm11_current_age, nrm12_month_label,
    nrm13_with_encounter, nrm14_trim_zeros, nrm15_metric_name)}
