"""Inputs and rulebooks of the registered queries over the test tables."""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lowtide.functions.sizing import lookup
from lowtide.model import METRIC_NAMES, METRICS, MODES, RESULT_SCHEMA
from lowtide.operators import crosswalk as X
from lowtide.operators import normalize as N
from lowtide.plans import rulebook, upkeep
from lowtide.plans.metrics import Inputs, evaluate
from lowtide.session import scratch_dir
from lowtide.sources import builds, clinical as C, readers, sinks
from lowtide.sources import vocabulary as V

STUDY = C.STUDY


def claims(spark: SparkSession, sf_dir: str, procedures: bool = False) -> DataFrame:
    raw = C.procedure_claim(spark, sf_dir) if procedures else C.claim(spark, sf_dir)
    return N.prepare_claims(readers.events_between(raw, STUDY.claim_from, STUDY.end)).select(
        "MRN", "EVT_DATE", "ICD10_subcode", "ICD9_subcode", "AgeAtTest", "GENDER")


def services(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded = readers.events_between(C.service(spark, sf_dir), STUDY.service_from, STUDY.end)
    return N.add_claim_age(N.with_encounter(bounded)).select("MRN", "ENC_ID", "CODE", "EVT_DATE", "AgeAtTest", "GENDER")


def drugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded = readers.events_between(C.rx(spark, sf_dir), STUDY.service_from, STUDY.end, "ENTRY_DATE")
    coded = N.code_drugs(bounded, C.drug_map(spark), V.DRUG_OVERRIDES)
    return N.add_claim_age(coded).select("MRN", F.lit(None).cast("string").alias("ENC_ID"), "CODE", "EVT_DATE",
                                         "AgeAtTest", "GENDER")


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = readers.events_between(builds.scans(C.raw_service(spark, sf_dir), V.SCAN_CODES), STUDY.service_from, STUDY.end)
    return N.add_age(raw, C.patient(spark, sf_dir)).select("MRN", "ENC_ID", "EVT_DATE", "AgeAtTest", "GENDER")


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stays = builds.qualifying_admissions(C.encounter(spark, sf_dir))
    return readers.admissions_between(stays, STUDY.service_from, STUDY.admissions_to).select(
        F.col("ADM_MRN").alias("MRN"), "ADM_DT", "DIS_DT")


def inputs(spark: SparkSession, sf_dir: str, metrics: tuple[str, ...] = METRIC_NAMES, procedures: bool = False) -> Inputs:
    """The tables the metrics read; others stay out."""
    wanted = [METRICS[m] for m in metrics]
    reads_services = any(m.source == "service" or m.secondary or m.admission for m in wanted)
    return Inputs(
        claims=claims(spark, sf_dir, procedures),
        services=services(spark, sf_dir) if reads_services else None,
        drugs=drugs(spark, sf_dir) if any(m.source == "drug" for m in wanted) else None,
        scans=scans(spark, sf_dir) if any(m.repeat_scan for m in wanted) else None,
        admissions=admissions(spark, sf_dir) if any(m.admission for m in wanted) else None,
        study=STUDY)


def levels(spark: SparkSession) -> dict:
    return {(kind, g): C.level_map(spark, kind, g) for kind in ("hcc", "ccs") for g in (9, 10)}


def crosswalks(spark: SparkSession) -> dict[str, DataFrame]:
    """The four maps: both directions in full, and each reduced to one target."""
    raw, maps = X.upper_placeholders(C.crosswalk(spark)), levels(spark)
    full9, full10 = X.simplify(raw, 9, "d"), X.simplify(raw, 10, "d")
    pairs = {
        "gems": full9,
        "bestMap9": X.unique_map(full9, 9, "upcode", maps[("hcc", 10)]),
        "bestMap10": full10,
        "reimburse": X.unique_map(full10, 10, "downcode", maps[("hcc", 9)]),
    }
    named = [p.select(F.lit(name).alias("xname"), "ICD9_subcode", "ICD10_subcode") for name, p in pairs.items()]
    table = lookup(X.attach_both_levels(reduce(DataFrame.unionByName, named), maps))
    return {name: table.filter(F.col("xname") == name).drop("xname") for name in pairs}


@lru_cache(maxsize=4)
def references(spark: SparkSession) -> rulebook.References:
    """Lookups are fixed values, so they are resolved once per session."""
    raw = C.crosswalk(spark)
    rules = {g: N.normalise_rules(C.written_rules(spark, g), g) for g in (9, 10)}
    return rulebook.References(rules, C.demographics(spark), C.surgery(spark), crosswalks(spark),
                               X.simplify(raw, 9, "p"), levels(spark))


@lru_cache(maxsize=4)
def full_book(spark: SparkSession) -> rulebook.Rulebook:
    return rulebook.build(references(spark), list(METRICS), list(MODES))


def book(spark: SparkSession, metrics: tuple[str, ...], modes: tuple[str, ...]) -> rulebook.Rulebook:
    return full_book(spark).subset(list(metrics), list(modes))


def run(spark: SparkSession, sf_dir: str, metrics: tuple[str, ...], modes: tuple[str, ...], procedures: bool = False,
        stage=None) -> DataFrame:
    given = inputs(spark, sf_dir, metrics, procedures)
    rules = book(spark, metrics, modes)
    return evaluate(given, rules) if stage is None else evaluate(given, rules, stage)


#: tables of the test data that the metrics are made from
SOURCES = ("customer", "orders", "lineitem", "part")
_results: dict[tuple[str, str], str] = {}


@lru_cache(maxsize=4)
def _rule_hashes(spark: SparkSession) -> dict[tuple[str, str, str], str]:
    return upkeep.rule_hashes(full_book(spark))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored grid of all 55 cells, read by every report; cells whose rules or input files changed are computed first."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _results:
        _results[key] = scratch_dir(spark, "grid")
    path = _results[key]
    files = upkeep.input_state(spark, [f"{sf_dir}/{name}.parquet" for name in SOURCES])
    states = upkeep.cell_states(full_book(spark), _rule_hashes(spark), STUDY, files)
    upkeep.update(spark, path, full_book(spark), states, lambda metrics: inputs(spark, sf_dir, metrics), sinks.stage)
    return sinks.read_result(spark, path, RESULT_SCHEMA)
