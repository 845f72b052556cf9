"""Registered queries: crosswalk operators and data-quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lowtide.catalog import study
from lowtide.catalog.shape import present
from lowtide.catalog.tables import part_rules
from lowtide.operators import crosswalk as X
from lowtide.operators import normalize as N
from lowtide.operators import quality as Q
from lowtide.sources import clinical as C


def _wide(spark: SparkSession, sf: str, generation: int = 9) -> DataFrame:
    return X.simplify(C.wide_crosswalk(spark, sf), generation, "d")


def _level(code: Column) -> Column:
    """A level for two of three leading characters."""
    return F.when(F.ascii(code) % 3 != 0, (F.ascii(code) % 20).cast("string"))


def _wide_levels(spark: SparkSession, sf: str, kind: str, generation: int) -> DataFrame:
    code = f"ICD{generation}_subcode"
    return C.wide_crosswalk(spark, sf).select(F.col(code).alias("subcode")).distinct().select(
        "subcode", _level(F.col("subcode")).alias(f"{kind}lev")).filter(F.col(f"{kind}lev").isNotNull())


def gem1_simplify(spark: SparkSession, sf: str) -> DataFrame:
    wide = C.wide_crosswalk(spark, sf)
    parts = [X.simplify(wide, g, k).select(F.lit(f"{g}{k}").alias("part"), "ICD9_CODE", "ICD10_CODE")
             for g, k in ((9, "d"), (10, "d"), (9, "p"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def gem2_mixed_relations(spark: SparkSession, sf: str) -> DataFrame:
    return X.mixed_relations(_wide(spark, sf), 9)


def gem3_random_map(spark: SparkSession, sf: str) -> DataFrame:
    return X.unique_map(_wide(spark, sf), 9, "random")


def gem4_upcode_map(spark: SparkSession, sf: str) -> DataFrame:
    return X.unique_map(_wide(spark, sf), 9, "upcode", _wide_levels(spark, sf, "hcc", 10))


def gem5_downcode_map(spark: SparkSession, sf: str) -> DataFrame:
    return X.unique_map(_wide(spark, sf), 9, "downcode", _wide_levels(spark, sf, "hcc", 10))


def gem6_ambiguous_maps(spark: SparkSession, sf: str) -> DataFrame:
    return X.ambiguous(_wide(spark, sf), 9)


def gem7_attach_levels(spark: SparkSession, sf: str) -> DataFrame:
    maps = {(kind, g): _wide_levels(spark, sf, kind, g) for kind in ("hcc", "ccs") for g in (9, 10)}
    return X.attach_both_levels(_wide(spark, sf), maps).select(
        "ICD9_subcode", "ICD10_subcode", "hcclev9", "ccslev9", "hcclev10", "ccslev10")


def gem8_upper_placeholders(spark: SparkSession, sf: str) -> DataFrame:
    return X.upper_placeholders(C.wide_crosswalk(spark, sf)).select("ICD9_CODE", "ICD10_CODE", "ICD10_subcode")


def _claims_per_rule(spark: SparkSession, sf: str, rules: DataFrame, procedures: bool = False) -> DataFrame:
    """Rules with the number of claims under each; codes are counted before matching."""
    used = study.claims(spark, sf, procedures).groupBy("ICD10_subcode").agg(F.count(F.lit(1)).alias("n"))
    hits = X.match_codes(used, "ICD10_subcode", rules).groupBy(*rules.columns).agg(F.sum("n").alias("n_claims"))
    return present(rules.join(hits, rules.columns, "left").withColumn("n_claims", F.coalesce("n_claims", F.lit(0))))


def _rules9(spark: SparkSession) -> DataFrame:
    return study.references(spark).rules[9]


def _gems(spark: SparkSession) -> DataFrame:
    return study.references(spark).crosswalks["gems"]


def gem9_forward_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _claims_per_rule(spark, sf, X.forward_exact(_rules9(spark), _gems(spark)))


def gem10_forward_stems(spark: SparkSession, sf: str) -> DataFrame:
    return _claims_per_rule(spark, sf, X.forward_stems(_rules9(spark), _gems(spark)))


def gem11_forward_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Mapped level rules with the claims on each level."""
    rules = X.forward_levels(_rules9(spark), _gems(spark))
    claims = study.claims(spark, sf).groupBy("ICD10_subcode").agg(F.count(F.lit(1)).alias("n"))
    levelled = N.attach_levels(claims, C.level_map(spark, "hcc", 10), C.level_map(spark, "ccs", 10))
    cells = F.array(F.struct(F.lit("HCC").alias("cls"), F.col("hcclev").alias("subcode")),
                    F.struct(F.lit("CCS").alias("cls"), F.col("ccslev").alias("subcode")))
    counts = levelled.select("n", F.inline(cells)).filter(F.col("subcode").isNotNull()).groupBy("cls", "subcode").agg(
        F.sum("n").alias("n_claims"))
    return present(rules.join(counts, ["cls", "subcode"], "left").withColumn("n_claims", F.coalesce("n_claims", F.lit(0))))


def gem12_forward_procedures(spark: SparkSession, sf: str) -> DataFrame:
    rules = X.forward_procedures(_rules9(spark), study.references(spark).procedures)
    return _claims_per_rule(spark, sf, rules, procedures=True)


def gem13_forward_rules(spark: SparkSession, sf: str) -> DataFrame:
    refs = study.references(spark)
    return _claims_per_rule(spark, sf, X.forward_rules(refs.rules[9], refs.crosswalks["gems"], refs.procedures).distinct())


def gem14_backward_claims(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.backward_claims(study.claims(spark, sf), study.references(spark).crosswalks["bestMap10"])
    return present(rows, "MRN", "EVT_DATE", "ICD10_subcode", "ICD9_subcode", "hcclev", "ccslev")


def gem15_native_claims(spark: SparkSession, sf: str) -> DataFrame:
    levelled = N.attach_levels(study.claims(spark, sf), C.level_map(spark, "hcc", 10), C.level_map(spark, "ccs", 10))
    return present(X.native_claims(levelled), "MRN", "EVT_DATE", "ICD10_subcode", "hcclev", "ccslev")


def qa1_placeholder_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    code = F.col("ICD10_subcode")
    marked = C.wide_crosswalk(spark, sf).select(
        F.concat(F.left(code, F.lit(3)), F.lit("x"), F.substring(code, F.lit(4), F.length(code))).alias("ICD10_subcode"))
    return Q.placeholder_conflicts(C.raw_claim(spark, sf), marked)


def qa2_procedure_codes(spark: SparkSession, sf: str) -> DataFrame:
    return present(Q.procedure_codes(C.procedure_claim(spark, sf)), "MRN", "ENC_ID", "CODE", "ICD9_CODE", "kind")


def qa3_stem_violations(spark: SparkSession, sf: str) -> DataFrame:
    return present(Q.stem_violations(part_rules(spark, sf)))


def qa4_empty_codes(spark: SparkSession, sf: str) -> DataFrame:
    return present(Q.empty_codes(part_rules(spark, sf)))


def qa5_native_levels(spark: SparkSession, sf: str) -> DataFrame:
    return present(Q.native_level_rules(part_rules(spark, sf)))


def qa6_stray_cpt(spark: SparkSession, sf: str) -> DataFrame:
    return present(Q.stray_cpt_rules(part_rules(spark, sf)))


QUERIES = {f.__name__: f for f in (
    gem1_simplify, gem2_mixed_relations, gem3_random_map, gem4_upcode_map, gem5_downcode_map, gem6_ambiguous_maps,
    gem7_attach_levels, gem8_upper_placeholders, gem9_forward_exact, gem10_forward_stems, gem11_forward_levels,
    gem12_forward_procedures, gem13_forward_rules, gem14_backward_claims, gem15_native_claims, qa1_placeholder_conflicts,
    qa2_procedure_codes, qa3_stem_violations, qa4_empty_codes, qa5_native_levels, qa6_stray_cpt)}
