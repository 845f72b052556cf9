"""Data-quality checks; each returns its violations (empty means passed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lowtide.functions import codes
from lowtide.operators.crosswalk import with_prefixes

#: Metrics that read CPT codes next to the scored service.
SECONDARY_METRICS = ("dexa", "narc", "vitd")


def placeholder_conflicts(claims: DataFrame, xwalk: DataFrame, code: str = "CODE") -> DataFrame:
    """Claim codes that begin with the part of a crosswalk code before its placeholder X."""
    # the code goes through a generator, past which no filter is moved: a pushed filter would repeat the
    # expressions that make the code, and the scan's generated method would be too large to be compiled
    coded = xwalk.select(F.inline(F.array(F.struct(codes.upper_x(F.col("ICD10_subcode")).alias("_code")))))
    target = F.col("_code")
    tail = F.substring(target, F.lit(2), F.length(target))
    stems = coded.filter(F.contains(tail, F.lit("X"))).select(
        F.concat(F.substring(target, 1, 1), F.substring_index(tail, "X", 1)).alias("stem")).distinct()
    used = claims.groupBy(code).agg(F.count(F.lit(1)).alias("n_claims"))
    return with_prefixes(used, code, "stem").join(stems, "stem", "left_semi").select(code, "stem", "n_claims")


def procedure_codes(claims: DataFrame) -> DataFrame:
    """Claims that carry procedure codes: seven word characters (ICD-10), or two and a dot (ICD-9)."""
    ten = F.col("CODE").rlike(r"^\w{7}")
    nine = F.col("ICD9_CODE").rlike(r"^\w{2}[.]")
    kind = F.when(ten & nine, "both").when(ten, "icd10").when(nine, "icd9")
    return claims.withColumn("kind", kind).filter(F.col("kind").isNotNull())


def stem_violations(rules: DataFrame) -> DataFrame:
    """Stem rows where none may be: services, several classes of one role, classes without stems."""
    stems = rules.filter("startWith")
    size = stems.groupBy("role", "cls").agg(F.count(F.lit(1)).alias("n"))
    classes = size.groupBy("role").agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("n"))
    service = classes.filter("role = 'service'").select(F.lit("service stem").alias("check"), "role",
                                                        F.lit(None).cast("string").alias("cls"), "n")
    mixed = classes.filter("role <> 'service' and classes > 1").select(
        F.lit("stems of several classes").alias("check"), "role", F.lit(None).cast("string").alias("cls"), "n")
    wrong = size.filter("cls <> 'ICD'").select(F.lit("stem outside ICD").alias("check"), "role", "cls", "n")
    return service.unionByName(mixed).unionByName(wrong)


def empty_codes(rules: DataFrame) -> DataFrame:
    """Per role: usable rows, rows without a code, rows with an empty one."""
    code = F.col("subcode")
    return rules.groupBy("role").agg(
        F.count_if(F.length(code) > 0).alias("kept"), F.count_if(code.isNull()).alias("null_codes"),
        F.count_if(code == "").alias("empty_codes"))


def usable_rules(rules: DataFrame) -> DataFrame:
    return rules.filter(F.length("subcode") > 0)


def native_level_rules(rules: DataFrame) -> DataFrame:
    """HCC or CCS rows, which the native mode does not take."""
    return (rules.filter((F.col("role") != "service") & F.col("cls").isin("HCC", "CCS"))
            .groupBy("role", "metric", "cls").agg(F.count(F.lit(1)).alias("n")))


def stray_cpt_rules(rules: DataFrame) -> DataFrame:
    """CPT red flags or indications of metrics that never look at secondary codes."""
    return (rules.filter((F.col("role") != "service") & (F.col("cls") == "CPT") & ~F.col("metric").isin(*SECONDARY_METRICS))
            .groupBy("role", "metric").agg(F.count(F.lit(1)).alias("n")))
