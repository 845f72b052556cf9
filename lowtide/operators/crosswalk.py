"""Operators on the ICD-9 / ICD-10 crosswalk and on rules mapped through it.

Joins between lookups carry no hint: Spark broadcasts by its own size check.
Only the join of claims with the crosswalk forces the side, behind a row bound.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lowtide.functions import codes
from lowtide.functions.sizing import lookup

SEED = 1873
DIAGNOSIS_TYPE = {9: "ICD_9_CM_CODE", 10: "ICD10CM_CODE"}
PROCEDURE_TYPE = {9: "ICD_9_PROC_CODE"}


def other(generation: int) -> int:
    if generation not in (9, 10):
        raise ValueError("generation must be 9 or 10")
    return 19 - generation


def active(xwalk: DataFrame) -> DataFrame:
    """Mappings that have not expired."""
    return xwalk.filter(F.col("MAPPING_EXPIRATION_DATE").isNull())


def simplify(xwalk: DataFrame, generation: int, kind: str) -> DataFrame:
    """Unexpired diagnosis (``d``) or procedure (``p``) rows of one generation."""
    types = {"d": DIAGNOSIS_TYPE, "p": PROCEDURE_TYPE}.get(kind)
    if types is None or generation not in types:
        raise ValueError(f"no {kind!r} rows for generation {generation}")
    return active(xwalk).filter(F.col(f"ICD{generation}_TYPE") == types[generation])


def mixed_relations(xwalk: DataFrame, generation: int) -> DataFrame:
    """Source codes with more than one relation type (none is expected)."""
    source = f"ICD{generation}_CODE"
    return (xwalk.groupBy(source).agg(F.countDistinct("RELATION_TYPE").alias("relation_types"))
            .filter("relation_types > 1"))


def unique_map(xwalk: DataFrame, generation: int, method: str, hcc: DataFrame | None = None) -> DataFrame:
    """One target per source code.

    ``upcode`` takes the target with the lowest level number (ties and sources
    without levels: the greatest code), ``downcode`` the highest level (else the
    least code), ``random`` a seeded hash order. Each is a per-source minimum
    over one ordering key, so it is combined map-side.
    """
    src, dst = f"ICD{generation}_subcode", f"ICD{other(generation)}_subcode"
    pairs = xwalk.select(src, dst).distinct()
    if method == "random":
        best = F.min_by(dst, F.struct(F.md5(F.concat_ws("|", F.lit(str(SEED)), F.col(src), F.col(dst))), F.col(dst)))
        return pairs.groupBy(src).agg(best.alias(dst))
    if method not in ("upcode", "downcode"):
        raise ValueError(f"unknown method {method!r}")
    if hcc is None:
        raise ValueError("level map required")
    right = hcc.select(F.col("subcode").alias("_code"), F.col("hcclev").cast("int").alias("_level"))
    rated = pairs.join(right, F.col(dst) == F.col("_code"), "left")
    if method == "upcode":
        # lowest level, then greatest code: negate the level so one maximum does both
        key = F.struct(F.col("_level").isNotNull(), -F.coalesce("_level", F.lit(0)), F.col(dst))
        return rated.groupBy(src).agg(F.max_by(dst, key).alias(dst))
    key = F.struct(F.col("_level").isNull(), -F.coalesce("_level", F.lit(0)), F.col(dst))
    return rated.groupBy(src).agg(F.min_by(dst, key).alias(dst))


def ambiguous(xwalk: DataFrame, generation: int) -> DataFrame:
    """Rows of sources with two or more targets, with the widest fan-out seen."""
    src, dst = f"ICD{generation}_CODE", f"ICD{other(generation)}_CODE"
    wide = xwalk.groupBy(src).agg(F.countDistinct(dst).alias("targets")).filter("targets >= 2")
    columns = ["RELATION_TYPE", src, dst, f"ICD{generation}_DESC", f"ICD{other(generation)}_DESC", "targets"]
    return xwalk.join(wide, src).select(*columns, wide.agg(F.max("targets")).scalar().alias("max_targets"))


def attach_both_levels(xwalk: DataFrame, maps: dict[tuple[str, int], DataFrame]) -> DataFrame:
    """Crosswalk with hcc and ccs of both generations (left joins, may fan out)."""
    out = xwalk
    for (kind, generation), levels in maps.items():
        right = levels.select(F.col("subcode").alias("_code"), F.col(f"{kind}lev").alias(f"{kind}lev{generation}"))
        out = out.join(right, F.col(f"ICD{generation}_subcode") == F.col("_code"), "left").drop("_code")
    return out


def upper_placeholders(xwalk: DataFrame) -> DataFrame:
    return xwalk.withColumn("ICD10_subcode", codes.upper_x(F.col("ICD10_subcode")))


# --- prefixes --------------------------------------------------------------

def with_prefixes(df: DataFrame, code: str, into: str = "probe") -> DataFrame:
    """Every leading part of a code, one row each; use on code lists, not on events."""
    cut = F.transform(F.sequence(F.lit(1), F.length(code)), lambda n: F.substring(F.col(code), F.lit(1), n))
    return df.filter(F.length(code) > 0).withColumn(into, F.explode(cut))


def match_codes(universe: DataFrame, code: str, rules: DataFrame) -> DataFrame:
    """Rules against a list of codes: equality, or stem at the head of the code.

    Codes are cut into leading parts and joined by equality, which plans as a
    hash join; ``startswith`` as a join condition would be a nested loop.
    """
    cut = with_prefixes(universe, code, "subcode")
    hits = cut.join(rules, [*_shared(universe, rules), "subcode"])
    return hits.filter(F.col("startWith") | (F.col("subcode") == F.col(code)))


# --- rules forward ---------------------------------------------------------

def _shared(left: DataFrame, right: DataFrame) -> list[str]:
    """Both sides may carry a ``mode``; then rules only meet their mode's rows."""
    return ["mode"] if "mode" in left.columns and "mode" in right.columns else []


def _retarget(rules: DataFrame, pairs: DataFrame, source: str, target: str) -> DataFrame:
    """Replace ``subcode`` by its targets; rules without one are dropped."""
    by = _shared(rules, pairs)
    mapping = pairs.select(*by, F.col(source).alias("subcode"), F.col(target).alias("_dst")).filter(
        F.col("subcode").isNotNull() & F.col("_dst").isNotNull()).distinct()
    return (rules.join(mapping, [*by, "subcode"]).withColumn("subcode", F.col("_dst")).select(*rules.columns))


def forward_exact(rules: DataFrame, xwalk: DataFrame) -> DataFrame:
    """Whole ICD-9 codes to all their ICD-10 targets."""
    return _retarget(rules.filter((F.col("cls") == "ICD") & ~F.col("startWith")), xwalk,
                     "ICD9_subcode", "ICD10_subcode").distinct()


def forward_stems(rules: DataFrame, xwalk: DataFrame) -> DataFrame:
    """ICD-9 stems: targets of every code under the stem, themselves stems again."""
    stems = rules.filter((F.col("cls") == "ICD") & F.col("startWith"))
    by = _shared(rules, xwalk)
    cut = with_prefixes(xwalk.select(*by, "ICD9_subcode", "ICD10_subcode").distinct(), "ICD9_subcode", "_part")
    return _retarget(stems, cut, "_part", "ICD10_subcode").distinct()


def forward_levels(rules: DataFrame, xwalk: DataFrame) -> DataFrame:
    """HCC and CCS levels of the old generation to those of the new one."""
    parts = []
    for cls in ("HCC", "CCS"):
        low = cls.lower()
        parts.append(_retarget(rules.filter(F.col("cls") == cls), xwalk, f"{low}lev9", f"{low}lev10"))
    return parts[0].unionByName(parts[1]).distinct()


def is_procedure_rule():
    """Feeding-tube procedure codes carry a ``_p`` suffix in the ICD-9 rules."""
    return (F.col("cls") == "ICD") & (F.col("role") == "service") & (F.col("metric") == "feed") & \
        F.col("subcode").endswith("_p")


def forward_procedures(rules: DataFrame, procedures: DataFrame) -> DataFrame:
    """``_p`` rules to procedure targets; a code without target keeps its own."""
    bare = rules.filter(is_procedure_rule()).withColumn("subcode", F.regexp_replace("subcode", "_p$", ""))
    mapping = procedures.select(F.col("ICD9_subcode").alias("_src"), F.col("ICD10_subcode").alias("_dst")).distinct()
    return (bare.join(mapping, F.col("subcode") == F.col("_src"), "left")
            .withColumn("subcode", F.coalesce("_dst", "subcode")).select(*rules.columns).distinct())


def forward_rules(rules: DataFrame, xwalk: DataFrame, procedures: DataFrame | None) -> DataFrame:
    """All rules on the ICD-10 basis: mapped ICD, HCC and CCS plus the rest as is."""
    plain = rules.filter(~is_procedure_rule())
    parts = [forward_exact(plain, xwalk), forward_stems(plain, xwalk), forward_levels(plain, xwalk),
             plain.filter(~F.col("cls").isin("ICD", "HCC", "CCS"))]
    if procedures is not None:
        parts.append(forward_procedures(rules, procedures))
    return reduce(DataFrame.unionByName, parts).filter(F.length("subcode") > 0)


# --- claims ----------------------------------------------------------------

def backward_claims(claims: DataFrame, xwalk: DataFrame) -> DataFrame:
    """Claims re-expressed on the ICD-9 basis; unmapped ones are dropped."""
    right = lookup(xwalk.select(F.col("ICD10_subcode").alias("_ten"), F.col("ICD9_subcode").alias("_nine"),
                                F.col("hcclev9").alias("_hcc"), F.col("ccslev9").alias("_ccs"))
                   .filter(F.col("_nine").isNotNull()))
    return (claims.join(right, F.col("ICD10_subcode") == F.col("_ten"))
            .withColumns({"ICD9_subcode": F.col("_nine"), "hcclev": F.col("_hcc"), "ccslev": F.col("_ccs")})
            .drop("_ten", "_nine", "_hcc", "_ccs"))


def native_claims(claims: DataFrame) -> DataFrame:
    """No mapping: class levels are neutralised."""
    nothing = F.lit(None).cast("string")
    return claims.withColumn("hcclev", nothing).withColumn("ccslev", nothing)
