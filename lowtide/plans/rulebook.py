"""Rules of every mode, resolved to ICD-10 claim codes once.

Whatever the mode, a claim's role depends only on its ICD-10 code: rules mapped
forward are ICD-10 rules; claims mapped backward turn an ICD-9 rule into the
list of ICD-10 codes that map under it; HCC and CCS rules into the codes of
that level. So each mode boils down to a small tag table that is matched to
claims by equality on a code or on its stem, and claims are never mapped,
duplicated or re-joined per mode.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lowtide.functions.sizing import lookup
from lowtide.model import METRICS, Metric, Mode
from lowtide.operators import crosswalk as X

ALL_CODES = "all"


@dataclass(frozen=True)
class References:
    """Lookup tables a run needs; all small."""

    rules: dict[int, DataFrame]              # generation -> role, metric, cls, subcode, startWith
    demographics: DataFrame                  # key, agemin, agemax, gendercrit
    surgery: DataFrame                       # metric, code
    crosswalks: dict[str, DataFrame]         # name -> pairs with levels of both generations
    procedures: DataFrame | None
    levels: dict[tuple[str, int], DataFrame]


@dataclass(frozen=True)
class Rulebook:
    """Tag tables of a set of metrics and modes.

    ``claim_tags``    probe, stem, mode, metric, tag, and the metric's age and
                      gender limits; tag is dx | red | trim | proc
    ``code_facts``    probe (an ICD-10 code) -> crosswalks that map it, cells where it is
                      a plain old complaint
    ``service_tags``  probe, source, mode, metric, tag and limits; tag is
                      test | ref | refred | surgery
    """

    metrics: tuple[Metric, ...]
    modes: tuple[Mode, ...]
    claim_tags: DataFrame
    stem_lengths: tuple[int, ...]
    code_facts: DataFrame
    service_tags: DataFrame
    limits: dict[str, tuple[int, int, str]]
    cpt_flagged: frozenset[str]

    def subset(self, metrics: list[str], modes: list[str]) -> Rulebook:
        """The same rules for fewer cells; filters on lookups, nothing is resolved again."""
        wanted = tuple(m for m in self.metrics if m.name in metrics)
        how = tuple(m for m in self.modes if m.name in modes)
        cell = F.col("metric").isin(list(metrics)) & F.col("mode").isin([*modes, ALL_CODES])
        return Rulebook(wanted, how, self.claim_tags.filter(cell), self.stem_lengths, self.code_facts,
                        self.service_tags.filter(cell), {k: v for k, v in self.limits.items() if k in metrics},
                        self.cpt_flagged & frozenset(metrics))

    def has(self, attribute: str) -> bool:
        return any(getattr(m, attribute) for m in self.metrics)

    def per_metric(self, attribute: str) -> Column:
        """A setting of the row's metric as a column."""
        pairs = [(m.name, getattr(m, attribute)) for m in self.metrics if getattr(m, attribute) is not None]
        return choose(F.col("metric"), dict(pairs))

    def is_one(self, attribute: str) -> Column:
        names = [m.name for m in self.metrics if getattr(m, attribute)]
        return F.array_contains(F.array(*(F.lit(n) for n in names)), F.col("metric")) if names else F.lit(False)


def choose(column: Column, values: dict) -> Column:
    """Literal lookup in a constant map; null for other keys.

    A CASE would write one branch a key into every generated method that uses it,
    and methods that grow too large are never compiled.
    """
    if not values:
        return F.lit(None)
    return F.element_at(F.create_map(*(F.lit(x) for x in chain.from_iterable(values.items()))), column)


def scope_of(mode: Mode) -> str:
    """Which claims exist in a mode: all, or those its crosswalk maps."""
    return mode.crosswalk if mode.moves == "claims" else ALL_CODES


def _moving(modes: tuple[Mode, ...], moves: str) -> list[Mode]:
    return [m for m in modes if m.moves == moves]


def _names(modes: list[Mode]) -> list[str]:
    return [m.name for m in modes]


def _for_modes(df: DataFrame, modes: list[Mode]) -> DataFrame:
    """The table once per mode."""
    return df.withColumn("mode", F.explode(F.array(*[F.lit(m.name) for m in modes])))


def _crosswalk_of(refs: References, modes: list[Mode]) -> DataFrame:
    """The modes' crosswalks under one ``mode`` column."""
    return reduce(DataFrame.unionByName, [refs.crosswalks[m.crosswalk].withColumn("mode", F.lit(m.name)) for m in modes])


def rules_of(modes: tuple[Mode, ...], refs: References) -> DataFrame:
    """Rules as the modes apply them: mapped forward, as written, or native.

    All modes of a kind go through the same joins, told apart by ``mode``.
    """
    parts = []
    forward = _moving(modes, "rules")
    if forward:
        written = _for_modes(refs.rules[9], forward)
        parts.append(X.forward_rules(written, _crosswalk_of(refs, forward), None))
        coded = [m for m in forward if m.procedures]
        if coded and refs.procedures is not None:
            parts.append(X.forward_procedures(written.filter(F.col("mode").isin(_names(coded))), refs.procedures))
    for moves, generation in (("claims", 9), ("none", 10)):
        still = _moving(modes, moves)
        if still:
            parts.append(_for_modes(refs.rules[generation], still))
    return reduce(DataFrame.unionByName, parts).filter(F.length("subcode") > 0)


def _tagged(rules: DataFrame, needs_trim: list[str]) -> DataFrame:
    """The tags a rule gives to a matching diagnosis code."""
    tags = F.array_compact(F.array(
        F.when(F.col("role") == "indication", "dx"),
        F.when((F.col("role") == "redflag") & (F.col("cls") == "ICD"), "red"),
        F.when(F.col("metric").isin(needs_trim), "trim"),
        F.when((F.col("role") == "service") & (F.col("metric") == "feed") & ~F.col("startWith"), "proc"),
    ))
    return rules.withColumn("tag", F.explode(tags))


def _level_tagged(rules: DataFrame, needs_trim: list[str]) -> DataFrame:
    """The tags a rule gives to a matching HCC or CCS level."""
    red = (F.col("role") == "redflag") & F.col("cls").isin("HCC", "CCS")
    trim = F.col("metric").isin(needs_trim) & ~F.col("startWith")
    kinds = F.filter(F.array(F.struct(F.lit("red").alias("tag"), red.alias("on")),
                             F.struct(F.lit("trim").alias("tag"), trim.alias("on"))), lambda x: x["on"])
    return rules.withColumn("_k", F.explode(kinds)).withColumn("tag", F.col("_k.tag")).drop("_k")


def _by_level(rules: DataFrame, levels: DataFrame, code: str) -> DataFrame:
    """Codes whose level is named by a rule: red flags by class, trimming by any class.

    ``levels`` has the code, ``cls`` (HCC or CCS), ``subcode`` (the level) and
    possibly ``mode``.
    """
    by = ["mode"] if "mode" in levels.columns else []
    hits = rules.withColumnRenamed("cls", "_wanted").join(levels, [*by, "subcode"])
    return hits.filter((F.col("tag") == "trim") | (F.col("_wanted") == F.col("cls"))).select(
        "mode", "metric", "tag", F.col(code).alias("probe"), F.lit(False).alias("stem"))


def _level_cells(df: DataFrame, keys: list[str], hcc: str, ccs: str) -> DataFrame:
    """One row per code and level."""
    cells = F.array(F.struct(F.lit("HCC").alias("cls"), F.col(hcc).alias("subcode")),
                    F.struct(F.lit("CCS").alias("cls"), F.col(ccs).alias("subcode")))
    return df.select(*keys, F.inline(cells)).filter(F.col("subcode").isNotNull()).distinct()


def _claim_tags(modes: tuple[Mode, ...], rules: DataFrame, refs: References, needs_trim: list[str]) -> DataFrame:
    out = ["mode", "metric", "tag", "probe", "stem"]
    mode = F.col("mode")
    backward, forward = _moving(modes, "claims"), _moving(modes, "rules")
    tagged = _tagged(rules, needs_trim)
    levelled = _level_tagged(rules, needs_trim)
    stay = tagged.filter(~mode.isin(_names(backward))) if backward else tagged
    parts = [stay.select("mode", "metric", "tag", F.col("subcode").alias("probe"), F.col("startWith").alias("stem"))]
    if forward:
        cells = [refs.levels[(kind, 10)].select(F.col("subcode").alias("code"), F.lit(kind.upper()).alias("cls"),
                                                F.col(f"{kind}lev").alias("subcode")) for kind in ("hcc", "ccs")]
        levels = cells[0].unionByName(cells[1]).filter(F.col("subcode").isNotNull())
        parts.append(_by_level(levelled.filter(mode.isin(_names(forward))), levels, "code"))
    if backward:
        xwalk = _crosswalk_of(refs, backward).filter(F.col("ICD9_subcode").isNotNull())
        pairs = xwalk.select("mode", "ICD10_subcode", "ICD9_subcode").distinct()
        direct = X.match_codes(pairs, "ICD9_subcode", tagged.filter(mode.isin(_names(backward))))
        parts.append(direct.select("mode", "metric", "tag", F.col("ICD10_subcode").alias("probe"), F.lit(False).alias("stem")))
        levels = _level_cells(xwalk, ["mode", "ICD10_subcode"], "hcclev9", "ccslev9")
        parts.append(_by_level(levelled.filter(mode.isin(_names(backward))), levels, "ICD10_subcode"))
    return reduce(DataFrame.unionByName, parts).select(*out).distinct()


def _old_complaints(modes: tuple[Mode, ...], rules: DataFrame, refs: References) -> DataFrame:
    """(mode, metric, code): ICD-10 codes whose every reading is an indication.

    Whole codes only; a stem counts by its own text. A reading is a code with
    its levels: the code's own, or each code it maps back to.
    """
    mode = F.col("mode")
    rules = rules.filter((F.col("role") == "indication")
                         & F.col("metric").isin([m.name for m in METRICS.values() if m.cull_old_complaint]))
    backward, forward = _moving(modes, "claims"), _moving(modes, "rules")
    direct = rules.filter((F.col("cls") == "ICD") & ~mode.isin([*_names(backward), ""]))
    parts = [direct.select("mode", "metric", F.col("subcode").alias("code"))]
    readings = []
    if backward:
        readings.append(_crosswalk_of(refs, backward).filter(F.col("ICD9_subcode").isNotNull()).select(
            "mode", F.col("ICD10_subcode").alias("code"), F.col("ICD9_subcode").alias("icd"),
            F.col("hcclev9").alias("hcc"), F.col("ccslev9").alias("ccs")))
    if forward:
        hcc = refs.levels[("hcc", 10)].select(F.col("subcode").alias("code"), F.col("hcclev").alias("hcc"))
        ccs = refs.levels[("ccs", 10)].select(F.col("subcode").alias("code"), F.col("ccslev").alias("ccs"))
        both = _for_modes(hcc.join(ccs, "code", "full"), forward)
        readings.append(both.select("mode", "code", F.col("code").alias("icd"), "hcc", "ccs"))
    if readings:
        reading = reduce(DataFrame.unionByName, readings).distinct()
        cells = F.array(F.struct(F.lit("ICD").alias("cls"), F.col("icd").alias("subcode")),
                        F.struct(F.lit("HCC").alias("cls"), F.col("hcc").alias("subcode")),
                        F.struct(F.lit("CCS").alias("cls"), F.col("ccs").alias("subcode")))
        total = reading.groupBy("mode", "code").agg(F.count(F.lit(1)).alias("_all"))
        named = reading.select("mode", "code", "icd", "hcc", "ccs", F.inline(cells)).join(
            rules.select("mode", "metric", "cls", "subcode"), ["mode", "cls", "subcode"])
        hit = (named.select("mode", "metric", "code", "icd", "hcc", "ccs").distinct()
               .groupBy("mode", "metric", "code").agg(F.count(F.lit(1)).alias("_hit")))
        parts.append(hit.join(total, ["mode", "code"]).filter("_hit = _all").select("mode", "metric", "code"))
    return reduce(DataFrame.unionByName, parts).distinct()


def build(refs: References, metrics: list[str], modes: list[str]) -> Rulebook:
    """Resolve the rules of the wanted cells; small jobs over lookups only."""
    from lowtide.model import MODES

    wanted = tuple(METRICS[m] for m in metrics)
    how = tuple(MODES[m] for m in modes)
    names = [m.name for m in wanted]
    limits = limits_of(refs.demographics, names)
    rules = lookup(rules_of(how, refs).filter(F.col("metric").isin(names)))
    flagged = _checked(rules, wanted, how)
    trims = [m.name for m in wanted if m.name in flagged and not m.needs_claim]
    tags = _claim_tags(how, rules, refs, trims)
    if not any(m.dx_tied for m in wanted):
        tags = tags.filter(F.col("tag") != "dx")
    tags = tags.filter((F.col("tag") != "proc")
                       | F.col("mode").isin([m.name for m in how if m.procedures])).distinct()

    claim_tags = lookup(_with_limits(tags, limits))
    lengths = tuple(sorted(claim_tags.filter("stem").agg(F.collect_set(F.length("probe"))).first()[0]))

    mapped = [refs.crosswalks[m.crosswalk].filter(F.col("ICD9_subcode").isNotNull())
              .select(F.col("ICD10_subcode").alias("code"), F.lit(scope_of(m)).alias("scope"),
                      F.lit(None).cast("string").alias("cell")) for m in how if m.moves == "claims"]
    old = [_old_complaints(how, rules, refs).select(
        "code", F.lit(None).cast("string").alias("scope"), F.concat_ws("|", "mode", "metric").alias("cell"))]
    facts = reduce(DataFrame.unionByName, mapped + old).groupBy(F.col("code").alias("probe")).agg(
        F.collect_set("scope").alias("scopes"), F.collect_set("cell").alias("old_in"))

    return Rulebook(wanted, how, claim_tags, lengths, lookup(facts), lookup(_service_tags(rules, refs, limits, wanted)),
                    limits, flagged)


def limits_of(demographics: DataFrame, names: list[str]) -> dict[str, tuple[int, int, str]]:
    """Age and gender limits by metric; every metric needs exactly one rule."""
    rule = F.struct("key", "agemin", "agemax", "gendercrit")
    rows = demographics.filter(F.col("key").isin(names)).agg(F.collect_list(rule)).first()[0]
    keys = [r["key"] for r in rows]
    if wrong := sorted({n for n in names if keys.count(n) != 1}):
        raise ValueError(f"not exactly one demographic rule for {', '.join(wrong)}")
    return {r["key"]: (r["agemin"], r["agemax"], r["gendercrit"]) for r in rows}


def _checked(rules: DataFrame, wanted: tuple[Metric, ...], how: tuple[Mode, ...]) -> frozenset[str]:
    """Refuse rule sets the measures do not define; names of metrics with CPT red flags."""
    native = [m.name for m in how if m.moves == "none"]
    second = [m.name for m in wanted if m.secondary_window]
    red_cpt = (F.col("role") == "redflag") & (F.col("cls") == "CPT")
    problem = (
        F.when(F.col("mode").isin(native) & F.col("cls").isin("HCC", "CCS") & (F.col("role") != "service"),
               "native mode takes no HCC or CCS rules")
        .when(red_cpt & ~F.col("metric").isin(second), "CPT red flags need a metric that reads secondary codes")
        .when(F.col("startWith") & (F.col("cls") != "ICD"), "only ICD rules may be stems"))
    found = rules.select(problem.alias("problem"), F.when(red_cpt, F.col("metric")).alias("flagged")).distinct()
    rows = found.agg(F.collect_set(F.struct("problem", "flagged"))).first()[0]
    problems = sorted({r["problem"] for r in rows if r["problem"]})
    if problems:
        raise ValueError("; ".join(problems))
    return frozenset(r["flagged"] for r in rows if r["flagged"])


def _with_limits(tags: DataFrame, limits: dict[str, tuple[int, int, str]]) -> DataFrame:
    column = F.col("metric")
    return tags.withColumns({
        "agemin": choose(column, {k: v[0] for k, v in limits.items()}).cast("double"),
        "agemax": choose(column, {k: v[1] for k, v in limits.items()}).cast("double"),
        "wanted": choose(column, {k: v[2] for k, v in limits.items()}),
    })


def _service_tags(rules: DataFrame, refs: References, limits: dict, wanted: tuple[Metric, ...]) -> DataFrame:
    source = choose(F.col("metric"), {m.name: m.source for m in wanted})
    tests = rules.filter(F.col("role") == "service").select(
        F.col("subcode").alias("probe"), source.alias("source"), "mode", "metric", F.lit("test").alias("tag"))
    second = [m.name for m in wanted if m.secondary]
    reference = rules.filter((F.col("role") != "service") & F.col("cls").isin("CPT", "DRUG")
                             & F.col("metric").isin(second))
    refs_all = reference.select(F.col("subcode").alias("probe"), F.lit("service").alias("source"), "mode", "metric",
                                F.lit("ref").alias("tag"))
    refs_red = reference.filter((F.col("role") == "redflag") & (F.col("cls") == "CPT")).select(
        F.col("subcode").alias("probe"), F.lit("service").alias("source"), "mode", "metric", F.lit("refred").alias("tag"))
    operated = [m.name for m in wanted if m.admission == "surgery"]
    surgery = refs.surgery.filter(F.col("metric").isin(operated)).select(
        F.col("code").alias("probe"), F.lit("service").alias("source"), F.lit(ALL_CODES).alias("mode"), "metric", F.lit("surgery").alias("tag"))
    tags = tests.unionByName(refs_all).unionByName(refs_red).unionByName(surgery).distinct()
    limited = _with_limits(tags, limits)
    # secondary codes from the whole service table carry no age or gender limit
    free = F.col("tag").isin("ref", "refred") & F.col("metric").isin([m.name for m in wanted if m.secondary == "all"])
    return limited.withColumns({
        "agemin": F.when(~free, F.col("agemin")),
        "agemax": F.when(~free, F.col("agemax")),
        "wanted": F.when(~free, F.col("wanted")).otherwise("All"),
    })
