"""The metrics as one long plan.

All requested (mode, metric) cells are computed together: claims and services
are matched to tags once, reduced to facts keyed by (mode, metric, patient),
and the candidate tests of all cells pass through one chain of joins. Rows of
a metric skip the steps it does not take.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lowtide.functions import dates
from lowtide.functions.bitmaps import filtered, key_set
from lowtide.model import RESULT_COLUMNS, Metric, Study
from lowtide.operators.cohort import in_limits
from lowtide.operators.history import best_admission, kept_surgeries, recently_admitted
from lowtide.operators.intervals import exists_within, prior_summary
from lowtide.operators.repeat import repeat_scans
from lowtide.operators.skew import Deal, deal, join_facts
from lowtide.plans.rulebook import ALL_CODES, Rulebook, choose, scope_of
from lowtide.sources.sinks import stage_some

#: the patient comes first: joins and groupings sort by the head of the first key, and modes and metrics are few
CELL = ["MRN", "metric", "mode"]


@dataclass(frozen=True)
class Inputs:
    """Normalised, date-bounded tables.

    claims      MRN, EVT_DATE, ICD10_subcode, AgeAtTest, GENDER
    services    MRN, ENC_ID, CODE, EVT_DATE, AgeAtTest, GENDER
    drugs       as services, without encounter
    scans       MRN, ENC_ID, EVT_DATE, AgeAtTest, GENDER
    admissions  MRN, ADM_DT, DIS_DT
    """

    claims: DataFrame
    services: DataFrame
    drugs: DataFrame
    scans: DataFrame
    admissions: DataFrame
    study: Study


Stage = Callable[[DataFrame, str], DataFrame]
#: (name of the step, its rows, which of them passed it) -> the rows to go on with
Seen = Callable[[str, DataFrame, Column], DataFrame]


def claim_hits(claims: DataFrame, book: Rulebook) -> DataFrame:
    """Claims under a rule: (mode, metric, tag, MRN, at, code), one broadcast join.

    Each claim is probed by its code and by its head at the stem lengths that
    occur in the rules.
    """
    code = F.col("ICD10_subcode")
    probes = [code] + [F.left(code, F.lit(n)) for n in book.stem_lengths]
    # heads of different length only meet for codes shorter than a stem
    cut = claims.select("MRN", "EVT_DATE", "AgeAtTest", "GENDER", "ICD10_subcode",
                        F.explode(F.array_distinct(F.array(*probes))).alias("probe"))
    return (cut.join(book.claim_tags, "probe")
            .filter(F.col("stem") | (F.col("probe") == F.col("ICD10_subcode")))
            .filter(in_limits(F.col("AgeAtTest"), F.col("GENDER"), F.col("agemin"), F.col("agemax"), F.col("wanted")))
            .select(*CELL, "tag", F.col("EVT_DATE").alias("at"), "ICD10_subcode"))


def service_hits(events: DataFrame, book: Rulebook, source: str) -> DataFrame:
    """Services under a rule: tests, secondary codes, surgeries."""
    tags = book.service_tags.filter(F.col("source") == source)
    return (events.join(tags, F.col("CODE") == F.col("probe"))
            .filter(in_limits(F.col("AgeAtTest"), F.col("GENDER"), F.col("agemin"), F.col("agemax"), F.col("wanted")))
            .select(*CELL, "tag", "ENC_ID", F.col("CODE").alias("TEST_CODE"), F.col("EVT_DATE").alias("at"), "AgeAtTest"))


def _coded_claims(claims: DataFrame, book: Rulebook) -> DataFrame:
    """Claims with the crosswalks that map their code and the cells they are old in."""
    nothing = F.array().cast("array<string>")
    return (claims.join(book.code_facts, F.col("ICD10_subcode") == F.col("probe"), "left")
            .filter(F.col("ICD10_subcode").isNotNull())
            .withColumn("scopes", F.array_append(F.coalesce("scopes", nothing), F.lit(ALL_CODES)))
            .withColumn("old_in", F.coalesce("old_in", nothing)))


def _metric_limits(book: Rulebook, name: str) -> Column:
    low, high, gender = book.limits[name]
    return in_limits(F.col("AgeAtTest"), F.col("GENDER"), F.lit(low), F.lit(high), F.lit(gender))


def _first_name(metric: str, scope: str) -> str:
    return f"any_{metric}_{scope}"


def first_claims(claims: DataFrame, book: Rulebook) -> DataFrame | None:
    """One row per patient: time of the first claim per metric limits and scope,
    and of the first one that is not just an old complaint."""
    measures = []
    scopes = sorted({scope_of(m) for m in book.modes})
    for metric in book.metrics:
        if metric.needs_claim:
            for scope in scopes:
                on = _metric_limits(book, metric.name) & F.array_contains("scopes", scope)
                measures.append(F.min(F.when(on, F.col("EVT_DATE"))).alias(_first_name(metric.name, scope)))
        if metric.cull_old_complaint:
            for mode in book.modes:
                on = (_metric_limits(book, metric.name) & F.array_contains("scopes", scope_of(mode))
                      & ~F.array_contains("old_in", f"{mode.name}|{metric.name}"))
                measures.append(F.min(F.when(on, F.col("EVT_DATE"))).alias(f"new_{metric.name}_{mode.name}"))
    if not measures:
        return None
    return _coded_claims(claims, book).groupBy("MRN").agg(*measures)


def _pick_first(book: Rulebook, names: list[str]) -> tuple[Column, Column]:
    """The row's own first-claim times out of the patient's ``_times``, which hold the columns ``names`` in order.

    A place is the metric's first one and the scope's (or mode's) among the metric's, so the lookup is as
    short for 55 cells as for one; other metrics have no place and get null.
    """
    scopes = sorted({scope_of(m) for m in book.modes})
    claimed = {m.name: names.index(_first_name(m.name, scopes[0])) for m in book.metrics if m.needs_claim}
    culled = {m.name: names.index(f"new_{m.name}_{book.modes[0].name}") for m in book.metrics if m.cull_old_complaint}
    nth_scope = choose(F.col("mode"), {m.name: scopes.index(scope_of(m)) for m in book.modes})
    nth_mode = choose(F.col("mode"), {m.name: k for k, m in enumerate(book.modes)})
    nothing = F.lit(None).cast("timestamp")
    first = F.get("_times", choose(F.col("metric"), claimed) + nth_scope) if claimed else nothing
    new = F.get("_times", choose(F.col("metric"), culled) + nth_mode) if culled else nothing
    return first, new


def claim_times(claims: DataFrame, book: Rulebook, metrics: list[Metric]) -> DataFrame:
    """(scope, metric, MRN, at) of all claims inside the metrics' limits."""
    scopes = sorted({scope_of(m) for m in book.modes})
    cells = F.array_compact(F.array(*[
        F.when(_metric_limits(book, m.name) & F.array_contains("scopes", s),
               F.struct(F.lit(s).alias("scope"), F.lit(m.name).alias("metric")))
        for m in metrics for s in scopes]))
    return _coded_claims(claims, book).select("MRN", F.col("EVT_DATE").alias("at"), F.inline(cells))


def _candidates(hits: DataFrame, inputs: Inputs, book: Rulebook, by: Deal) -> DataFrame:
    """Tests of all cells, one row per (cell, code, time): repeats carry no information."""
    start = F.lit(inputs.study.start).cast("timestamp")
    repeat = book.is_one("repeat_scan")
    # earlier scans only set the report start; every other metric reads the study window
    tests = hits.filter((F.col("at") >= start) | repeat)
    keys = [*CELL, "TEST_CODE", "TEST_DATE"]
    tests = tests.withColumnRenamed("at", "TEST_DATE")
    if not book.has("repeat_scan"):
        return tests.groupBy(*keys).agg(F.min(F.struct("ENC_ID", "AgeAtTest")).alias("_p")).select(
            *keys, "_p.ENC_ID", "_p.AgeAtTest")
    (scored,) = (m for m in book.metrics if m.repeat_scan)
    scans = repeat_scans(inputs.scans.filter(_metric_limits(book, scored.name)), scored.window)
    encounters = scans.select("ENC_ID").distinct().withColumn("_repeat", F.lit(True))
    tests = join_facts(tests, encounters, ["ENC_ID"], "left")
    last = scans.groupBy("MRN").agg(F.max("EVT_DATE").alias("last_repeat"))
    reduced = tests.groupBy(*keys).agg(
        F.min(F.struct("ENC_ID", "AgeAtTest")).alias("_p"),
        F.min(F.when(F.col("_repeat"), F.col("ENC_ID"))).alias("repeat_enc"))
    return join_facts(reduced.select(*keys, "_p.ENC_ID", "_p.AgeAtTest", "repeat_enc"), last, ["MRN"], "left", by)


def _patient_facts(claim_hit: DataFrame | None, service_hit: DataFrame | None) -> DataFrame | None:
    """Per cell and patient: first indication and first secondary code."""
    parts = []
    if claim_hit is not None:
        parts.append(claim_hit.filter(F.col("tag") == "dx").select(*CELL, "at", F.lit("dx").alias("kind")))
    if service_hit is not None:
        parts.append(service_hit.filter(F.col("tag") == "ref").select(*CELL, "at", F.lit("ref").alias("kind")))
    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts).groupBy(*CELL).agg(
        F.min(F.when(F.col("kind") == "dx", F.col("at"))).alias("first_dx"),
        F.min(F.when(F.col("kind") == "ref", F.col("at"))).alias("first_ref"))


def _with_history(tests: DataFrame, firsts: DataFrame | None, facts: DataFrame | None, book: Rulebook, by: Deal) -> DataFrame:
    """Tests with the first indication, claim, new complaint and secondary code of the patient."""
    nothing = F.lit(None).cast("timestamp")
    if facts is not None:
        tests = join_facts(tests, facts, CELL, "left", by)
    else:
        tests = tests.withColumn("first_dx", nothing).withColumn("first_ref", nothing)
    if firsts is not None:
        names = [c for c in firsts.columns if c != "MRN"]
        first, new = _pick_first(book, names)
        times = firsts.select("MRN", F.array(*names).alias("_times"))
        return join_facts(tests, times, ["MRN"], "left", by).withColumns({"first_any": first, "first_new": new}).drop("_times")
    return tests.withColumn("first_any", nothing).withColumn("first_new", nothing)


def _cohort_ok(book: Rulebook) -> Column:
    """The patient has an indication, and before the test where that matters."""
    dated = ~book.is_one("after_dx") | (F.col("first_dx") <= F.col("TEST_DATE"))
    return F.coalesce((~book.is_one("dx_tied") | F.col("first_dx").isNotNull()) & dated, F.lit(False))


def _history_ok(book: Rulebook) -> Column:
    """An earlier claim where one is needed; secondary codes not all in the future.

    A patient whose reference services all come later is dropped, one with none is kept.
    """
    at = F.col("TEST_DATE")
    claimed = ~book.is_one("needs_claim") | (F.col("first_any") <= at)
    second = ~book.is_one("secondary") | F.col("first_ref").isNull() | (F.col("first_ref") <= at)
    return F.coalesce(claimed & second, F.lit(False))


def _admissions(tests: DataFrame, surgery_hit: DataFrame | None, inputs: Inputs, book: Rulebook, stage: Stage) -> DataFrame:
    """Latest prior admission and the recent-admission flag; surgery window."""
    day, ts = F.lit(None).cast("date"), F.lit(None).cast("timestamp")
    tests = tests.withColumns({"ADM_DT_a": day, "SURG_DATE": ts, "adms_flag": F.lit(False)})
    columns = tests.columns
    parts = [tests.filter(F.col("metric").isin([m.name for m in book.metrics if not m.admission]))]
    by_test = [m.name for m in book.metrics if m.admission == "test"]
    if by_test:
        rows = best_admission(tests.filter(F.col("metric").isin(by_test)).drop("ADM_DT_a"), inputs.admissions)
        window = book.per_metric("window")
        rows = rows.withColumn("adms_flag", recently_admitted(
            F.to_date("TEST_DATE"), F.col("TEST_DATE"), F.col("ADM_DT_a"), F.col("DIS_DT"), window))
        parts.append(rows.select(*columns))
    by_surgery = [m.name for m in book.metrics if m.admission == "surgery"]
    if by_surgery:
        window = book.per_metric("window")
        surgeries = kept_surgeries(surgery_hit.select("metric", "MRN", F.col("at").alias("SURG_DATE")), inputs.admissions)
        surgeries = stage(surgeries, "surgeries")
        rows = tests.filter(F.col("metric").isin(by_surgery)).drop("ADM_DT_a", "SURG_DATE")
        rows = rows.withColumn("_until", F.col("TEST_DATE") + F.make_dt_interval(window))
        best = F.struct("SURG_DATE", "ADM_DT_a", "DIS_DT")
        rows = prior_summary(rows, surgeries, ["MRN", "metric"], {"_s": ("max", best)}, at="_until", event_at="SURG_DATE")
        rows = rows.filter(F.col("_s.SURG_DATE") > F.col("TEST_DATE")).select("*", "_s.*").drop("_s")
        rows = rows.withColumn("adms_flag", recently_admitted(
            F.to_date("SURG_DATE"), F.col("TEST_DATE"), F.col("ADM_DT_a"), F.col("DIS_DT"), window))
        parts.append(rows.select(*columns))
    return reduce(DataFrame.unionByName, parts)


def _after_report_start(tests: DataFrame, inputs: Inputs, book: Rulebook) -> DataFrame:
    """Repeat-scan flag: a repeat scan at or after the first scored test, and the encounter belongs to one."""
    start = F.lit(inputs.study.start).cast("timestamp")
    if not book.has("repeat_scan"):
        return tests.withColumn("repeat_enc", F.lit(None).cast("string")).withColumn("is_repeat", F.lit(False))
    repeat = book.is_one("repeat_scan")
    # one row per mode, so at most len(modes) rows
    begin = tests.filter(repeat).groupBy("mode").agg(F.min("TEST_DATE").alias("report_start"))
    tests = tests.filter(F.col("TEST_DATE") >= start).join(F.broadcast(begin), "mode", "left")
    return tests.withColumn("is_repeat", F.coalesce(
        (F.col("last_repeat") >= F.col("report_start")) & F.col("repeat_enc").isNotNull(), F.lit(False))
    ).drop("last_repeat", "report_start")


def _not_just_admitted(book: Rulebook) -> Column:
    """No admission shortly before the test, where the test is the index."""
    by_test = F.col("metric").isin([m.name for m in book.metrics if m.admission == "test"])
    return ~(by_test & F.col("adms_flag"))


def _is_scored(book: Rulebook) -> Column:
    """The encounter belongs to a repeat scan, where those are counted."""
    return ~book.is_one("repeat_scan") | F.col("is_repeat")


def _is_numerator(book: Rulebook) -> Column:
    """Unflagged and not culled, without an admission shortly before the surgery."""
    by_surgery = F.col("metric").isin([m.name for m in book.metrics if m.admission == "surgery"])
    return F.col("in_numerator") & ~(by_surgery & F.col("adms_flag"))


def _flagged(tests: DataFrame, claim_hit: DataFrame, service_hit: DataFrame | None, inputs: Inputs,
             book: Rulebook, stage: Stage, by: Deal) -> DataFrame:
    """Red-flag marks per row, spread to all rows of the patient in the cell."""
    lookback = book.per_metric("lookback")
    red = claim_hit.filter(F.col("tag") == "red").select(*CELL, "at")
    tests = exists_within(tests, red, CELL, lookback, "_red", by=by)
    flagged = [m for m in book.metrics if m.name in book.cpt_flagged and m.secondary_window]
    marked = F.col("_red")
    if flagged:
        # A secondary code only counts on a row that also has a claim within
        # lookback: any claim, or (left-joined metrics) one under a rule.
        cell = ["MRN", "metric", "scope"]
        modes = {m.name: scope_of(m) for m in book.modes}
        trimmed = [m.name for m in flagged if not m.needs_claim]
        tests = tests.withColumn("scope", F.when(F.col("metric").isin(trimmed), F.col("mode"))
                                 .otherwise(choose(F.col("mode"), modes)))
        sources = []
        whole = [m for m in flagged if m.needs_claim]
        if whole:
            sources.append(claim_times(inputs.claims, book, whole).select(*cell, "at"))
        if trimmed:
            sources.append(claim_hit.filter(F.col("tag") == "trim").select(F.col("mode").alias("scope"), "metric", "MRN", "at"))
        tests = exists_within(tests, reduce(DataFrame.unionByName, sources), cell, lookback, "_claim", by=by).drop("scope")
        second = service_hit.filter(F.col("tag") == "refred").select(*CELL, "at")
        tests = exists_within(tests, second, CELL, F.coalesce(book.per_metric("secondary_window"), F.lit(1)), "_second", by=by)
        marked = marked | (F.col("_claim") & F.col("_second"))
    can_score = _not_just_admitted(book) & _is_scored(book)
    # the marked patients are a set of their own, so no patient's rows must meet in one task
    tests = stage(tests.withColumn("_scored", can_score).withColumn("_marked", F.coalesce(can_score & marked, F.lit(False)))
                  .drop("_red", "_claim", "_second"), "marked")
    out = tests.filter("_marked").select(*CELL).distinct().withColumn("_out", F.lit(True))
    return (join_facts(tests, out, CELL, "left", by)
            .withColumn("in_numerator", F.col("_scored") & F.col("_out").isNull())
            .drop("_marked", "_scored", "_out"))


def _culled(tests: DataFrame, inputs: Inputs, book: Rulebook, by: Deal) -> DataFrame:
    """Old complaints leave the numerator: keep a test with any claim younger than
    the window, or with an earlier claim that is not an indication."""
    metrics = [m for m in book.metrics if m.cull_old_complaint]
    if not metrics:
        return tests
    scoped = tests.withColumn("scope", choose(F.col("mode"), {m.name: scope_of(m) for m in book.modes}))
    recent = claim_times(inputs.claims, book, metrics)
    window = F.coalesce(book.per_metric("window"), F.lit(1))
    scoped = exists_within(scoped, recent, ["MRN", "metric", "scope"], window, "_recent", open_end=True, by=by).drop("scope")
    keep = F.col("_recent") | F.coalesce(F.col("first_new") <= F.col("TEST_DATE"), F.lit(False))
    return scoped.withColumn("in_numerator", F.col("in_numerator") & (~book.is_one("cull_old_complaint") | keep)).drop("_recent")


_PICK = ["TEST_DATE", "ENC_ID", "AgeAtTest", "CLAIM_DATE", "ADM_DT_a", "SURG_DATE"]


def _service_terms(tests: DataFrame, book: Rulebook) -> DataFrame:
    """Numerator rows of all metrics and denominator rows of the service-level ones."""
    terms = F.array_compact(F.array(F.when(_is_numerator(book), "numerator"), F.when(~book.is_one("monthly"), "denominator")))
    rows = tests.withColumn("term", F.explode(terms)).withColumns({
        "TEST_DATE_a": F.to_date("TEST_DATE"),
        "CLAIM_DATE": F.col("first_any"),
        "ENC_ID": F.when((F.col("term") == "numerator") & book.is_one("repeat_scan"), F.col("repeat_enc"))
        .otherwise(F.col("ENC_ID")),
    })
    keys = [*CELL, "term", "TEST_DATE_a", "TEST_CODE"]
    best = rows.groupBy(*keys).agg(F.min(F.struct(*_PICK)).alias("_p"))
    return best.select(*keys, *[F.col(f"_p.{c}").alias(c) for c in _PICK],
                       dates.month_label(F.col("TEST_DATE_a")).alias("TEST_DATE_month"),
                       F.lit(None).cast("string").alias("based_on")).select(*RESULT_COLUMNS)


def _visit_table(events: DataFrame, inputs: Inputs) -> DataFrame:
    """Window services reduced to one row per patient and instant."""
    start = F.lit(inputs.study.start).cast("timestamp")
    return (events.filter(F.col("EVT_DATE") >= start)
            .groupBy("MRN", F.col("EVT_DATE").alias("TEST_DATE"), "AgeAtTest", F.col("GENDER").alias("sex"))
            .agg(F.min(F.struct("CODE", "ENC_ID")).alias("_p")))


def _monthly_denominator(inputs: Inputs, facts: DataFrame, book: Rulebook) -> DataFrame:
    """First cohort service of each patient-month."""
    parts = []
    for source, events in (("service", inputs.services), ("drug", inputs.drugs)):
        metrics = [m for m in book.metrics if m.monthly and m.source == source]
        if not metrics:
            continue
        names = [m.name for m in metrics]
        cohort = facts.filter(F.col("metric").isin(names) & F.col("first_dx").isNotNull()).select(*CELL, "first_dx")
        own = {k: v for k, v in book.limits.items() if k in names}
        column = F.col("metric")
        rows = join_facts(_visit_table(events, inputs), cohort, ["MRN"]).filter(
            in_limits(F.col("AgeAtTest"), F.col("sex"), choose(column, {k: v[0] for k, v in own.items()}),
                      choose(column, {k: v[1] for k, v in own.items()}), choose(column, {k: v[2] for k, v in own.items()}))
            & (~book.is_one("after_dx") | (F.col("TEST_DATE") >= F.col("first_dx"))))
        parts.append(rows.groupBy(*CELL, F.trunc("TEST_DATE", "month").alias("_m"))
                     .agg(F.min(F.struct("TEST_DATE", "_p", "AgeAtTest")).alias("_v")))
    rows = reduce(DataFrame.unionByName, parts)
    ts, day = F.lit(None).cast("timestamp"), F.lit(None).cast("date")
    return rows.select(
        *CELL, F.lit("denominator").alias("term"), F.col("_v._p.ENC_ID").alias("ENC_ID"),
        F.col("_v._p.CODE").alias("TEST_CODE"), F.col("_v.TEST_DATE").alias("TEST_DATE"),
        F.to_date("_v.TEST_DATE").alias("TEST_DATE_a"), dates.month_label(F.col("_v.TEST_DATE")).alias("TEST_DATE_month"),
        F.col("_v.AgeAtTest").alias("AgeAtTest"), ts.alias("CLAIM_DATE"), day.alias("ADM_DT_a"), ts.alias("SURG_DATE"),
        F.lit(None).cast("string").alias("based_on")).select(*RESULT_COLUMNS)


def _feeding_tubes(numerator: DataFrame, denominator: DataFrame, claim_hit: DataFrame, inputs: Inputs,
                   book: Rulebook) -> DataFrame:
    """Procedure-coded evidence first (with a procedure crosswalk), else service codes."""
    by_code = numerator.withColumn("based_on", F.lit("CPT"))
    if not any(m.procedures for m in book.modes):
        return by_code
    evidence = claim_hit.filter((F.col("tag") == "proc") & (F.col("metric") == "feed"))
    evidence = evidence.groupBy(*CELL, "at", "ICD10_subcode").agg(F.lit(1).alias("_n"))
    first = denominator.filter(F.col("metric") == "feed").groupBy(*CELL).agg(
        F.min(F.struct("TEST_DATE", "TEST_CODE", "ENC_ID", "AgeAtTest")).alias("_v"))
    start = F.lit(inputs.study.start).cast("timestamp")
    coded = evidence.filter(F.col("at") >= start).join(first, CELL).select(
        *CELL, F.lit("numerator").alias("term"), "_v.*", F.col("at").alias("CLAIM_DATE"))
    coded = coded.withColumns({
        "TEST_DATE_a": F.to_date("TEST_DATE"), "TEST_DATE_month": dates.month_label(F.col("TEST_DATE")),
        "ADM_DT_a": F.lit(None).cast("date"), "SURG_DATE": F.lit(None).cast("timestamp"), "based_on": F.lit("ICD"),
    }).select(*RESULT_COLUMNS)
    return by_code.join(evidence.select(*CELL).distinct(), CELL, "left_anti").unionByName(coded)


def _go_on(step: str, rows: DataFrame, passed: Column) -> DataFrame:
    return rows


#: Steps a test passes on its way into the numerator, in this order; see ``evaluate``.
STEPS = ("1 tests", "2 cohort", "3 history", "4 admission", "5 scored", "6 unflagged", "7 numerator")


#: what every metric reads several times: the claims and services under a rule, and the set of tested patients
HITS = ("claim_hits", "service_hits", "drug_hits", "tested")


def evaluate(inputs: Inputs, book: Rulebook, stage: Stage = stage_some(*HITS, "marked"), seen: Seen = _go_on) -> DataFrame:
    """Numerators and denominators of every cell of the rulebook, in one long result.

    ``stage`` may write an intermediate table and read it back, which cuts the
    plan and lets its readers share one pass over claims and services. ``seen``
    is shown the rows of every one of ``STEPS``, with the condition that says
    which of them passed it, and gives back the rows to go on with.
    """
    claim_hit = stage(claim_hits(inputs.claims, book), "claim_hits")
    sources = {m.source for m in book.metrics}
    reads_services = "service" in sources or book.has("secondary") or book.has("admission")
    service_hit = stage(service_hits(inputs.services, book, "service"), "service_hits") if reads_services else None
    hits = [service_hit] if "service" in sources else []
    if "drug" in sources:
        hits.append(stage(service_hits(inputs.drugs, book, "drug"), "drug_hits"))
    everyone, hits = F.lit(True), reduce(DataFrame.unionByName, hits).filter(F.col("tag") == "test")
    by = deal(hits, ["MRN"])
    # claims of patients without a test decide nothing but monthly denominators
    tested = dataclasses.replace(inputs, claims=filtered(inputs.claims, "MRN", stage(key_set(hits, "MRN"), "tested")))
    tests, cohort, history, admission, scored, unflagged, numerator = STEPS
    rows = seen(tests, _candidates(hits, inputs, book, by), everyone)

    firsts = first_claims(tested.claims, book)
    facts = _patient_facts(claim_hit if book.has("dx_tied") else None, service_hit if book.has("secondary") else None)
    if facts is not None:
        facts = stage(facts, "patient_facts")
    rows = seen(cohort, _with_history(rows, firsts, facts, book, by), _cohort_ok(book)).filter(_cohort_ok(book) & _history_ok(book))
    # several branches read the candidates: admissions, report start, red flags
    rows = seen(history, stage(rows, "candidates"), everyone)
    if book.has("admission"):
        surgeries = service_hit.filter(F.col("tag") == "surgery") if service_hit is not None else None
        rows = _admissions(rows, surgeries, inputs, book, stage)
    else:
        rows = rows.withColumns({"ADM_DT_a": F.lit(None).cast("date"), "SURG_DATE": F.lit(None).cast("timestamp"),
                                 "adms_flag": F.lit(False)})
    rows = stage(_after_report_start(rows, inputs, book), "qualified")
    rows = seen(scored, seen(admission, rows, _not_just_admitted(book)), _not_just_admitted(book) & _is_scored(book))
    rows = seen(unflagged, _flagged(rows, claim_hit, service_hit, tested, book, stage, by), F.col("in_numerator"))
    rows = seen(numerator, _culled(rows, tested, book, by), _is_numerator(book))
    result = stage(_service_terms(rows, book), "service_terms")

    monthly = [m.name for m in book.metrics if m.monthly]
    if monthly:
        denominator = stage(_monthly_denominator(inputs, facts, book), "monthly")
        if "feed" in monthly:
            feed = F.col("metric") == "feed"
            result = result.filter(~feed).unionByName(
                _feeding_tubes(result.filter(feed), denominator, claim_hit, inputs, book))
        result = result.unionByName(denominator)
    end = F.lit(inputs.study.end)
    return result.filter((F.col("TEST_DATE_a") >= F.lit(inputs.study.start)) & (F.col("TEST_DATE_a") < end))
