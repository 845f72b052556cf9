"""Literal tables: boundary days, stems, repeats, nulls, empty denominators."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lowtide import model as M
from lowtide.functions import codes, dates
from lowtide.functions.sizing import lookup
from lowtide.operators import cohort, cost, crosswalk as X, evaluate as E, history as H, intervals as I
from lowtide.operators import normalize as N, numerator as U, quality as Q, report as R, sample as P
from lowtide.operators.repeat import repeat_scans
from lowtide.plans import rulebook
from lowtide.sources import builds, readers
from support import at, rows_of

LOOK = 365


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def services_of(spark, rows):
    return frame(spark, "MRN string, TEST_CODE string, TEST_DATE timestamp", [(m, "t", at(t)) for m, t in rows])


def events_of(spark, rows):
    return frame(spark, "MRN string, at timestamp", [(m, at(t)) for m, t in rows])


# --- expressions -----------------------------------------------------------

def test_code_marks(spark):
    df = frame(spark, "code string", [("724.x",), ("72X4",), ("x724",), ("M54_",), ("4311_p",), ("",)])
    x = {r["code"]: (r["subcode"], r["startWith"]) for r in N.mark_x_stems(df).collect()}
    assert x["724.x"] == ("724", True)
    assert x["72X4"] == ("724", False)      # every x goes, only a last one marks a stem
    assert x["x724"] == ("724", False)
    assert x["4311_p"] == ("4311_p", False)
    u = {r["code"]: (r["subcode"], r["startWith"]) for r in N.mark_underscore_stems(df).collect()}
    assert u["M54_"] == ("M54", True)
    assert u["4311_p"] == ("4311p", True)   # why procedure rules only exist on the ICD-9 side


def test_small_expressions(spark):
    row = spark.range(1).select(
        codes.trim_leading_zeros(F.lit("000123")).alias("zeros"),
        codes.strip_metric_prefix(F.lit("CW_lbp")).alias("name"),
        codes.clean_level(F.lit("' 205.0'")).alias("level"),
        codes.clean_level(F.lit("nan")).alias("nothing"),
        dates.whole_years(F.lit(dt.date(2015, 2, 28)), F.lit(dt.date(1980, 2, 29))).alias("leap"),
        dates.whole_years(F.lit(dt.date(2015, 3, 1)), F.lit(dt.date(1980, 2, 29))).alias("after"),
        dates.month_label(F.lit(dt.date(2016, 4, 9))).alias("month"),
        dates.day_gap(F.lit(at("2016-04-02 12:00:00")), F.lit(at("2016-04-01"))).alias("gap"),
    ).first()
    assert tuple(row) == ("0123", "lbp", "205", None, 34, 35, "2016_4", 1.5)


def test_lookup_is_a_table(spark):
    assert lookup(spark.range(6)).inputFiles()
    assert lookup(spark.range(0)).count() == 0
    assert spark.range(10).join(lookup(spark.range(6)), "id").count() == 6


def test_stems_of_seventy_lengths(spark):
    rules = spark.createDataFrame([("A" * n + "B", True) for n in range(1, 71)], "subcode string, startWith boolean")
    claims = spark.createDataFrame([("A" * n + "Bx",) for n in range(1, 72)], "code string")
    marked = cohort.mark_codes(claims, "code", rules, "hit")
    assert sorted((len(r["code"]) - 2, r["hit"]) for r in marked.collect()) == [(n, n < 71) for n in range(1, 72)]


def test_exactly_one_demographic_rule(spark):
    row = ("card", 18, 80, "All")
    rules = spark.createDataFrame([row, row, ("bph", 40, 80, "M")], "key string, agemin int, agemax int, gendercrit string")
    events = spark.createDataFrame([(50.0, "M")], "AgeAtTest double, GENDER string")
    assert cohort.within_demographics(events, rules, "bph").count() == 1
    for metric in ("card", "lbp"):
        with pytest.raises(ValueError):
            cohort.within_demographics(events, rules, metric)
        with pytest.raises(ValueError):
            rulebook.limits_of(rules, [metric])


def test_unknown_encounters_stay(spark):
    rows = spark.createDataFrame([(None,), ("",), ("1",)], "ENC_ID string")
    assert sorted(str(r[0]) for r in N.with_encounter(rows).collect()) == ["1", "None"]


# --- sources ---------------------------------------------------------------

def test_scan_bounds(spark):
    ev = frame(spark, "MRN string, EVT_DATE timestamp", [("a", at(t)) for t in ("2016-03-31 23:59:59", "2016-04-01", "2016-10-01")])
    assert readers.events_between(ev, dt.date(2016, 4, 1), dt.date(2016, 10, 1)).count() == 1
    stays = frame(spark, "MRN string, ENC_ID string, ADM_DT timestamp, DIS_DT timestamp",
                  [("a", "1", at(t), at(t)) for t in ("2016-04-01", "2016-12-01", "2016-12-01 00:00:01")])
    assert readers.admissions_between(stays, dt.date(2016, 4, 1), dt.date(2016, 12, 1)).count() == 2


def test_admission_selection(spark):
    stays = frame(spark, "PT_CLASS string, SRV_CODE string",
                  [("I", "OUT"), ("O", "GMD"), ("O", "OUT"), ("E", "GMD"), (None, "GMD")])
    assert rows_of(builds.qualifying_admissions(stays)) == Counter([("I", "OUT"), ("O", "GMD")])


# --- intervals -------------------------------------------------------------

def brute_exists(tests, events, span, open_end):
    out = []
    for m, t in tests:
        gaps = [(at(t) - at(e)).total_seconds() / 86400 for k, e in events if k == m]
        out.append((m, at(t), any(0 <= g < span if open_end else 0 <= g <= span for g in gaps)))
    return Counter(out)


@pytest.mark.parametrize("open_end", [False, True])
def test_exists_within_boundaries(spark, open_end):
    tests = [("a", "2016-04-11"), ("a", "2016-04-10 23:59:59"), ("b", "2016-04-11"), ("c", "2016-04-11"), ("d", "2016-04-11")]
    events = [("a", "2016-04-01"), ("b", "2016-04-11 00:00:01"), ("c", "2016-04-11")]
    got = I.exists_within(services_of(spark, tests), events_of(spark, events), ["MRN"], F.lit(10), "hit", open_end=open_end)
    assert rows_of(got.select("MRN", "TEST_DATE", "hit")) == Counter(
        {(m, t, int(h)): n for (m, t, h), n in brute_exists(tests, events, 10, open_end).items()})


def _random_times(seed, n):
    rng = random.Random(seed)
    return [(rng.choice("abbbbb"), (dt.datetime(1969, 12, 1) + dt.timedelta(hours=6 * rng.randrange(400))).isoformat())
            for _ in range(n)]


@pytest.mark.parametrize("seed,span", [(1, 1), (2, 7), (3, 30)])
def test_exists_within_random(spark, seed, span):
    tests, events = _random_times(seed, 80), _random_times(seed + 50, 12)
    for open_end in (False, True):
        got = I.exists_within(services_of(spark, tests), events_of(spark, events), ["MRN"], F.lit(span), "hit", open_end=open_end)
        assert rows_of(got.select("MRN", "TEST_DATE", "hit")) == Counter(
            {(m, t, int(h)): n for (m, t, h), n in brute_exists(tests, events, span, open_end).items()})


@pytest.mark.parametrize("seed,strict", [(4, False), (5, True)])
def test_prior_and_following_random(spark, seed, strict):
    tests, events = _random_times(seed, 80), _random_times(seed + 50, 40)
    measures = {"n": ("sum", F.lit(1)), "first": ("min", F.col("at")), "last": ("max", F.col("at"))}

    def brute(before):
        out = Counter()
        for m, t in tests:
            hits = [at(e) for k, e in events if k == m and ((at(e) < at(t) if before else at(e) > at(t))
                                                           or (at(e) == at(t) and not strict))]
            out[(m, at(t), len(hits), min(hits, default=None), max(hits, default=None))] += 1
        return out

    t, e = services_of(spark, tests), events_of(spark, events)
    show = ["MRN", "TEST_DATE", "n", "first", "last"]
    assert rows_of(I.prior_summary(t, e, ["MRN"], measures, strict=strict).select(*show)) == brute(True)
    assert rows_of(I.following_summary(t, e, ["MRN"], measures, strict=strict).select(*show)) == brute(False)


def test_neighbours(spark):
    df = frame(spark, "MRN string, EVT_DATE timestamp, ENC_ID string",
               [("a", at("2016-01-01 06:00:00"), "1"), ("a", at("2016-01-01 18:00:00"), "2"), ("a", at("2016-01-03 18:00:00"), "3"),
                ("b", at("2016-01-01"), "4")])
    got = rows_of(I.neighbours(df, "MRN", "EVT_DATE").select("ENC_ID", "to_next", "since_last"))
    assert got == Counter([("1", 0.5, None), ("2", 2.0, 0.5), ("3", None, 2.0), ("4", None, None)])


def test_repeat_scans(spark):
    df = frame(spark, "MRN string, ENC_ID string, EVT_DATE timestamp",
               [("a", "1", at("2014-01-01")), ("a", "2", at("2016-01-01")),      # exactly 730 days: not a repeat
                ("b", "3", at("2014-01-02")), ("b", "4", at("2016-01-01")),      # 729 days
                ("c", "5", at("2016-01-01")), ("c", "6", at("2016-01-01"))])     # same instant counts once
    assert rows_of(repeat_scans(df, 730).select("MRN", "ENC_ID")) == Counter([("b", "4")])


# --- admissions ------------------------------------------------------------

def stays_of(spark, rows):
    return frame(spark, "MRN string, ADM_DT timestamp, DIS_DT timestamp", [(m, at(a), at(d)) for m, a, d in rows])


def test_latest_admission(spark):
    tests = services_of(spark, [("none", "2016-05-10"), ("later", "2016-05-10"), ("past", "2016-05-10"), ("tied", "2016-05-10"),
                             ("open", "2016-05-10")])
    stays = stays_of(spark, [("later", "2016-06-01", "2016-06-02"), ("past", "2016-04-01", "2016-04-05"),
                             ("past", "2016-05-09", "2016-05-11"), ("tied", "2016-04-01", "2016-04-02"),
                             ("tied", "2016-04-01 10:00:00", "2016-04-03"), ("open", "2016-05-10", "2016-05-10")])
    got = {r["MRN"]: (str(r["ADM_DT_a"]), str(r["DIS_DT"])) for r in H.best_admission(tests, stays).collect()}
    assert got == {"none": ("None", "None"), "past": ("2016-04-01", "2016-04-05 00:00:00"),
                   "tied": ("2016-04-01", "2016-04-03 00:00:00"), "open": ("2016-05-10", "2016-05-10 00:00:00")}
    kept = {r["MRN"] for r in H.best_admission(tests, stays, "keep").collect()}
    assert kept == {"none", "later", "past", "tied", "open"}
    with pytest.raises(ValueError):
        H.best_admission(tests, stays, "maybe")


def test_surgery_day_admission_is_blanked(spark):
    ops = frame(spark, "MRN string, SURG_DATE timestamp", [(m, at("2016-05-10 12:00:00")) for m in ("day", "both", "later", "none")])
    stays = stays_of(spark, [("day", "2016-05-10 07:00:00", "2016-05-10 09:00:00"), ("both", "2016-05-10", "2016-05-12"),
                             ("both", "2016-03-01", "2016-03-02"), ("later", "2016-06-01", "2016-06-02")])
    got = {r["MRN"]: str(r["ADM_DT_a"]) for r in H.surgery_admission(ops, stays, ["MRN"]).collect()}
    assert got == {"day": "None", "both": "2016-03-01", "none": "None"}


def test_recent_admission_is_strict(spark):
    df = frame(spark, "t timestamp, a date, d timestamp", [
        (at("2016-05-31"), dt.date(2016, 4, 1), at("2016-04-01")), (at("2016-05-30"), dt.date(2016, 4, 1), at("2016-04-01")),
        (at("2016-05-31"), None, None)])
    flag = H.recently_admitted(F.to_date("t"), F.col("t"), F.col("a"), F.col("d"), F.lit(60))
    assert [r[0] for r in df.select(flag).collect()] == [False, True, False]


def test_secondary_codes_all_later(spark):
    tests = services_of(spark, [("none", "2016-05-10"), ("later", "2016-05-10"), ("past", "2016-05-10")])
    second = frame(spark, "MRN string, at timestamp, CODE string", [("later", at("2016-06-01"), "c"), ("past", at("2016-05-01"), "c")])
    assert {r["MRN"] for r in H.secondary_history(tests, second).collect()} == {"none", "past"}
    assert {r["MRN"] for r in H.secondary_history(tests, second, "keep").collect()} == {"none", "later", "past"}


# --- codes and crosswalk ---------------------------------------------------

def test_stems_like_startswith(spark):
    rng = random.Random(7)
    universe = ["".join(rng.choice("AB1") for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    rules = [("".join(rng.choice("AB1") for _ in range(rng.randrange(1, 4))), rng.random() < 0.5) for _ in range(12)]
    events = frame(spark, "code string", [(c,) for c in universe] + [(None,)])
    table = frame(spark, "subcode string, startWith boolean", rules)
    got = {r[0] for r in cohort.resolve_codes(events, "code", table).collect()}
    assert got == {c for c in universe if any(c.startswith(s) if stem else c == s for s, stem in rules)}


def test_equal_text_stem_and_whole(spark):
    events = frame(spark, "code string", [("M54",), ("M545",)])
    whole = frame(spark, "subcode string, startWith boolean", [("M54", False)])
    both = frame(spark, "subcode string, startWith boolean", [("M54", False), ("M54", True)])
    assert {r[0] for r in cohort.resolve_codes(events, "code", whole).collect()} == {"M54"}
    assert {r[0] for r in cohort.resolve_codes(events, "code", both).collect()} == {"M54", "M545"}


def test_unique_maps(spark):
    x = frame(spark, "ICD9_subcode string, ICD10_subcode string",
              [("1", "A"), ("1", "B"), ("2", "C"), ("2", "D"), ("3", "E"), ("1", "F")])
    levels = frame(spark, "subcode string, hcclev string", [("A", "9"), ("B", "10"), ("F", "9")])
    up = dict((r[0], r[1]) for r in X.unique_map(x, 9, "upcode", levels).collect())
    down = dict((r[0], r[1]) for r in X.unique_map(x, 9, "downcode", levels).collect())
    assert up == {"1": "F", "2": "D", "3": "E"}      # numbers, not text: 9 < 10
    assert down == {"1": "B", "2": "C", "3": "E"}
    once = X.unique_map(x, 9, "random").collect()
    assert sorted(once) == sorted(X.unique_map(x.repartition(3), 9, "random").collect()) and len(once) == 3
    with pytest.raises(ValueError):
        X.unique_map(x, 9, "sideways", levels)


def test_forward_rules(spark):
    rules = frame(spark, M.RULE, [
        ("redflag", "lbp", "ICD", "724", True), ("redflag", "lbp", "ICD", "185", False), ("redflag", "lbp", "ICD", "999", False),
        ("redflag", "lbp", "HCC", "8", False), ("redflag", "lbp", "CPT", "1", False), ("service", "feed", "ICD", "4311_p", False),
        ("service", "feed", "ICD", "5555_p", False)])
    xw = frame(spark, "ICD9_subcode string, ICD10_subcode string, hcclev9 string, hcclev10 string, ccslev9 string, ccslev10 string",
               [("7242", "M545", None, None, None, None), ("724", "M54", "8", "18", None, None), ("185", "C61", None, None, None, None),
                ("1855", "C62", None, None, None, None), ("7", "Z", None, None, None, None)])
    proc = frame(spark, "ICD9_subcode string, ICD10_subcode string", [("4311", "0DH")])
    got = rows_of(X.forward_rules(rules, xw, proc).select("cls", "subcode", "startWith"))
    assert got == Counter([("ICD", "M545", 1), ("ICD", "M54", 1), ("ICD", "C61", 0), ("HCC", "18", 0), ("CPT", "1", 0),
                           ("ICD", "0DH", 0), ("ICD", "5555", 0)])
    assert "0DH" not in {r["subcode"] for r in X.forward_rules(rules, xw, None).collect()}


def test_simplify_refuses(spark):
    x = frame(spark, "ICD9_TYPE string, ICD10_TYPE string, MAPPING_EXPIRATION_DATE date", [])
    with pytest.raises(ValueError):
        X.simplify(x, 10, "p")
    with pytest.raises(ValueError):
        X.simplify(x, 9, "z")


def test_level_fan_out_and_nulls(spark):
    claims = frame(spark, "MRN string, ICD10_subcode string", [("a", "X"), ("b", None)])
    hcc = frame(spark, "subcode string, hcclev string", [("X", "1"), ("X", "2"), (None, "3")])
    ccs = frame(spark, "subcode string, ccslev string", [("Y", "1")])
    got = rows_of(N.attach_levels(claims, hcc, ccs).select("MRN", "hcclev", "ccslev"))
    assert got == Counter([("a", "1", None), ("a", "2", None), ("b", None, None)])


# --- numerators ------------------------------------------------------------

def test_red_flag_takes_the_whole_patient(spark):
    tests = services_of(spark, [("a", "2016-05-10"), ("a", "2018-05-10"), ("b", "2016-05-10"), ("c", "2016-05-10")])
    flags = frame(spark, "MRN string, EVT_DATE timestamp", [("a", at("2016-05-01")), ("b", at("2015-05-11")), ("c", at("2016-05-11"))])
    # b: exactly 365 days, still inside; c: flagged after the test only
    assert {r["MRN"] for r in U.without_red_flags(tests, flags, LOOK).collect()} == {"c"}
    assert {r["MRN"] for r in U.without_red_flags(tests, flags, LOOK - 1).collect()} == {"b", "c"}


def test_old_complaints(spark):
    tests = services_of(spark, [("young", "2016-05-10"), ("old", "2016-05-10"), ("edge", "2016-05-10"), ("other", "2016-05-10")])
    claims = frame(spark, "MRN string, EVT_DATE timestamp, ICD10_subcode string", [
        ("young", at("2016-05-01"), "I"), ("old", at("2016-01-01"), "I"), ("edge", at("2016-03-11"), "I"),
        ("other", at("2016-01-01"), "I"), ("other", at("2016-01-02"), "Z")])
    rules = frame(spark, M.RULE, [("indication", "bph", "ICD", "I", True)])
    got = {r["MRN"] for r in U.without_old_complaints(tests, claims, rules, 60).collect()}
    assert got == {"young", "other"}      # a claim exactly 60 days old is old


def test_first_per_key_is_total(spark):
    df = frame(spark, "k string, a int, b string", [("x", 2, "q"), ("x", 1, None), ("x", 1, "z"), ("y", None, "w")])
    got = rows_of(N.first_per_key(df, ["k"], ["a"]))
    assert got == Counter([("x", 1, "z"), ("y", None, "w")])
    assert got == rows_of(N.first_per_key(df.repartition(4), ["k"], ["a"]))


# --- reports and agreement -------------------------------------------------

def test_rates_with_empty_terms(spark):
    demo = frame(spark, "key string, agemin int, agemax int, gendercrit string", [("lbp", 18, 80, "All")])
    rows = frame(spark, "mode string, metric string, term string, MRN string, TEST_DATE_month string", [
        ("m", "lbp", "denominator", "a", "2016_4"), ("m", "lbp", "denominator", "a", "2016_4"), ("m", "lbp", "numerator", "b", "2016_5"),
        ("m", "lbp", "numerator", "b", "2015_1")])
    got = rows_of(R.monthly_rate(rows, ["2016_4", "2016_5"], demo).select("TEST_DATE_month", "numerator", "denominator", "proportion"))
    assert got == Counter([("2016_4", 0, 1, 0.0), ("2016_5", 1, 0, 0.0)])


def test_agreement_numbers(spark):
    rows = [("TNumer",)] * 3 + [("FNumer",)] + [("TNot_Numer",)] * 4 + [("FNot_Numer",)] * 2
    judged = frame(spark, "agreement string", rows).withColumn("metric", F.lit("a"))
    perfect = frame(spark, "agreement string", [("TNumer",), ("TNot_Numer",)]).withColumn("metric", F.lit("b"))
    table = E.confusion(judged.unionByName(perfect), ["metric"])
    both = E.likelihood(E.predictive(E.accuracy(table))).collect()
    a, b = sorted(both, key=lambda r: r["metric"])
    assert (a["sensitivity"], a["specificity"], a["ppv"], round(a["npv"], 6), a["accuracy"]) == (0.6, 0.8, 0.75, 0.666667, 0.7)
    assert round(a["lr_plus"], 9) == 3.0 and round(a["lr_minus"], 9) == 0.5
    assert b["lr_plus"] is None and b["lr_minus"] == 0.0      # infinite becomes null
    assert a["tp"] + a["fp"] + a["tn"] + a["fn"] == len(rows)


def test_drug_price_fans_out(spark):
    rows = frame(spark, "metric string, TEST_CODE string", [("psyc", "d1"), ("lbp", "c1"), ("vitd", "v"), ("lbp", "?")])
    fees = frame(spark, "HCPCS string, dollar_reimb double", [("c1", 5.0), ("v", 99.0), ("d1", 1000.0)])
    prices = frame(spark, M.DRUG_PRICE, [("x", "d1", "n1", 2.0), ("x", "d1", "n2", 3.0)])
    got = rows_of(cost.costed(rows, fees, prices, 40.0))
    assert got == Counter([("psyc", "d1", 2.0), ("psyc", "d1", 3.0), ("lbp", "c1", 5.0), ("vitd", "v", 40.0), ("lbp", "?", None)])


def test_sample_respects_quota(spark):
    rows = frame(spark, "metric string, label string, MRN string", [("m", "Numer", str(i)) for i in range(50)] + [("m", "Not_Numer", "z")])
    quota = frame(spark, "metric string, label string, needed int", [("m", "Numer", 7), ("m", "Not_Numer", 3)])
    drawn = P.stratified(rows, quota, ["metric", "MRN"])
    assert drawn.groupBy("label").count().collect().__len__() == 2
    assert rows_of(drawn) == rows_of(P.stratified(rows.repartition(5), quota, ["metric", "MRN"]))
    assert drawn.filter("label = 'Numer'").count() == 7
    assert rows_of(P.missed_quota(rows, quota).select("label", "available")) == Counter([("Not_Numer", 1)])


def test_quality_checks_pass_on_clean_rules(spark):
    clean = frame(spark, M.RULE, [("redflag", "lbp", "ICD", "M54", True), ("service", "lbp", "CPT", "1", False)])
    for check in (Q.stem_violations, Q.native_level_rules, Q.stray_cpt_rules):
        assert check(clean).isEmpty()


def test_settings_are_checked():
    with pytest.raises(ValueError):
        M.Metric("lbp")
    with pytest.raises(ValueError):
        M.Metric("nope")
    with pytest.raises(ValueError):
        M.Mode("m", 9, "rules")
    with pytest.raises(ValueError):
        M.Mode("m", 8, "none")


def test_placeholder_stems_are_made_once(spark):
    """No filter repeats the text work of a crosswalk that is itself computed; null and short codes make no stem."""
    rows = spark.createDataFrame([("S22.00x",), ("Sx",), ("xab",), ("C61",), ("",), (None,)], "raw string")
    wide = rows.distinct().select(codes.strip_dots(F.col("raw")).alias("ICD10_subcode"))
    claims = spark.createDataFrame([("S22.0",), ("S22",), ("S22001",), ("S22001",), (None,)], "CODE string")
    got = Q.placeholder_conflicts(claims, wide)
    assert rows_of(got) == Counter({("S22001", "S2200", 2): 1, ("S22.0", "S", 1): 1, ("S22", "S", 1): 1, ("S22001", "S", 2): 1})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1 and plan.count("translate") == 1


def test_literal_lookup_has_no_branches(spark):
    """A lookup in constants stays as short for many keys as for few; other keys and null give null."""
    values = {f"k{i}": i for i in range(60)}
    df = spark.createDataFrame([("k0",), ("k59",), ("x",), (None,)], "k string").select("k", rulebook.choose(F.col("k"), values).alias("v"))
    assert rows_of(df) == Counter({("k0", 0): 1, ("k59", 59): 1, ("x", None): 1, (None, None): 1})
    assert "CASE" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(df.select(rulebook.choose(F.col("k"), {}).alias("v"))) == Counter({(None,): 4})


def test_first_claims_are_looked_up_by_place(spark):
    """Every cell gets its own first times, whatever the metrics and modes beside it, without a branch a cell."""
    from lowtide.catalog import study
    from lowtide.plans import metrics as P

    for metrics, modes in ((list(M.METRIC_NAMES), list(M.MODES)), (["cerv", "lbp"], ["claimto9_reimb"]), (["card"], ["10to10"])):
        book = study.book(spark, tuple(metrics), tuple(modes))
        claims = spark.createDataFrame([("p", at("1996-03-01"), "M545", 66.0, "F"), ("p", at("1996-04-01"), "I252", 66.0, "F"),
                                        ("q", at("1996-05-01"), "M81", 41.0, "M"), ("q", at("1996-06-01"), "N401", 41.0, "M")],
                                       "MRN string, EVT_DATE timestamp, ICD10_subcode string, AgeAtTest double, GENDER string")
        firsts = P.first_claims(claims, book)
        cells = [(who, metric, mode, at("1998-02-01")) for who in ("p", "q", "r") for metric in metrics for mode in modes]
        tests = spark.createDataFrame(cells, "MRN string, metric string, mode string, TEST_DATE timestamp")
        got = P._with_history(tests, firsts, None, book, I.Deal(("MRN",), {}))
        wide = {r.MRN: r.asDict() for r in firsts.collect()} if firsts is not None else {}
        scopes = {m.name: rulebook.scope_of(m) for m in book.modes}
        for r in got.collect():
            row = wide.get(r.MRN, {})
            assert r.first_any == row.get(f"any_{r.metric}_{scopes[r['mode']]}")
            assert r.first_new == row.get(f"new_{r.metric}_{r['mode']}")
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.split("Aggregate")[0].count("CASE") == 0


def test_joins_sort_by_patient_first(spark):
    """Modes and metrics are few: a join that sorts by them first compares whole keys."""
    from lowtide.plans import metrics as P

    assert P.CELL[0] == "MRN"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = spark.createDataFrame([("10to10", "lbp", "p", "c", at("1998-02-01"), "1998_2", "Numer")],
                                     "mode string, metric string, MRN string, TEST_CODE string, TEST_DATE_a timestamp, TEST_DATE_month string, label string")
        gold = spark.createDataFrame([("lbp", "p", "c", "Numer", "1998_2")], "metric string, MRN string, TEST_CODE string, Term_assessed string, TEST_DATE_month string")
        got = E.judged(rows, gold)
        assert [r.agreement for r in got.collect()] == ["TNumer"]
        assert "SortMergeJoin [MRN" in got._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
