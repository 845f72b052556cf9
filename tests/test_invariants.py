"""Properties of whole results, whatever the data."""

import dataclasses

from pyspark.sql import functions as F

from lowtide import model as M
from lowtide.catalog import study
from lowtide.catalog.measures import shown
from lowtide.operators import crosswalk as X
from lowtide.plans import rulebook, upkeep
from lowtide.plans.metrics import evaluate
from lowtide.session import files_below, remove
from lowtide.sources import clinical as C
from lowtide.sources import sinks
from support import rows_of

SF = "/root/testdata/sf0.001"


def test_monthly_numerator_is_inside_its_denominator(spark):
    rows = study.results(spark, SF).filter(F.col("metric").isin(*M.MONTHLY))
    key = ["mode", "metric", "MRN", "TEST_DATE_month"]
    inside = rows.filter("term = 'numerator'").join(rows.filter("term = 'denominator'"), key, "left_anti")
    assert inside.isEmpty()


def test_grain_keys_are_unique(spark):
    rows = study.results(spark, SF).filter("based_on is null or based_on = 'CPT'")
    service = rows.filter(~(F.col("metric").isin(*M.MONTHLY) & (F.col("term") == "denominator")))
    month = rows.filter(F.col("metric").isin(*M.MONTHLY) & (F.col("term") == "denominator"))
    assert service.groupBy("mode", "metric", "term", "MRN", "TEST_DATE_a", "TEST_CODE").count().filter("count > 1").isEmpty()
    assert month.groupBy("mode", "metric", "MRN", "TEST_DATE_month").count().filter("count > 1").isEmpty()


def test_same_result_on_other_partitionings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        found = []
        for n in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(rows_of(shown(study.run(spark, SF, ("lbp", "vitd"), ("refto10_gems",)))))
        assert found[0] == found[1] and found[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_identity_crosswalk_is_the_native_mode(spark):
    """Claims mapped onto themselves, under the native rules, give the native result."""
    refs = study.references(spark)
    codes = study.claims(spark, SF).select("ICD10_subcode").distinct()
    same = X.attach_both_levels(codes.withColumn("ICD9_subcode", F.col("ICD10_subcode")), {
        (kind, g): C.level_map(spark, kind, 10).limit(0) for kind in ("hcc", "ccs") for g in (9, 10)})
    twin = dataclasses.replace(refs, rules={9: refs.rules[10], 10: refs.rules[10]},
                               crosswalks={**refs.crosswalks, "reimburse": same})
    names = ("lbp", "bph", "card", "psyc")
    inputs = study.inputs(spark, SF, names)
    mapped = evaluate(inputs, rulebook.build(twin, list(names), ["claimto9_reimb"]))
    native = evaluate(inputs, rulebook.build(twin, list(names), ["10to10"]))
    assert rows_of(shown(mapped).drop("mode")) == rows_of(shown(native).drop("mode"))


def test_without_broadcasts_the_same(spark):
    """Lookups too large for a broadcast change no result, in any metric."""
    names = M.METRIC_NAMES
    want = rows_of(shown(study.run(spark, SF, names, ("refto10_gems",))))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = rows_of(shown(study.run(spark, SF, names, ("refto10_gems",))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want and want


def test_only_changed_cells_are_computed(spark, tmp_path):
    """One more rule, a changed file, a killed run: the cells concerned are computed again, the result is that of a whole run."""
    names, modes = ("card", "lbp", "cerv"), ("10to10", "claimto9_reimb")
    refs, path = study.references(spark), str(tmp_path / "grid")
    more = refs.rules[10].unionByName(spark.createDataFrame([("redflag", "card", "ICD", "E119", False)], refs.rules[10].schema))
    books = [rulebook.build(r, list(names), list(modes)) for r in (refs, dataclasses.replace(refs, rules={**refs.rules, 10: more}))]
    states = [upkeep.cell_states(b, upkeep.rule_hashes(b), study.STUDY, "files") for b in books]
    given = lambda metrics: study.inputs(spark, SF, metrics)

    def update(k, wanted):
        return upkeep.update(spark, path, books[k], wanted, given, lambda df, name: df)

    def times():
        return {f: t for f, _, t in files_below(spark, path) if f.endswith(".parquet")}

    assert len(update(0, states[0])) == 6 and update(0, states[0]) == []
    before = times()
    assert update(1, states[1]) == [("10to10", "card")]
    after = times()
    assert {f for f in before if before[f] == after.get(f)} == {f for f in before if "mode=10to10/metric=card" not in f}
    want = rows_of(shown(evaluate(study.inputs(spark, SF, names), books[1])))
    assert rows_of(shown(sinks.read_result(spark, path, M.RESULT_SCHEMA))) == want
    # a run that stopped after it removed a cell
    remove(spark, f"{path}/mode=10to10/metric=lbp")
    upkeep._note(spark, path, {c: s for c, s in states[1].items() if c != ("10to10", "lbp")})
    assert update(1, states[1]) == [("10to10", "lbp")]
    assert rows_of(shown(sinks.read_result(spark, path, M.RESULT_SCHEMA))) == want
    fewer = {c: s for c, s in states[1].items() if c[1] != "cerv"}
    assert update(1, fewer) == []
    assert rows_of(shown(sinks.read_result(spark, path, M.RESULT_SCHEMA).filter("metric = 'cerv'"))) == {}
    assert upkeep.input_state(spark, [f"{SF}/part.parquet"]) != upkeep.input_state(spark, [f"{SF}/orders.parquet"])
