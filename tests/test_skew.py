"""Heavy keys, prefix scans and candidate filters: same rows as the plain way, and work that spreads."""

import random

import pytest
from pyspark.sql import functions as F

from lowtide.catalog import study
from lowtide.functions.bitmaps import filtered, key_set
from lowtide.operators.intervals import exists_within, neighbours, prior_summary
from lowtide.operators.skew import Deal, deal, join_facts
from lowtide.plans import metrics as P
from support import at, duck, rows_of

SF = "/root/testdata/sf0.001"


def visits(spark, n=3000, seed=11):
    """Rows and events; patient p0 has a third of both, and 40 rows at one instant."""
    rng = random.Random(seed)
    who = lambda: "p0" if rng.random() < 0.33 else f"p{rng.randint(1, 60)}"
    moment = lambda: at("1998-01-01") + rng.random() * 300 * (at("1998-01-02") - at("1998-01-01"))
    rows = [(i, who(), moment().replace(microsecond=0)) for i in range(n)] + [(n + i, "p0", at("1998-02-01 08:00")) for i in range(40)]
    events = [(who(), moment().replace(microsecond=0)) for _ in range(n)] + [("p0", at("1998-02-01 08:00"))] * 40 + [("p61", None)]
    return (spark.createDataFrame(rows, "id long, MRN string, TEST_DATE timestamp"), spark.createDataFrame(events, "MRN string, at timestamp"), rows, events)


def test_heavy_cells_are_found_and_split(spark):
    rows, _, plain, _ = visits(spark)
    found = deal(rows, ["MRN"], parts=50)
    share = -(-len(plain) // 50)
    count = sum(r[1] == "p0" for r in plain)
    assert max(found.pieces.values()) >= count // share and len(found.pieces) <= 50
    pieces = found.salted(rows).filter("MRN = 'p0'").groupBy("_piece").count().collect()
    assert len(pieces) >= 10 and max(r["count"] for r in pieces) < 3 * share
    assert deal(rows.limit(0), ["MRN"]).pieces == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_dealt_join_is_the_plain_join(spark, how):
    rows, _, _, _ = visits(spark)
    rows = rows.unionByName(spark.createDataFrame([(9999, None, None)], rows.schema))
    facts = spark.createDataFrame([("p0", 1), ("p1", 2), ("p99", 3)], "MRN string, f int")
    by = deal(rows, ["MRN"], parts=40)
    assert by.pieces and rows_of(join_facts(rows, facts, ["MRN"], how, by)) == rows_of(rows.join(facts, ["MRN"], how))
    assert rows_of(join_facts(rows, facts, ["MRN"], how, Deal(("MRN",), {}))) == rows_of(rows.join(facts, ["MRN"], how))
    with pytest.raises(ValueError):
        join_facts(rows, facts, ["MRN"], how, Deal(("id",), {}))


def test_exists_within_with_heavy_keys(spark):
    rows, events, plain, seen = visits(spark, 600)
    for open_end in (False, True):
        got = exists_within(rows, events, ["MRN"], F.lit(3), "hit", open_end=open_end, by=deal(rows, ["MRN"], parts=40))
        span = 3 * (at("1998-01-02") - at("1998-01-01"))
        near = lambda t, e: e is not None and e <= t and (t - e < span if open_end else t - e <= span)
        want = {i: any(m == w and near(t, e) for w, e in seen) for i, m, t in plain}
        assert {r.id: r.hit for r in got.collect()} == want and len(set(want.values())) == 2


@pytest.mark.parametrize("strict", [False, True])
def test_prefix_scan_is_brute_force(spark, strict):
    rows, events, plain, seen = visits(spark, 500)
    got = prior_summary(rows, events, ["MRN"], {"n": ("sum", F.lit(1)), "first": ("min", F.col("at")), "last": ("max", F.col("at"))}, strict=strict)
    for r in got.collect():
        before = [e for w, e in seen if w == r.MRN and e is not None and (e < r.TEST_DATE if strict else e <= r.TEST_DATE)]
        assert (r.n, r["first"], r["last"]) == (len(before), min(before, default=None), max(before, default=None))
    assert got.count() == len(plain)


def test_scan_reads_its_input_once_and_spreads_a_patient(spark):
    rows, events, _, _ = visits(spark)
    counted = spark.sparkContext.accumulator(0)

    def tick(batches):
        for b in batches:
            counted.add(b.num_rows)
            yield b

    once = rows.mapInArrow(tick, rows.schema)
    out = prior_summary(once, events, ["MRN"], {"n": ("sum", F.lit(1))})
    out.collect()
    assert counted.value == rows.count()
    # the join that adds the days before is on (patient, day): a third of the rows in one patient is 300 keys
    assert rows.filter("MRN = 'p0'").select("MRN", F.to_date("TEST_DATE")).distinct().count() > 250
    counted.add(-counted.value)
    seen = events.filter("at is not null").distinct().withColumnRenamed("MRN", "who")
    before = seen.count()
    neighbours(seen.mapInArrow(tick, seen.schema), "who", "at").collect()
    assert counted.value == before


def test_gaps_are_those_of_sql(spark):
    _, events, _, _ = visits(spark, 400)
    distinct = events.filter("at is not null").distinct().withColumnRenamed("at", "seen")
    con = duck()
    con.register("e", distinct.toPandas())
    want = con.sql("""SELECT MRN, seen, (epoch_us(lead(seen) OVER w) - epoch_us(seen)) / 86400000000.0 AS to_next,
      (epoch_us(seen) - epoch_us(lag(seen) OVER w)) / 86400000000.0 AS since_last FROM e WINDOW w AS (PARTITION BY MRN ORDER BY seen)""").fetchall()
    got = neighbours(distinct, "MRN", "seen").select("MRN", "seen", "to_next", "since_last").collect()
    tidy = lambda rs: sorted((a, b, None if c is None else round(c, 9), None if d is None else round(d, 9)) for a, b, c, d in rs)
    assert [str(x) for x in tidy(map(tuple, got))] == [str(x) for x in tidy(want)]


def test_candidate_filter(spark):
    keys = spark.range(0, 500_000, 977).select(F.col("id").cast("string").alias("k"))
    rows = spark.range(500_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("_bits")).unionByName(
        spark.createDataFrame([(None, 1)], "k string, _bits int"))
    kept = filtered(rows.drop("_bits"), "k", key_set(keys, "k"))
    assert kept.columns == ["k"] and keys.join(kept, "k", "left_anti").isEmpty()
    assert kept.count() < 2 * keys.count() and kept.filter("k is null").isEmpty()
    assert filtered(rows.drop("_bits"), "k", key_set(keys.limit(0), "k")).isEmpty()


def test_claims_are_filtered_before_they_fan_out(spark):
    """Claims of patients without a test leave the scan before they are copied to metrics and scopes."""
    book = study.book(spark, ("bph", "lbp"), ("10to10", "claimto9_reimb"))
    claims = study.claims(spark, SF)
    few = claims.filter("MRN in ('000000001', '000000002')")
    narrowed = filtered(claims, "MRN", key_set(few, "MRN"))
    times = P.claim_times(narrowed, book, list(book.metrics))
    plan = times._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("_bits")
    whole = P.claim_times(claims, book, list(book.metrics))
    assert times.count() < whole.count() / 5
    assert rows_of(times.join(few.select("MRN").distinct(), "MRN")) == rows_of(whole.join(few.select("MRN").distinct(), "MRN"))
