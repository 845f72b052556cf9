"""Registered queries: reports, costs, agreement, sampling, sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lowtide.catalog import study
from lowtide.catalog.measures import MONTHS, shown
from lowtide.catalog.shape import present
from lowtide.functions import codes
from lowtide.model import METRIC_NAMES, MODES, RESULT_SCHEMA
from lowtide.operators import cost as D
from lowtide.operators import evaluate as E
from lowtide.operators import report as R
from lowtide.operators import sample as P
from lowtide.session import scratch_dir
from lowtide.sources import clinical as C, sinks
from lowtide.sources import vocabulary as V

NAMES = list(MODES)
LABELS = ["numerator", "denominator"]
PERIOD = [f"1998_{m}" for m in range(4, 10)]


def rpt1_tally(spark: SparkSession, sf: str) -> DataFrame:
    return present(R.tally(study.results(spark, sf)))


def rpt2_monthly_rate(spark: SparkSession, sf: str) -> DataFrame:
    return present(R.monthly_rate(study.results(spark, sf), PERIOD, C.demographics(spark)))


def rpt3_monthly_patients(spark: SparkSession, sf: str) -> DataFrame:
    rows = study.results(spark, sf)
    parts = [R.monthly_patients(rows, t, PERIOD, C.demographics(spark)).withColumn("term", F.lit(t)) for t in LABELS]
    return present(parts[0].unionByName(parts[1]))


def rpt4_stitched(spark: SparkSession, sf: str) -> DataFrame:
    rows = R.stitched(study.results(spark, sf), "numerator")
    return present(rows.withColumn("CLAIM_DATE", F.to_date("CLAIM_DATE")))


def rpt5_count_table(spark: SparkSession, sf: str) -> DataFrame:
    return present(R.count_table(study.results(spark, sf), NAMES))


def _costed(spark: SparkSession, sf: str) -> DataFrame:
    return D.costed(study.results(spark, sf), D.fee_schedule(C.fees(spark)), C.drug_prices(spark), V.VITD_COST)


def rpt6_cost_check(spark: SparkSession, sf: str) -> DataFrame:
    return present(R.count_table(_costed(spark, sf), NAMES, "MRN"))


def cst1_fee_schedule(spark: SparkSession, sf: str) -> DataFrame:
    """Fee lines without a modifier; the schedule grows with the parts."""
    key = F.col("p_partkey")
    raw = C.table(spark, sf, "part").select(
        F.concat(C.pick(V.PROCEDURES, key % 20), F.lit("-"), key.cast("string")).alias("HCPCS"),
        F.when(key % 3 == 0, "26").alias("MOD"), F.col("p_name").alias("DESCRIPTION"),
        F.col("p_size").cast("double").alias("FACILITY TOTAL"), F.col("p_retailprice").alias("Calc_reimb_GPCIof1"))
    return D.fee_schedule(raw)


def _cost_columns(rows: DataFrame) -> DataFrame:
    return present(rows, "mode", "metric", "term", "MRN", "TEST_CODE", "TEST_DATE_a", "dollar_reimb")


def cst2_service_cost(spark: SparkSession, sf: str) -> DataFrame:
    rows = study.results(spark, sf).filter(~F.col("metric").isin(*D.DRUG_METRICS, D.FLAT_METRIC))
    return _cost_columns(D.service_cost(rows, D.fee_schedule(C.fees(spark))))


def cst3_drug_cost(spark: SparkSession, sf: str) -> DataFrame:
    rows = study.results(spark, sf).filter(F.col("metric").isin(*D.DRUG_METRICS))
    return _cost_columns(D.drug_cost(rows, C.drug_prices(spark)))


def cst4_flat_cost(spark: SparkSession, sf: str) -> DataFrame:
    rows = study.results(spark, sf).filter(F.col("metric") == D.FLAT_METRIC)
    return _cost_columns(D.flat_cost(rows, V.VITD_COST))


def cst5_dollar_table(spark: SparkSession, sf: str) -> DataFrame:
    table = D.dollar_table(_costed(spark, sf), NAMES)
    return present(table.select("metric", "term", *[F.round(F.col(f"`{m}`"), 2).alias(m) for m in NAMES]))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    rows = study.results(spark, sf)
    return E.labelled(rows.filter("term = 'numerator'"), E.not_numerator(rows))


def evl1_not_numerator(spark: SparkSession, sf: str) -> DataFrame:
    return present(E.not_numerator(study.results(spark, sf)), "mode", "metric", "MRN", "TEST_CODE", "TEST_DATE_a", "TEST_DATE_month")


def evl2_unshared_rows(spark: SparkSession, sf: str) -> DataFrame:
    return present(E.unshared_rows(study.results(spark, sf)))


def evl3_available(spark: SparkSession, sf: str) -> DataFrame:
    return present(E.available(_labelled(spark, sf), NAMES))


def _annotations(spark: SparkSession, sf: str) -> DataFrame:
    gold = C.gold(spark, sf).withColumnRenamed("Metric", "_name")
    return gold.withColumn("metric", codes.strip_metric_prefix(F.col("_name"))).drop("_name")


def _gold(spark: SparkSession, sf: str) -> DataFrame:
    notes = _annotations(spark, sf)
    first = F.col("TEST_DATE_month").isin([f"1998_{m}" for m in range(1, 7)])
    return E.consolidate_gold([notes.filter(first), notes.filter(~first)])


def evl4_gold(spark: SparkSession, sf: str) -> DataFrame:
    return present(_gold(spark, sf))


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    return E.judged(_labelled(spark, sf), _gold(spark, sf))


def evl5_joined_gold(spark: SparkSession, sf: str) -> DataFrame:
    return present(_judged(spark, sf).drop("agreement"))


CELL = ["mode", "metric"]


def evl6_agreement(spark: SparkSession, sf: str) -> DataFrame:
    return present(E.agreement_counts(_judged(spark, sf), CELL))


def document_judgements(spark: SparkSession, sf: str) -> DataFrame:
    """A second, larger gold set: long documents taken as good ones."""
    docs = C.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    labels = C.table(spark, sf, "labels").select("doc_id", "quality")
    label = F.when(F.col("n_chars") > 500, E.NUMER).otherwise(E.NOT_NUMER)
    truth = F.when(F.col("quality") == 1, E.NUMER).otherwise(E.NOT_NUMER)
    return docs.join(labels, "doc_id").select(F.lit("documents").alias("mode"), F.col("lang").alias("metric"),
                                              E.agreement(label, truth).alias("agreement"))


def evl6_agreement_documents(spark: SparkSession, sf: str) -> DataFrame:
    return present(E.agreement_counts(document_judgements(spark, sf), CELL))


def evl7_two_by_two(spark: SparkSession, sf: str) -> DataFrame:
    return present(E.two_by_two(_judged(spark, sf), CELL))


def _rates(df: DataFrame, *names: str) -> DataFrame:
    return present(df.select(*CELL, *[F.round(n, 9).alias(n) if not n.endswith("cases") else F.col(n) for n in names]))


def evl8_sensitivity(spark: SparkSession, sf: str) -> DataFrame:
    return _rates(E.sensitivity(E.confusion(_judged(spark, sf), CELL)), "sensitivity", "specificity")


def evl9_predictive(spark: SparkSession, sf: str) -> DataFrame:
    return _rates(E.predictive(E.confusion(_judged(spark, sf), CELL)), "ppv", "npv")


def evl10_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return _rates(E.accuracy(E.confusion(_judged(spark, sf), CELL)), "true_cases", "false_cases", "accuracy")


def evl11_likelihood(spark: SparkSession, sf: str) -> DataFrame:
    return _rates(E.likelihood(E.confusion(_judged(spark, sf), CELL)), "sensitivity", "specificity", "lr_plus", "lr_minus")


def evl11_accuracy_table(spark: SparkSession, sf: str) -> DataFrame:
    table = E.accuracy_table(_judged(spark, sf), CELL)
    rates = [c for c in table.columns if c not in (*CELL, "tp", "fp", "tn", "fn")]
    return present(table.select(*CELL, "tp", "fp", "tn", "fn", *[F.round(c, 9).alias(c) for c in rates]))


def evl12_uncovered_gold(spark: SparkSession, sf: str) -> DataFrame:
    return present(E.uncovered_gold(_gold(spark, sf), _labelled(spark, sf), NAMES))


def evl13_annotation_counts(spark: SparkSession, sf: str) -> DataFrame:
    return present(E.annotation_counts(_gold(spark, sf)))


def _quota(spark: SparkSession, needed: int) -> DataFrame:
    """As many rows of each label from every cell."""
    from lowtide import model as M

    return C.local(spark, M.schema(mode=M.STRING, metric=M.STRING, label=M.STRING, needed=M.INT),
                   [(mode, m, label, needed) for mode in M.MODES for m in METRIC_NAMES for label in (E.NUMER, E.NOT_NUMER)])


DRAW = ["metric", "MRN", "TEST_DATE_a", "TEST_CODE"]
STRATA = ("mode", *P.STRATA)


def _in_study(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf).filter(F.col("TEST_DATE_month").isin(PERIOD))


def _sample(spark: SparkSession, sf: str) -> DataFrame:
    return P.stratified(_in_study(spark, sf), _quota(spark, 5), DRAW, strata=STRATA)


def smp1_stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return present(P.blinded(_sample(spark, sf)), "mode", "metric", "MRN", "TEST_CODE", "TEST_DATE_a", "TEST_DATE_month")


def smp2_missed_quota(spark: SparkSession, sf: str) -> DataFrame:
    return present(P.missed_quota(_in_study(spark, sf), _quota(spark, 40), STRATA))


def smp3_annotation_period(spark: SparkSession, sf: str) -> DataFrame:
    return present(P.in_period(P.with_month(_annotations(spark, sf).drop("TEST_DATE_month")), PERIOD), "metric", "MRN", "TEST_CODE", "TEST_DATE_a",
                   "TEST_DATE_month", "Term_assessed")


def snk1_result_table(spark: SparkSession, sf: str) -> DataFrame:
    """Write the low-back cell partitioned, read it back."""
    path = scratch_dir(spark, "result")
    sinks.write_result(study.run(spark, sf, ("lbp",), ("10to10",)), path)
    return shown(sinks.read_result(spark, path, RESULT_SCHEMA))


def snk2_report_file(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "report")
    report = R.tally(study.results(spark, sf))
    sinks.write_report(report, path)
    return spark.read.schema(report.schema).csv(path, header=True)


def snk3_sheets(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "sheets")
    sheet = present(P.blinded(_sample(spark, sf).filter("mode = '10to10'")), "metric", "MRN", "TEST_CODE", "TEST_DATE_a")
    sinks.write_sheets(sheet, path)
    columns = reduce(lambda s, c: s.add(c, "string"), [*sheet.columns, "sheet"], type(sheet.schema)())
    return spark.read.schema(columns).csv(path, header=True)


QUERIES = {f.__name__: f for f in (
    rpt1_tally, rpt2_monthly_rate, rpt3_monthly_patients, rpt4_stitched, rpt5_count_table, rpt6_cost_check,
    cst1_fee_schedule, cst2_service_cost, cst3_drug_cost, cst4_flat_cost, cst5_dollar_table, evl1_not_numerator,
    evl2_unshared_rows, evl3_available, evl4_gold, evl5_joined_gold, evl6_agreement, evl6_agreement_documents,
    evl7_two_by_two, evl8_sensitivity, evl9_predictive, evl10_accuracy, evl11_likelihood, evl11_accuracy_table, evl12_uncovered_gold,
    evl13_annotation_counts, smp1_stratified_sample, smp2_missed_quota, smp3_annotation_period, snk1_result_table,
    snk2_report_file, snk3_sheets)}
