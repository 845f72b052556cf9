"""Agreement of results with human annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lowtide.model import MONTHLY
from lowtide.operators.normalize import first_per_key

NUMER, NOT_NUMER = "Numer", "Not_Numer"
SERVICE_KEY = ["mode", "metric", "MRN", "TEST_CODE", "TEST_DATE_a", "TEST_DATE_month"]
MONTH_KEY = ["mode", "metric", "MRN", "TEST_DATE_month"]


def is_monthly(column: str = "metric") -> Column:
    return F.col(column).isin(*MONTHLY)


def not_numerator(result: DataFrame) -> DataFrame:
    """Denominator rows whose key is in no numerator: patient-month or service grain.

    One anti join: the service part of the key is blanked for monthly metrics.
    """
    parts = [F.when(~is_monthly(), F.col(c)).alias(f"_{c}") for c in ("TEST_CODE", "TEST_DATE_a")]
    keyed = result.select("*", *[F.coalesce(p.cast("string"), F.lit("")).alias(n) for p, n in zip(parts, ("_code", "_day"))])
    # the patient first: the join sorts by the head of the first key, and modes and metrics are few
    key = ["MRN", "TEST_DATE_month", "metric", "mode", "_code", "_day"]
    hits = keyed.filter("term = 'numerator'").select(*key).distinct()
    rest = [c for c in result.columns if c not in MONTH_KEY]
    return keyed.filter("term = 'denominator'").join(hits, key, "left_anti").select(*MONTH_KEY, *rest)


def unshared_rows(result: DataFrame) -> DataFrame:
    """Rows whose (metric, patient, day, code) occurs exactly once over both terms."""
    key = ["mode", "metric", "MRN", "TEST_DATE_a", "TEST_CODE"]
    single = result.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("term").alias("term"),
                                      F.min("ENC_ID").alias("ENC_ID"), F.min("TEST_DATE_month").alias("TEST_DATE_month"))
    return single.filter("_n = 1").drop("_n")


def labelled(numerator: DataFrame, others: DataFrame) -> DataFrame:
    """Both groups under one label column."""
    columns = ["mode", "metric", "MRN", "TEST_CODE", "TEST_DATE_a", "TEST_DATE_month"]
    return (numerator.select(*columns, F.lit(NUMER).alias("label"))
            .unionByName(others.select(*columns, F.lit(NOT_NUMER).alias("label"))))


def available(labelled_rows: DataFrame, modes: list[str]) -> DataFrame:
    return labelled_rows.groupBy("metric", "label").pivot("mode", modes).agg(F.count(F.lit(1))).fillna(0)


def consolidate_gold(sets: list[DataFrame]) -> DataFrame:
    """Annotation sets made one: only clear labels, once per grain; both labels may survive."""
    keys = ["metric", "MRN", "TEST_CODE", "Term_assessed", "TEST_DATE_month", "Gold_Standard"]
    pot = None
    for annotated in sets:
        flat = annotated.select(*keys)
        pot = flat if pot is None else pot.unionByName(flat)
    clear = pot.filter(F.col("Term_assessed").isin(NUMER, NOT_NUMER)).distinct()
    grain = F.when(~is_monthly(), F.col("TEST_CODE")).otherwise("")
    kept = first_per_key(clear.withColumn("_grain", grain),
                         ["MRN", "TEST_DATE_month", "metric", "Term_assessed", "_grain"], ["TEST_CODE"])
    return kept.drop("_grain")


def judged(labelled_rows: DataFrame, gold: DataFrame) -> DataFrame:
    """Results met by an annotation, with the agreement class.

    Not-numerator patient-months meet on patient and month (no single code);
    all others also on the code. Both cases are one equi-join: the code is
    blanked on the left for the first case and the gold side offers both forms.
    """
    by_month = is_monthly() & (F.col("label") == NOT_NUMER)
    left = labelled_rows.select("mode", "metric", "MRN", "TEST_DATE_month", "label",
                                F.when(~by_month, F.col("TEST_CODE")).alias("TEST_CODE"),
                                F.when(by_month, "").otherwise(F.col("TEST_CODE")).alias("_code"))
    forms = F.when(is_monthly(), F.array(F.col("TEST_CODE"), F.lit(""))).otherwise(F.array(F.col("TEST_CODE")))
    right = gold.select("metric", "MRN", "TEST_DATE_month", "Term_assessed", F.explode(forms).alias("_code"))
    return left.join(right, ["MRN", "TEST_DATE_month", "metric", "_code"]).select(
        "mode", "metric", "MRN", "TEST_CODE", "TEST_DATE_month", "label", "Term_assessed",
        agreement(F.col("label"), F.col("Term_assessed")).alias("agreement"))


def agreement(label: Column, truth: Column) -> Column:
    """TNumer, FNumer, TNot_Numer or FNot_Numer."""
    return F.concat(F.when(label == truth, "T").otherwise("F"), label)


def agreement_counts(judged_rows: DataFrame, by: list[str]) -> DataFrame:
    return judged_rows.groupBy(*by, "agreement").agg(F.count(F.lit(1)).alias("n"))


def confusion(judged_rows: DataFrame, by: list[str]) -> DataFrame:
    """Counts of the four classes, one row per group."""
    classes = {"TNumer": "tp", "FNumer": "fp", "TNot_Numer": "tn", "FNot_Numer": "fn"}
    return judged_rows.groupBy(*by).agg(*[F.count_if(F.col("agreement") == name).alias(short)
                                          for name, short in classes.items()])


def two_by_two(judged_rows: DataFrame, by: list[str]) -> DataFrame:
    """Result against annotation: one row per result sign, one column per truth."""
    sides = F.array(F.struct(F.lit("+ Numer").alias("result"), F.col("tp").alias("truth_numer"), F.col("fp").alias("truth_not_numer")),
                    F.struct(F.lit("- Not Numer").alias("result"), F.col("fn").alias("truth_numer"), F.col("tn").alias("truth_not_numer")))
    return confusion(judged_rows, by).select(*by, F.inline(sides)).filter("truth_numer + truth_not_numer > 0")


def _ratio(top: str, bottom: str) -> Column:
    """0 when nothing is there to divide, as the missing cell is filled with zero."""
    return F.coalesce(F.try_divide(F.expr(top).cast("double"), F.expr(bottom)), F.lit(0.0))


def sensitivity(table: DataFrame) -> DataFrame:
    return table.withColumns({"sensitivity": _ratio("tp", "tp + fn"), "specificity": _ratio("tn", "tn + fp")})


def predictive(table: DataFrame) -> DataFrame:
    return table.withColumns({"ppv": _ratio("tp", "tp + fp"), "npv": _ratio("tn", "tn + fn")})


def accuracy(table: DataFrame) -> DataFrame:
    return table.withColumns({"true_cases": F.expr("tp + tn"), "false_cases": F.expr("fp + fn"),
                              "accuracy": _ratio("tp + tn", "tp + tn + fp + fn")})


def likelihood(table: DataFrame) -> DataFrame:
    """Likelihood ratios; a zero denominator gives null (infinite in floating point)."""
    rated = sensitivity(table)
    return rated.withColumns({
        "lr_plus": F.try_divide(F.col("sensitivity"), 1 - F.col("specificity")),
        "lr_minus": F.try_divide(1 - F.col("sensitivity"), F.col("specificity"))})


def accuracy_table(judged_rows: DataFrame, by: list[str]) -> DataFrame:
    """One row per group: the four counts, all rates and both likelihood ratios."""
    rated = likelihood(predictive(accuracy(confusion(judged_rows, by))))
    return rated.select(*by, "tp", "fp", "tn", "fn", "sensitivity", "specificity", "ppv", "npv", "accuracy", "lr_plus", "lr_minus")


def uncovered_gold(gold: DataFrame, labelled_rows: DataFrame, modes: list[str]) -> DataFrame:
    """Annotations no result row meets, counted per mode and metric."""
    key = ["mode", "metric", "MRN", "TEST_CODE", "TEST_DATE_month"]
    asked = gold.withColumn("mode", F.explode(F.array(*[F.lit(m) for m in modes])))
    missing = asked.join(labelled_rows.select(*key).distinct(), key, "left_anti")
    return missing.groupBy("mode", "metric").agg(F.count(F.lit(1)).alias("omitted"))


def annotation_counts(gold: DataFrame) -> DataFrame:
    return gold.groupBy("metric").agg(F.count_if(F.col("Term_assessed") == NUMER).alias(NUMER),
                                      F.count_if(F.col("Term_assessed") == NOT_NUMER).alias(NOT_NUMER))
