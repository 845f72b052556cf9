"""Registered queries: the eleven metrics, the five modes, the grid."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lowtide.catalog import study
from lowtide.catalog.shape import present
from lowtide.model import METRIC_NAMES, METRICS, MODES
from lowtide.operators import report as R
from lowtide.plans.metrics import HITS
from lowtide.sources import clinical as C, sinks

MONTHS = [f"1998_{m}" for m in range(1, 13)]
SHOWN = ["mode", "metric", "term", "MRN", "ENC_ID", "TEST_CODE", "TEST_DATE_a", "TEST_DATE_month", "AgeAtTest",
         "CLAIM_DATE", "ADM_DT_a", "SURG_DATE", "based_on"]


def shown(result: DataFrame) -> DataFrame:
    days = result.withColumns({c: F.to_date(c) for c in ("CLAIM_DATE", "SURG_DATE")})
    return present(days, *SHOWN)


def _metric(name: str) -> Callable[[SparkSession, str], DataFrame]:
    metric = METRICS[name]
    # steps that read the candidates several times write them once
    stage = sinks.stage_some(*HITS, "candidates", "surgeries", "marked") if metric.admission or metric.repeat_scan else None

    def query(spark: SparkSession, sf: str) -> DataFrame:
        return shown(study.run(spark, sf, (name,), ("10to10",), procedures=name == "feed", stage=stage))
    return query


def _mode(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return shown(study.run(spark, sf, METRIC_NAMES, (name,), stage=sinks.stage))
    return query


def run6_grid(spark: SparkSession, sf: str) -> DataFrame:
    return shown(study.results(spark, sf))


def lbp_monthly_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: monthly low-back imaging rate under native rules."""
    result = study.run(spark, sf, ("lbp",), ("10to10",))
    return present(R.monthly_rate(result, MONTHS, C.demographics(spark)))


ORDER = ["cerv", "card", "vitd", "bph", "lbp", "feed", "psyc", "dexa", "narc", "nonpreop", "catpreop"]
QUERIES = {
    **{f"met{i}_{name}": _metric(name) for i, name in enumerate(ORDER, 1)},
    **{f"run{i}_{name}": _mode(name) for i, name in enumerate(MODES, 1)},
    "run6_grid": run6_grid,
    "lbp_monthly_rate": lbp_monthly_rate,
}
