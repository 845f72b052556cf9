"""Step attrition: tests and patients left after each step of every metric.

The counts are taken from the tables that ``evaluate`` itself goes on with, so
the trace and the result cannot part; the last step holds the tests of which
the numerator keeps one a patient, day and code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lowtide.plans import metrics as P
from lowtide.plans.rulebook import Rulebook
from lowtide.sources.sinks import stage


class Tracer:
    """Keeps the rows that pass each step of ``evaluate``, as (mode, metric, MRN, step).

    A step's rows are written once: the metrics go on with the same table that
    is counted. Tests before the study window only date a report and are left out.
    """

    def __init__(self, inputs: P.Inputs):
        self.start = F.lit(inputs.study.start).cast("timestamp")
        self.steps: list[DataFrame] = []

    def __call__(self, step: str, rows: DataFrame, passed: Column) -> DataFrame:
        rows = stage(rows, "trace")
        kept = rows.filter(passed & (F.col("TEST_DATE") >= self.start))
        self.steps.append(kept.select(*P.CELL, F.lit(step).alias("stage")))
        return rows

    def counts(self, book: Rulebook) -> DataFrame:
        """(mode, metric, stage, rows, patients) of every cell and step, zeros included."""
        # rows of a patient are added up first, so a patient of any size is one row of the second grouping
        patients = reduce(DataFrame.unionByName, self.steps).groupBy(*P.CELL, "stage").agg(F.count(F.lit(1)).alias("n"))
        found = patients.groupBy("mode", "metric", "stage").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("patients"))
        cells = [(mode.name, metric.name, step) for mode in book.modes for metric in book.metrics for step in P.STEPS]
        every = found.sparkSession.createDataFrame(cells, "mode string, metric string, stage string")
        return every.join(found, ["mode", "metric", "stage"], "left").fillna(0, ["rows", "patients"])


def attrition(inputs: P.Inputs, book: Rulebook) -> DataFrame:
    """(mode, metric, stage, rows, patients) on the way into the numerators of the rulebook's cells."""
    tracer = Tracer(inputs)
    P.evaluate(inputs, book, stage, tracer)
    return tracer.counts(book)
