"""Repeat-scan logic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lowtide.operators.intervals import neighbours


def repeat_scans(scans: DataFrame, window_days: int) -> DataFrame:
    """Scans less than ``window_days`` after the patient's previous one.

    Several scans at one instant count as one; the least encounter id stands
    for them. A patient with a single scan time has no previous scan, so no
    separate test for more than one record is needed.
    """
    single = scans.groupBy("MRN", "EVT_DATE").agg(F.min("ENC_ID").alias("ENC_ID"))
    return neighbours(single, "MRN", "EVT_DATE").filter(F.col("since_last") < window_days)
