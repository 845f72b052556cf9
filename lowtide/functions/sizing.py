"""Lookup tables (rules, crosswalks, level maps, fee schedules)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lowtide.sources.sinks import stage


def lookup(df: DataFrame) -> DataFrame:
    """``df`` written once as a table.

    Its readers share one pass and Spark knows its size, so Spark's own
    threshold decides about a broadcast; there is one plan for all sizes.
    """
    return stage(df, "lookup")
