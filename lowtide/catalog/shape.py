"""Output shape of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Dates and timestamps as text, flags and counts as long, in plain columns."""
    df = df.select(*columns) if columns else df
    out = []
    for field in df.schema:
        kind = field.dataType.simpleString()
        column = F.col(f"`{field.name}`")
        if kind in ("date", "timestamp", "timestamp_ntz"):
            column = column.cast("string")
        elif kind in ("boolean", "int", "smallint", "tinyint"):
            column = column.cast("long")
        out.append(column.alias(field.name))
    return df.select(*out)
