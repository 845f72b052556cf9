"""Expressions on clinical codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_dots(code: Column) -> Column:
    return F.regexp_replace(code, r"\.", "")


def ends_in_x(code: Column) -> Column:
    """True when the last character marks a stem (``X`` or ``x``)."""
    return F.lower(F.right(code, F.lit(1))) == "x"


def drop_x(code: Column) -> Column:
    return F.regexp_replace(code, "[xX]", "")


def has_underscore(code: Column) -> Column:
    return F.contains(code, F.lit("_"))


def drop_underscore(code: Column) -> Column:
    return F.replace(code, F.lit("_"), F.lit(""))


def upper_x(code: Column) -> Column:
    return F.translate(code, "x", "X")


def trim_leading_zeros(mrn: Column) -> Column:
    """Drop one or two leading zeros, never more."""
    return F.regexp_replace(mrn, "^0{1,2}", "")


def strip_metric_prefix(name: Column) -> Column:
    """``CW_lbp`` -> ``lbp``: any two characters and an underscore."""
    return F.regexp_replace(name, "^.._", "")


def first_token(text: Column) -> Column:
    return F.substring_index(F.lower(text), " ", 1)


def clean_level(raw: Column) -> Column:
    """Level text without quotes, blanks and decimals; ``nan`` becomes null."""
    plain = F.regexp_replace(raw, "[' ]", "")
    cut = F.substring_index(plain, ".", 1)
    return F.nullif(cut, F.lit("nan"))
