"""Expressions on dates, ages and gaps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000
#: Mean Gregorian year, used for scan ages; claim ages use 365.25.
GREGORIAN_YEAR_DAYS = 365.2425


def day_gap(later: Column, earlier: Column) -> Column:
    """Fractional days between two timestamps."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(float(DAY_MICROS))


def age_from_days(days: Column) -> Column:
    return F.round(days / F.lit(365.25), 1)


def age_at(event: Column, birth: Column) -> Column:
    """Age in mean Gregorian years, one decimal."""
    return F.round(day_gap(event, birth.cast("timestamp")) / F.lit(GREGORIAN_YEAR_DAYS), 1)


def whole_years(as_of: Column, birth: Column) -> Column:
    """Completed years: a birthday on 29 February counts from 1 March."""
    before_birthday = F.date_format(as_of, "MMdd") < F.date_format(birth, "MMdd")
    return F.year(as_of) - F.year(birth) - before_birthday.cast("int")


def month_label(when: Column) -> Column:
    """``2016_4``: year and month without padding."""
    return F.concat_ws("_", F.year(when), F.month(when))
