"""Payroll periods: one calendar month each."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_key(year: Column, month: Column) -> Column:
    """``yyyy-MM`` text of a period."""
    return F.format_string("%04d-%02d", year, month)


def in_period(work_date: Column, year: int, month: int) -> Column:
    """Date within the month, as a range that reaches the scan as a filter."""
    first = date(year, month, 1)
    following = date(year + month // 12, month % 12 + 1, 1)
    return (work_date >= F.lit(first)) & (work_date < F.lit(following))


def previous_period(day: Column) -> Column:
    """Period key of the month before ``day``."""
    before = F.add_months(day, -1)
    return period_key(F.year(before), F.month(before))
