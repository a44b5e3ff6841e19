"""Pay arithmetic on decimals, rounded half up to cents."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroll.schemas import Params


def exact(value: Decimal | str | int) -> Column:
    """A decimal literal; a float would bring binary rounding with it."""
    if isinstance(value, float):
        raise TypeError("amounts are decimals, not floats")
    return F.lit(Decimal(value))


def gross_pay(hours: Column, rate: Column, params: Params = Params()) -> Column:
    """Hours up to the threshold at the rate, the rest at the multiple of it,
    rounded once at the end."""
    threshold = exact(params.overtime_threshold_hours)
    regular = F.least(hours, threshold) * rate
    overtime = F.greatest(hours - threshold, exact(0)) * rate * exact(params.overtime_multiplier)
    return F.round(regular + overtime, 2)


def deductions(gross: Column, params: Params = Params()) -> Column:
    """Flat share of the rounded gross pay."""
    return F.round(gross * exact(params.deduction_rate), 2)


def net_pay(gross: Column, deducted: Column) -> Column:
    return F.round(gross - deducted, 2)
