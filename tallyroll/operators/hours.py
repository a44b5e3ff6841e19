"""Hours per employee and run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.functions.periods import in_period


def period_entries(entries: DataFrame, year: int, month: int) -> DataFrame:
    """Entries whose work date lies in the month. Stored entries are pruned to
    the month's own partition."""
    found = entries.filter(in_period(F.col("work_date"), year, month))
    if {"work_year", "work_month"} <= set(entries.columns):
        found = found.filter((F.col("work_year") == year) & (F.col("work_month") == month))
    return found


def in_id_range(employee_id: Column, low: int, high: int) -> Column:
    """Both ends included; an inverted range holds nothing."""
    return employee_id.between(low, high)


def run_periods(runs: DataFrame) -> DataFrame:
    """The distinct months of the runs. At most twelve per year, so this side
    of a join is small however many runs there are."""
    return runs.select(
        F.col("period_year").alias("work_year"), F.col("period_month").alias("work_month")
    ).distinct()


def entries_for_runs(runs: DataFrame, entries: DataFrame) -> DataFrame:
    """Every run with each entry of its month; two runs of one month both get
    all of its entries.

    ``runs`` should be a stored table, as everywhere here: Spark then knows
    how small it is and broadcasts it, where an unknown size would make it
    shuffle the entries by month.
    """
    keys = runs.select(
        F.col("id").alias("payroll_run_id"),
        F.col("period_year").alias("work_year"),
        F.col("period_month").alias("work_month"),
    )
    return entries.join(keys, ["work_year", "work_month"])


def hours_by_employee(
    entries: DataFrame,
    employees: DataFrame,
    runs: DataFrame,
    id_range: tuple[int, int] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Total hours of each employee in each run, with the hourly rate. With
    ``strict``, hours of an employee who is not known raise; else they drop out.

    Entries are summed by employee and month before anything is joined, so
    the only rows to cross the network are partial sums: a busy employee does
    not make a hot task, and several runs of one month share one sum.
    """
    if id_range is not None:
        entries = entries.filter(in_id_range(F.col("employee_id"), *id_range))
    rates = employees.select(F.col("id").alias("employee_id"), "hourly_rate")
    totals = _month_totals(entries, runs, "employee_id")
    if not strict:
        return _spread_over_runs(totals.join(rates, "employee_id"), runs)
    unknown = F.concat(F.lit("hours of an unknown employee: "), F.col("employee_id").cast("string"))
    rated = totals.join(rates, "employee_id", "left").withColumn(
        "hourly_rate", F.coalesce("hourly_rate", F.raise_error(unknown).cast("decimal(10,2)"))
    )
    return _spread_over_runs(rated, runs)


def hours_by_email(rows: DataFrame, employees: DataFrame, runs: DataFrame) -> DataFrame:
    """:func:`hours_by_employee` for rows not resolved yet: they are summed by
    email, and the email is looked up once per sum instead of once per row."""
    lookup = employees.select("email", F.col("id").alias("employee_id"), "hourly_rate")
    return _spread_over_runs(_month_totals(rows, runs, "email").join(lookup, "email"), runs)


def _month_totals(rows: DataFrame, runs: DataFrame, key: str) -> DataFrame:
    months = F.broadcast(run_periods(runs))
    return (
        rows.join(months, ["work_year", "work_month"], "left_semi")
        .groupBy(key, "work_year", "work_month")
        .agg(F.sum("hours_worked").alias("total_hours"))
    )


def _spread_over_runs(totals: DataFrame, runs: DataFrame) -> DataFrame:
    return entries_for_runs(runs, totals).select(
        "payroll_run_id", "employee_id", "hourly_rate", "total_hours"
    )
