"""Constraints of the tables, each as the rows that violate it.

Every report has the columns ``table_name``, ``rule``, ``key`` and
``violations``, so reports can be united.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.schemas import STATUSES, TEXT_LENGTHS

REPORT_COLUMNS = ["table_name", "rule", "key", "violations"]


class ConstraintViolationError(ValueError):
    """A table holds rows its constraints forbid."""


def null_violations(rows: DataFrame, table: str, nullable: tuple[str, ...] = ()) -> DataFrame:
    """Columns that hold nulls and how many, in one pass over the table."""
    required = [name for name in rows.columns if name not in nullable]
    counts = rows.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in required))
    return (
        counts.unpivot([], required, "key", "violations")
        .filter(F.col("violations") > 0)
        .select(F.lit(table).alias("table_name"), F.lit("not_null").alias("rule"), "key", "violations")
    )


def duplicate_emails(employees: DataFrame) -> DataFrame:
    """Emails of more than one employee. Run it before emails are looked up,
    since a shared one would multiply the rows."""
    return (
        employees.groupBy(F.col("email").alias("key"))
        .agg(F.count("*").alias("violations"))
        .filter(F.col("violations") > 1)
        .select(F.lit("employees").alias("table_name"), F.lit("unique_email").alias("rule"), "key", "violations")
    )


def duplicate_ids(rows: DataFrame, table: str) -> DataFrame:
    """Ids of more than one row. A repeated employee would multiply pay."""
    return (
        rows.groupBy(F.col("id").cast("string").alias("key"))
        .agg(F.count("*").alias("violations"))
        .filter(F.col("violations") > 1)
        .select(F.lit(table).alias("table_name"), F.lit("unique_id").alias("rule"), "key", "violations")
    )


def guarded(rows: DataFrame, table: str) -> DataFrame:
    """``rows`` of which one that breaks a rule of its table raises when it is
    written: the checks are part of the writing pass."""
    hours, rate = F.col("hours_worked"), F.col("hourly_rate")
    checks = {
        "timesheet_entries": {"hours_in_range": (hours <= 0) | (hours > 24)},
        "employees": {"hourly_rate_positive": rate <= 0},
        "payroll_run_states": {
            "period_month_in_range": ~F.col("period_month").between(1, 12),
            "status_known": ~F.col("status").isin(*STATUSES),
        },
    }.get(table, {})
    checks |= {f"{name}_length": F.length(F.col(name)) > most for name, most in TEXT_LENGTHS.get(table, {}).items()}
    nullable = {"payroll_run_states": {"completed_at"}}.get(table, set())
    bad = {f"{name} is null": F.col(name).isNull() for name in rows.columns if name not in nullable} | checks
    broken = F.coalesce(*(F.when(rule, F.lit(f"{table}: {name}")) for name, rule in bad.items()))
    first = rows.columns[0]
    kind = rows.schema[first].dataType
    kept = F.when(broken.isNull(), F.col(first)).otherwise(F.raise_error(broken).cast(kind))
    return rows.withColumn(first, kept)


def _row_report(rows: DataFrame, table: str, key: str, rules: dict[str, Column]) -> DataFrame:
    """One report row per row and broken rule."""
    broken = F.array_compact(F.array(*(F.when(bad, F.lit(rule)) for rule, bad in rules.items())))
    return rows.select(
        F.lit(table).alias("table_name"),
        F.explode(broken).alias("rule"),
        F.col(key).cast("string").alias("key"),
        F.lit(1).cast("bigint").alias("violations"),
    )


def rate_violations(employees: DataFrame) -> DataFrame:
    return _row_report(employees, "employees", "id", {"hourly_rate_positive": F.col("hourly_rate") <= 0})


def hours_violations(entries: DataFrame, key: str = "employee_id") -> DataFrame:
    hours = F.col("hours_worked")
    return _row_report(entries, "timesheet_entries", key, {"hours_in_range": (hours <= 0) | (hours > 24)})


def run_check_violations(runs: DataFrame) -> DataFrame:
    return _row_report(
        runs,
        "payroll_runs",
        "id",
        {
            "period_month_in_range": ~F.col("period_month").between(1, 12),
            "status_known": ~F.col("status").isin(*STATUSES),
        },
    )


def length_violations(rows: DataFrame, table: str, key: str) -> DataFrame:
    limits = TEXT_LENGTHS[table]
    rules = {f"{name}_length": F.length(F.col(name)) > limit for name, limit in limits.items()}
    return _row_report(rows, table, key, rules)


def fk_violations(
    child: DataFrame, child_column: str, parent: DataFrame, parent_column: str, table: str, rule: str
) -> DataFrame:
    """Keys without a parent row and how many rows refer to them. Rows are
    counted per key before the join."""
    counted = (
        child.filter(F.col(child_column).isNotNull())
        .groupBy(F.col(child_column).alias("parent_key"))
        .agg(F.count("*").alias("violations"))
    )
    parents = parent.select(F.col(parent_column).alias("parent_key"))
    return counted.join(parents, "parent_key", "left_anti").select(
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule"),
        F.col("parent_key").cast("string").alias("key"),
        "violations",
    )


def fk_report(child: DataFrame, table: str, keys: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """:func:`fk_violations` of several foreign keys of one table, in one scan of it.

    ``keys`` maps each rule to the column, the parent table and the column of the parent. Every row
    is stacked into a row for each rule, which partial sums reduce to the distinct keys before
    anything is shuffled; the parents are stacked likewise and share one anti join.
    """
    stacked = F.array(
        *(F.struct(F.lit(rule).alias("rule"), F.col(column).cast("bigint").alias("parent_key")) for rule, (column, _, _) in keys.items())
    )
    counted = child.select(F.inline(stacked)).filter(F.col("parent_key").isNotNull()).groupBy("rule", "parent_key").agg(F.count("*").alias("violations"))
    parents = [
        parent.select(F.lit(rule).alias("rule"), F.col(column).cast("bigint").alias("parent_key")) for rule, (_, parent, column) in keys.items()
    ]
    missing = counted.join(reduce(DataFrame.unionAll, parents), ["rule", "parent_key"], "left_anti")
    return missing.select(F.lit(table).alias("table_name"), "rule", F.col("parent_key").cast("string").alias("key"), "violations")


def union_reports(*reports: DataFrame) -> DataFrame:
    united = reports[0].select(*REPORT_COLUMNS)
    for report in reports[1:]:
        united = united.unionByName(report.select(*REPORT_COLUMNS))
    return united


def require_clean(report: DataFrame) -> None:
    """Raise when a report is not empty; it stops at the first violation."""
    first = report.select(*REPORT_COLUMNS).head(1)
    if first:
        row = first[0]
        raise ConstraintViolationError(f"{row.table_name}: {row.rule} violated, key {row.key}")
