"""Constraint reports."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import data
from tallyroll.operators import quality


def report(df):
    return sorted((r.table_name, r.rule, r.key, r.violations) for r in df.collect())


def test_clean_tables_have_empty_reports(spark):
    employees = data.employees(spark)
    runs = data.runs(spark, (1, 2026, 8))
    clean = quality.union_reports(
        quality.null_violations(employees, "employees"),
        quality.duplicate_emails(employees),
        quality.rate_violations(employees),
        quality.length_violations(employees, "employees", "id"),
        quality.run_check_violations(runs),
        quality.null_violations(runs, "payroll_runs", nullable=("completed_at",)),
    )
    assert report(clean) == []
    quality.require_clean(clean)


def test_nulls(spark):
    rows = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert report(quality.null_violations(rows, "t")) == [("t", "not_null", "a", 1), ("t", "not_null", "b", 2)]
    assert report(quality.null_violations(rows, "t", nullable=("b",))) == [("t", "not_null", "a", 1)]


def test_duplicate_emails_stop_a_write(spark):
    twice = data.employees(spark).unionByName(data.employees(spark).filter("id < 3"))
    found = quality.duplicate_emails(twice)
    assert [(r[2], r[3]) for r in report(found)] == [
        ("ines.okafor@example.com", 2), ("tomasz.lindqvist@example.com", 2),
    ]
    with pytest.raises(quality.ConstraintViolationError, match="unique_email"):
        quality.require_clean(found)


def test_checks(spark):
    employees = data.employees(spark).withColumn(
        "hourly_rate", F.when(F.col("id") == 2, F.lit(Decimal("0.00"))).otherwise(F.col("hourly_rate"))
    )
    assert report(quality.rate_violations(employees)) == [("employees", "hourly_rate_positive", "2", 1)]
    hours = spark.createDataFrame(
        [(1, Decimal("0.00")), (2, Decimal("24.00")), (3, Decimal("24.01"))], "employee_id bigint, hours_worked decimal(4,2)"
    )
    assert [r[2] for r in report(quality.hours_violations(hours))] == ["1", "3"]
    runs = data.runs(spark, (1, 2026, 8), (2, 2026, 13)).withColumn(
        "status", F.when(F.col("id") == 2, "PAUSED").otherwise(F.col("status"))
    )
    assert [r[1:3] for r in report(quality.run_check_violations(runs))] == [
        ("period_month_in_range", "2"), ("status_known", "2"),
    ]


def test_lengths_are_inclusive(spark):
    rows = spark.createDataFrame(
        [(1, "x" * 500, "y" * 255), (2, "x" * 501, "y" * 256)], "id int, raw_line string, reason string"
    )
    got = report(quality.length_violations(rows, "rejected_timesheet_entries", "id"))
    assert [r[1:3] for r in got] == [("raw_line_length", "2"), ("reason_length", "2")]


def test_foreign_keys(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "employee_id bigint")
    found = quality.fk_violations(child, "employee_id", data.employees(spark), "id", "t", "employee_exists")
    assert report(found) == [("t", "employee_exists", "9", 2)]


def test_several_foreign_keys_take_one_scan(spark, tmp_path):
    kind = "payroll_run_id bigint, employee_id bigint"
    spark.createDataFrame([(1, 1), (1, 9), (7, 9), (7, None), (None, 2)], kind).write.parquet(str(tmp_path / "slips"))
    slips, runs = spark.read.parquet(str(tmp_path / "slips")), data.runs(spark, (1, 2027, 3))
    found = quality.fk_report(
        slips, "payslips", {"run_exists": ("payroll_run_id", runs, "id"), "employee_exists": ("employee_id", data.employees(spark), "id")}
    )
    apart = quality.union_reports(
        quality.fk_violations(slips, "payroll_run_id", runs, "id", "payslips", "run_exists"),
        quality.fk_violations(slips, "employee_id", data.employees(spark), "id", "payslips", "employee_exists"),
    )
    assert report(found) == report(apart) == [("payslips", "employee_exists", "9", 2), ("payslips", "run_exists", "7", 2)]
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
