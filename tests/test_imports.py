"""Validation order, reasons, split, skip limit and counters."""

import pytest

import data
from tallyroll.operators import imports, metrics

INES = "ines.okafor@example.com"


def outcomes(spark, *rows):
    classified = imports.classify(data.raw(spark, *rows), data.employees(spark))
    return {(r.email, r.work_date, r.hours_worked): (r.outcome, r.reason) for r in classified.collect()}


@pytest.mark.parametrize(
    "row, outcome, reason",
    [
        ((INES, "2026-08-03", "8.00"), "ok", None),
        ((INES, "2026-08-03", "24.00"), "ok", None),
        ((INES, "2026-08-03", "0.00"), "out_of_range", "hours_worked must be > 0 and <= 24, was: 0.00"),
        ((INES, "2026-08-03", "-1.00"), "out_of_range", "hours_worked must be > 0 and <= 24, was: -1.00"),
        ((INES, "2026-08-03", "24.01"), "out_of_range", "hours_worked must be > 0 and <= 24, was: 24.01"),
        ((INES, "2026-08-03", "+025"), "out_of_range", "hours_worked must be > 0 and <= 24, was: 25"),
        ((INES, "2026-08-03", "1e2"), "out_of_range", "hours_worked must be > 0 and <= 24, was: 1E+2"),
        ((INES, "2026-08-03", "abc"), "not_a_number", "hours_worked is not a valid number: abc"),
        ((INES, "2026-08-03", ""), "not_a_number", "hours_worked is not a valid number: "),
        ((INES, "not-a-date", "8.00"), "bad_date", "work_date is not a valid ISO date: not-a-date"),
        ((INES, "2026-02-30", "8.00"), "bad_date", "work_date is not a valid ISO date: 2026-02-30"),
        (("who@x", "2026-08-03", "8.00"), "unknown_email", "Unknown employee email: who@x"),
        (("INES.okafor@example.com", "2026-08-03", "8.00"), "unknown_email",
         "Unknown employee email: INES.okafor@example.com"),
        # The first failing check decides.
        (("who@x", "not-a-date", "abc"), "not_a_number", "hours_worked is not a valid number: abc"),
        (("who@x", "not-a-date", "25"), "out_of_range", "hours_worked must be > 0 and <= 24, was: 25"),
        (("who@x", "not-a-date", "8"), "bad_date", "work_date is not a valid ISO date: not-a-date"),
    ],
)
def test_classify(spark, row, outcome, reason):
    assert outcomes(spark, row) == {row: (outcome, reason)}


def test_accepted_paths_agree(spark):
    rows = data.raw(
        spark,
        (INES, "2026-08-03", "8.005"),
        (INES, "2026-08-03", "8.005"),
        (INES, "2026-08-04", "25"),
        ("who@x", "2026-08-04", "5"),
        ("tomasz.lindqvist@example.com", "2026-09-01", "7.5"),
    )
    employees = data.employees(spark)
    columns = ["employee_id", "work_date", "hours_worked", "work_year", "work_month", "payroll_run_id"]
    through_outcome = imports.accepted_entries(imports.classify(rows, employees)).select(*columns)
    direct = imports.import_accepted(rows, employees).select(*columns)
    assert through_outcome.dtypes == direct.dtypes
    assert sorted(map(tuple, through_outcome.collect())) == sorted(map(tuple, direct.collect()))
    assert sorted(str(r.hours_worked) for r in direct.collect()) == ["7.50", "8.01", "8.01"]


def test_reject_record_is_cut(spark):
    rows = data.raw(spark, ("a" * 300, "2026-08-03", "b" * 300), ("", "", ""))
    rejected = imports.rejected_rows(imports.classify(rows, data.employees(spark)))
    got = {(r.raw_line, r.reason, r.payroll_run_id) for r in rejected.collect()}
    text = "hours_worked is not a valid number: "
    line = "a" * 300 + ",2026-08-03," + "b" * 300
    assert got == {(line[:500], (text + "b" * 300)[:255], 7), (",,", text, 7)}


@pytest.mark.parametrize("rejects, exceeded", [(49, False), (50, False), (51, True)])
def test_skip_limit(spark, rejects, exceeded):
    rows = [(INES, "2026-08-03", "8.00")] * 5 + [(INES, "2026-08-03", "0")] * rejects
    classified = imports.classify(data.raw(spark, *rows), data.employees(spark))
    (report,) = imports.skip_limit_report(classified, 50).collect()
    assert (report.rejected, report.exceeded) == (rejects, exceeded)
    if exceeded:
        with pytest.raises(imports.SkipLimitExceededError, match="51 rejected rows, limit 50"):
            imports.enforce_skip_limit(classified, 50)
    else:
        imports.enforce_skip_limit(classified, 50)


def test_sub_cent_hours_are_found(spark):
    rows = data.raw(spark, (INES, "2026-08-03", "0.004"), (INES, "2026-08-03", "0.005"))
    entries = imports.import_accepted(rows, data.employees(spark))
    assert imports.sub_cent_entries(entries).count() == 1


def test_unknown_emails_are_counted(spark):
    rows = data.raw(spark, ("x@x", "", ""), ("x@x", "", ""), (INES, "", ""), ("y@x", "", ""))
    got = imports.unknown_emails(rows, data.employees(spark)).collect()
    assert sorted(map(tuple, got)) == [("x@x", 2), ("y@x", 1)]


def test_metrics_and_report(spark):
    lines = [tuple(line.split(",")) for line in data.month_lines()]
    classified = imports.classify(data.raw(spark, *lines), data.employees(spark))
    (row,) = metrics.import_metrics(classified).collect()
    assert tuple(row) == (7, 31, 27, 4, 0, 4, 0)
    report = metrics.reject_report(imports.rejected_rows(classified))
    assert sorted(map(tuple, report.collect())) == [
        (7, "bad_date", 1), (7, "not_a_number", 1), (7, "out_of_range", 1), (7, "unknown_email", 1),
    ]


def test_generated_code_stays_small_enough_to_compile(spark, tmp_path):
    """The JVM leaves methods above 8000 bytes uncompiled."""
    import re

    data.raw(spark, (INES, "2026-08-03", "8.00")).write.parquet(str(tmp_path / "raw"))
    data.employees(spark).write.parquet(str(tmp_path / "employees"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    classified = imports.classify(raw, spark.read.parquet(str(tmp_path / "employees")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = classified._jdf.queryExecution().executedPlan()
        debug = spark._jvm.org.apache.spark.sql.execution.debug.package
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(map(int, sizes)) < 8000
