"""Stored tables and summary files."""

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

import data
from tallyroll.operators import payslips
from tallyroll.schemas import SUMMARY_COLUMNS
from tallyroll.sources import sinks
from tallyroll.sources.storage import stage, working_folder
from tallyroll.sources.tables import load_table
from tallyroll.sources.timesheets import with_lineage

HOURS = "payroll_run_id bigint, employee_id bigint, hourly_rate decimal(10,2), total_hours decimal(14,2)"


def slips(spark, *rows, at=data.AT):
    hours = spark.createDataFrame([(r, e, Decimal("10"), Decimal(h)) for r, e, h in rows], HOURS)
    return payslips.payslips(hours, generated_at=at)


def test_entries_are_appended_by_month(spark, tmp_path):
    entries = with_lineage(data.entries(spark, (1, "2026-08-03", "8"), (1, "2026-09-03", "7")), data.AT, "a.csv")
    for _ in range(2):
        sinks.write_entries(entries, str(tmp_path))
    stored = load_table(spark, str(tmp_path), "timesheet_entries")
    assert stored.groupBy("work_month").agg(F.sum("hours_worked").cast("int")).orderBy("work_month").collect() == [
        (8, 16), (9, 14),
    ]
    assert os.path.isdir(tmp_path / "timesheet_entries" / "work_year=2026" / "work_month=8")
    one_month = stored.filter("work_year = 2026 and work_month = 8").select("employee_id")
    plan = one_month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(work_year" in plan


def test_hot_month_is_not_left_to_one_task(spark, tmp_path):
    hot = spark.range(0, 200_000, 1, 8).select(
        F.xxhash64("id").alias("employee_id"),
        F.lit("2026-08-03").cast("date").alias("work_date"),
        F.lit(Decimal("8.00")).cast("decimal(4,2)").alias("hours_worked"),
        F.lit(2026).alias("work_year"),
        F.lit(8).alias("work_month"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        sinks.write_entries(with_lineage(hot, data.AT, "a.csv"), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = load_table(spark, str(tmp_path), "timesheet_entries")
    assert stored.count() == 200_000
    assert stored.select(F.input_file_name()).distinct().count() > 1


def test_payslips_of_a_run_are_replaced(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_payslips(slips(spark, (1, 1, "10"), (1, 2, "20"), (2, 1, "30")), root)
    sinks.write_payslips(slips(spark, (1, 1, "11"), at=data.LATER), root)
    stored = load_table(spark, root, "payslips").collect()
    assert sorted((r.payroll_run_id, r.employee_id, str(r.total_hours)) for r in stored) == [
        (1, 1, "11.00"), (2, 1, "30.00"),
    ]


def test_payslip_that_does_not_fit_is_not_stored(spark, tmp_path):
    with pytest.raises(SparkRuntimeException, match="total_hours 10000.00 does not fit"):
        sinks.write_payslips(slips(spark, (1, 1, "10000.00")), str(tmp_path))


def test_staged_rows_survive_a_change_of_their_source(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(3).write.parquet(source)
    staged = stage(spark.read.parquet(source), working_folder(spark, "t"))
    spark.range(5).write.mode("overwrite").parquet(source)
    assert staged.count() == 3


def test_working_folder_lies_in_the_shared_folder(spark):
    folder = working_folder(spark, "t")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != working_folder(spark, "t")


def export(spark, tmp_path, rows, runs, single_file=True):
    stored = stage(payslips.as_stored(slips(spark, *rows)), working_folder(spark, "s"))
    out = str(tmp_path / "exports")
    return out, sinks.export_summary(spark, stored, data.employees(spark), runs, out, single_file)


def lines(path):
    return open(path, encoding="utf-8").read().splitlines()


def test_summary_file(spark, tmp_path):
    runs = data.runs(spark, (1, 2026, 8), (2, 2026, 9))
    out, files = export(spark, tmp_path, [(1, 3, "32"), (1, 1, "40.00"), (2, 5, "18"), (9, 2, "1")], runs)
    assert files == [f"{out}/payroll-summary-2026-08.csv", f"{out}/payroll-summary-2026-09.csv"]
    assert lines(files[0]) == [
        ",".join(SUMMARY_COLUMNS),
        "1,Ines,Okafor,ines.okafor@example.com,Foundry,40.00,400.00,60.00,340.00",
        "3,Yuki,Barros,yuki.barros@example.com,Dispatch,32.00,320.00,48.00,272.00",
    ]
    assert len(lines(files[1])) == 2
    assert sorted(n for n in os.listdir(out) if not n.startswith(".")) == [os.path.basename(f) for f in files]


def test_summary_replaces_the_file_and_may_be_header_only(spark, tmp_path):
    runs = data.runs(spark, (1, 2026, 8))
    _, (first,) = export(spark, tmp_path, [(1, 1, "40")], runs)
    assert len(lines(first)) == 2
    _, (second,) = export(spark, tmp_path, [(2, 1, "40")], runs)
    assert second == first
    assert lines(second) == [",".join(SUMMARY_COLUMNS)]


def test_of_two_runs_of_a_month_the_later_stays(spark, tmp_path):
    runs = data.runs(spark, (1, 2026, 8), (2, 2026, 8))
    _, (path,) = export(spark, tmp_path, [(1, 1, "40"), (2, 2, "41")], runs)
    assert [line.split(",")[0] for line in lines(path)[1:]] == ["2"]


def test_a_summary_is_a_folder_of_ordered_parts(spark, tmp_path):
    """Also with ids far apart: parts follow the rows, not the width of the ids."""
    runs = data.runs(spark, (1, 2026, 8), (2, 2026, 9), (3, 2026, 10))
    rows = [(1, e, "8") for e in (5, 4, 3, 2, 1)] + [(2, 1, "8")]
    out, files = export(spark, tmp_path, rows, runs, single_file=False)
    for path, want in zip(files, (["1", "2", "3", "4", "5"], ["1"], []), strict=True):
        parts = sorted(n for n in os.listdir(path) if n.startswith("part"))
        assert all(lines(f"{path}/{p}")[0] == ",".join(SUMMARY_COLUMNS) for p in parts)
        assert [line.split(",")[0] for p in parts for line in lines(f"{path}/{p}")[1:]] == want
        assert spark.read.csv(path, header=True).count() == len(want)
    _, again = export(spark, tmp_path, [(1, 2, "8")], data.runs(spark, (1, 2026, 8)), single_file=False)
    assert again == files[:1] and spark.read.csv(again[0], header=True).count() == 1
    assert not [n for n in os.listdir(out) if n.startswith(".staging")]


def test_a_rerun_without_payslips_clears_the_run(spark, tmp_path):
    root, runs = str(tmp_path), data.runs(spark, (1, 2026, 8), (2, 2026, 9))
    sinks.write_payslips(slips(spark, (1, 1, "40"), (2, 1, "40")), root, runs)
    sinks.write_payslips(slips(spark, (1, 1, "41")), root, runs)
    assert [(r.payroll_run_id, int(r.total_hours)) for r in load_table(spark, root, "payslips").collect()] == [(1, 41)]


def test_rows_that_break_a_rule_are_not_written(spark, tmp_path):
    good = (1, date(2026, 8, 3), Decimal("8.00"), "f.csv", datetime(2026, 9, 1), 2026, 8)
    kind = "employee_id long, work_date date, hours_worked decimal(4,2), source_file string, imported_at timestamp_ntz, work_year int, work_month int"
    for at, value in ((0, None), (2, Decimal("24.01")), (2, Decimal("0.00")), (3, None)):
        bad = tuple(value if i == at else v for i, v in enumerate(good))
        with pytest.raises(Exception, match="timesheet_entries"):
            sinks.write_entries(spark.createDataFrame([good, bad], kind), str(tmp_path / f"{at}{value}"))
