"""CSV scan, table scans and the generator."""

from datetime import date

import pytest
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import functions as F

import data
from tallyroll.operators import hours
from tallyroll.operators.imports import import_accepted
from tallyroll.schemas import TABLES
from tallyroll.sources import tables, timesheets


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def read(spark, path, **options):
    return rows(timesheets.read_timesheets(spark, path, **options).select(*timesheets.RAW_FIELDS))


def test_header_comments_quotes_and_blanks(spark, tmp_path):
    path = data.write_csv(
        tmp_path / "t.csv",
        [" a@x ,\t2026-08-03 ,8.00", "# a comment", '"b,c@x",2026-08-03,"7.5"', ",,"],
        header="anything,at,all",
    )
    assert read(spark, path) == [
        ("", "", ""),
        ("a@x", "2026-08-03", "8.00"),
        ("b,c@x", "2026-08-03", "7.5"),
    ]


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        timesheets.read_timesheets(spark, str(tmp_path / "none.csv"))


@pytest.mark.parametrize("line", ["b@x,2026-08-03", "b@x,2026-08-03,8,9", "b@x"])
@pytest.mark.parametrize("columns", [["email"], ["hours_worked"], ["source_file"]])
def test_malformed_line_fails_whatever_is_read(spark, tmp_path, line, columns):
    path = data.write_csv(tmp_path / "t.csv", ["a@x,2026-08-03,8.00", line])
    rows_read = timesheets.read_timesheets(spark, path)
    with pytest.raises(SparkRuntimeException, match="wrong number of fields"):
        rows_read.select(*columns).collect()
    with pytest.raises(SparkRuntimeException, match="wrong number of fields"):
        rows_read.count()


def test_malformed_line_fails_the_accepted_rows_too(spark, tmp_path):
    path = data.write_csv(tmp_path / "t.csv", ["a@x,2026-08-03,8.00", "b@x"])
    with pytest.raises(SparkRuntimeException, match="wrong number of fields"):
        import_accepted(timesheets.read_timesheets(spark, path), data.employees(spark)).collect()


def test_malformed_lines_can_be_set_aside(spark, tmp_path):
    long_line = "x" * 600
    path = data.write_csv(tmp_path / "t.csv", ["a@x,2026-08-03,8.00", "b@x,2026-08-03", long_line])
    assert read(spark, path, malformed="quarantine") == [("a@x", "2026-08-03", "8.00")]
    lines = timesheets.malformed_lines(timesheets.scan_timesheets(spark, path))
    assert [r.raw_line for r in lines.orderBy("raw_line").collect()] == ["b@x,2026-08-03", "x" * 500]
    assert lines.select("raw_line").count() == 2


def test_blank_lines(spark, tmp_path):
    path = data.write_csv(tmp_path / "t.csv", ["a@x,2026-08-03,8.00", "", "b@x,2026-08-03,8.00"])
    assert len(read(spark, path)) == 2
    with pytest.raises(timesheets.MalformedTimesheetError, match="blank line"):
        timesheets.read_timesheets(spark, path, check_blank_lines=True)


def test_unknown_malformed_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        timesheets.read_timesheets(spark, str(tmp_path), malformed="ignore")


def test_lineage(spark, tmp_path):
    path = data.write_csv(tmp_path / "august.csv", ["a@x,2026-08-03,8.00"])
    traced = timesheets.with_lineage(timesheets.read_timesheets(spark, path), data.AT)
    (row,) = traced.collect()
    assert (row.source_file, row.imported_at) == ("august.csv", data.AT)


def test_tables_are_empty_before_the_first_write(spark, tmp_path):
    for name, (schema, _) in TABLES.items():
        table = tables.load_table(spark, str(tmp_path), name)
        assert table.count() == 0
        assert table.dtypes == spark.createDataFrame([], schema).dtypes
    with pytest.raises(KeyError):
        tables.table_path(str(tmp_path), "nothing")


def test_jdbc_options_split_the_scan_by_id():
    options = tables.jdbc_options("jdbc:postgresql://host/db", "payslips", 1, 1000, 16)
    assert options["partitionColumn"] == "employee_id"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("1", "1000", "16")


def test_entries_of_a_database_can_be_summed(spark):
    database = spark.createDataFrame(
        [(1, 1, date(2026, 8, 3), 8.0), (2, 1, date(2026, 8, 4), 7.5), (3, 1, date(2026, 9, 1), 6.0)],
        "id bigint, employee_id bigint, work_date date, hours_worked double",
    )
    entries = tables.declared(database, "timesheet_entries")
    assert {"work_year", "work_month"} <= set(entries.columns)
    assert dict(entries.dtypes)["hours_worked"] == "decimal(4,2)"
    runs = spark.createDataFrame([(1, 8, 2026)], "id bigint, period_month int, period_year int")
    found = hours.entries_for_runs(runs, entries)
    assert rows(found.select("work_date")) == [(date(2026, 8, 3),), (date(2026, 8, 4),)]
