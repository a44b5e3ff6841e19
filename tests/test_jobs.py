"""Whole jobs: import, both routes, resume, refusals."""

import os
from dataclasses import replace

import pytest
from pyspark.errors import SparkRuntimeException

import data
from tallyroll.operators import runs as run_ops
from tallyroll.operators.imports import SkipLimitExceededError
from tallyroll.operators.quality import ConstraintViolationError
from tallyroll.plans import monthly
from tallyroll.schemas import SUMMARY_COLUMNS, Params
from tallyroll.sources.tables import load_table


@pytest.fixture
def root(spark, tmp_path):
    data.employees(spark).write.parquet(str(tmp_path / "db" / "employees"))
    return str(tmp_path / "db")


@pytest.fixture
def params(tmp_path):
    return Params(export_dir=str(tmp_path / "exports"))


def summary_lines(params, period):
    """The header and the rows of all parts of a summary, in order."""
    folder = f"{params.export_dir}/payroll-summary-{period}.csv"
    parts = sorted(n for n in os.listdir(folder) if n.startswith("part"))
    texts = [open(f"{folder}/{n}", encoding="utf-8").read().splitlines() for n in parts]
    assert len({t[0] for t in texts}) == 1
    return texts[0][:1] + [line for t in texts for line in t[1:]]


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id bigint")


def states(spark, root):
    current = run_ops.current_runs(load_table(spark, root, "payroll_run_states"))
    return {r.id: (r.status, r.completed_at) for r in current.collect()}


def stored_slips(spark, root, run_id):
    rows = load_table(spark, root, "payslips").filter(f"payroll_run_id = {run_id}").collect()
    return {r.employee_id: tuple(map(str, (r.total_hours, r.gross_pay, r.deductions, r.net_pay))) for r in rows}


def test_import_counts_and_quarantine(spark, root, tmp_path, params):
    path = data.write_csv(tmp_path / "march.csv", data.month_lines())
    counters = monthly.import_timesheets(spark, root, path, 1, data.AT, params)
    assert tuple(counters.first()) == (1, 31, 27, 4, 0, 4, 0)
    entries = load_table(spark, root, "timesheet_entries")
    assert entries.count() == 27
    assert entries.select("source_file", "imported_at").distinct().collect() == [("march.csv", data.AT)]
    rejected = load_table(spark, root, "rejected_timesheet_entries").collect()
    assert sorted((r.raw_line, r.reason) for r in rejected) == data.REJECTED
    assert {r.payroll_run_id for r in rejected} == {1}
    # Nothing recognises the file when it is imported again.
    monthly.import_timesheets(spark, root, path, 2, data.LATER, params)
    assert load_table(spark, root, "timesheet_entries").count() == 54


def nothing_stored(spark, root):
    return all(
        load_table(spark, root, name).count() == 0 for name in ("timesheet_entries", "rejected_timesheet_entries")
    )


def test_failed_imports_leave_nothing(spark, root, tmp_path, params):
    good = data.month_lines()
    over = data.write_csv(tmp_path / "over.csv", good + ["x@x,2027-03-09,8"] * 47)
    with pytest.raises(SkipLimitExceededError, match="51 rejected rows, limit 50"):
        monthly.import_timesheets(spark, root, over, 1, data.AT, params)
    malformed = data.write_csv(tmp_path / "malformed.csv", good + ["x@x,2027-03-09"])
    with pytest.raises(SparkRuntimeException, match="wrong number of fields"):
        monthly.import_timesheets(spark, root, malformed, 1, data.AT, params)
    tiny = data.write_csv(tmp_path / "tiny.csv", good + ["pavel.quispe@example.com,2027-03-09,0.004"])
    with pytest.raises(ValueError, match="employee 5 round to 0.00"):
        monthly.import_timesheets(spark, root, tiny, 1, data.AT, params)
    assert nothing_stored(spark, root)
    limit = data.write_csv(tmp_path / "limit.csv", good + ["x@x,2027-03-09,8"] * 46)
    monthly.import_timesheets(spark, root, limit, 1, data.AT, params)
    assert load_table(spark, root, "rejected_timesheet_entries").count() == 50


def test_malformed_lines_in_quarantine(spark, root, tmp_path, params):
    path = data.write_csv(tmp_path / "m.csv", data.month_lines() + ["x@x,2027-03-09", "a,b,c,d"])
    counters = monthly.import_timesheets(spark, root, path, 1, data.AT, params, malformed="quarantine")
    assert tuple(counters.first()) == (1, 31, 27, 6, 2, 4, 0)
    rejected = load_table(spark, root, "rejected_timesheet_entries").filter("reason like 'wrong number%'")
    assert sorted(r.raw_line for r in rejected.collect()) == ["a,b,c,d", "x@x,2027-03-09"]


def test_shared_email_stops_the_import(spark, root, tmp_path, params):
    data.employees(spark).filter("id = 1").write.mode("append").parquet(f"{root}/employees")
    path = data.write_csv(tmp_path / "t.csv", data.month_lines())
    with pytest.raises(ConstraintViolationError, match="unique_email"):
        monthly.import_timesheets(spark, root, path, 1, data.AT, params)


def test_hold_resume_complete(spark, root, tmp_path, params):
    path = data.write_csv(tmp_path / "t.csv", data.month_lines())
    monthly.create(spark, root, data.requests(spark, (1, 2027, 3)), data.AT)
    routes = monthly.run_monthly(spark, root, ids(spark, 1), data.AT, params, path, import_run_id=1)
    assert tuple(routes.first()) == (1, 1, True, "REVIEW_REQUIRED")
    assert states(spark, root) == {1: ("AWAITING_REVIEW", None)}
    assert stored_slips(spark, root, 1) == {}
    assert not os.path.exists(params.export_dir)

    with pytest.raises(monthly.LaunchRefusedError, match="Unable to launch monthlyPayrollJob for payrollRunId=1"):
        monthly.run_monthly(spark, root, ids(spark, 1), data.LATER, params)

    outcomes = monthly.run_finalize(spark, root, ids(spark, 1, 5), data.LATER, params)
    assert {r.id: r.error for r in outcomes.collect()} == {1: None, 5: "PayrollRun not found: 5"}
    assert states(spark, root) == {1: ("COMPLETED", data.LATER)}
    assert stored_slips(spark, root, 1) == data.GOLDEN
    summary = summary_lines(params, "2027-03")
    assert summary[4] == "4,Noor,Haddad,noor.haddad@example.com,Dispatch,329.00,15216.80,2282.52,12934.28"
    assert len(summary) == 6

    (again,) = monthly.run_finalize(spark, root, ids(spark, 1), data.LATER, params).collect()
    assert again.error == "PayrollRun 1 cannot be resumed: status is COMPLETED, expected AWAITING_REVIEW"


def test_run_of_another_month_proceeds(spark, root, tmp_path, params):
    """The file's month is not the run's: its rows are stored, not paid."""
    path = data.write_csv(tmp_path / "t.csv", data.month_lines())
    monthly.create(spark, root, data.requests(spark, (7, 2031, 6)), data.AT)
    monthly.run_monthly(spark, root, ids(spark, 7), data.AT, params, path, import_run_id=7)
    assert states(spark, root) == {7: ("COMPLETED", data.AT)}
    assert load_table(spark, root, "timesheet_entries").count() == 27
    assert summary_lines(params, "2031-06") == [",".join(SUMMARY_COLUMNS)]


def test_many_runs_in_one_job(spark, root, tmp_path, params):
    lines = [line for line in data.month_lines() if "noor" not in line] + data.month_lines(2027, 4)
    path = data.write_csv(tmp_path / "t.csv", lines)
    monthly.create(spark, root, data.requests(spark, (1, 2027, 3), (2, 2027, 4), (3, 2027, 3)), data.AT)
    routes = monthly.run_monthly(spark, root, ids(spark, 1, 2, 3), data.AT, params, path, import_run_id=1)
    assert {r.payroll_run_id: r.route for r in routes.collect()} == {
        1: "PROCEED", 2: "REVIEW_REQUIRED", 3: "PROCEED",
    }
    expected = {e: slip for e, slip in data.GOLDEN.items() if e != 4}
    assert stored_slips(spark, root, 1) == stored_slips(spark, root, 3) == expected
    assert stored_slips(spark, root, 2) == {}
    # Rows imported while a run waits count when it is resumed.
    more = data.write_csv(tmp_path / "more.csv", ["pavel.quispe@example.com,2027-04-30,2.00"])
    monthly.import_timesheets(spark, root, more, 2, data.LATER, params)
    monthly.run_finalize(spark, root, ids(spark, 2), data.LATER, params)
    assert stored_slips(spark, root, 2)[5][0] == "7.35"
    assert {i: s for i, (s, _) in states(spark, root).items()} == {1: "COMPLETED", 2: "COMPLETED", 3: "COMPLETED"}


def test_thresholds_are_parameters(spark, root, tmp_path, params):
    from decimal import Decimal

    path = data.write_csv(tmp_path / "t.csv", data.month_lines())
    monthly.create(spark, root, data.requests(spark, (1, 2027, 3)), data.AT)
    relaxed = replace(params, anomaly_threshold_hours=Decimal("329"))
    monthly.run_monthly(spark, root, ids(spark, 1), data.AT, relaxed, path, import_run_id=1)
    assert stored_slips(spark, root, 1) == data.GOLDEN


def test_refused_requests(spark, root, params):
    refused = monthly.create(spark, root, data.requests(spark, (1, 2027, 3), (2, 1999, 13)), data.AT)
    assert [(r.id, r.invalid_fields) for r in refused.collect()] == [(2, ["periodMonth", "periodYear"])]
    with pytest.raises(monthly.LaunchRefusedError, match="PayrollRun not found: 2"):
        monthly.run_monthly(spark, root, ids(spark, 1, 2), data.AT, params)
    with pytest.raises(ValueError, match="run its rejects belong to"):
        monthly.run_monthly(spark, root, ids(spark, 1), data.AT, params, csv_path="x.csv")
