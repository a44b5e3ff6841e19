"""Review flags and routes, run requests, states, lookup, pages, guard."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import data
from tallyroll.operators import hours as hours_ops
from tallyroll.operators import review
from tallyroll.operators import runs as run_ops
from tallyroll.plans import monthly
from tallyroll.schemas import PAYROLL_RUNS, RUN_STATES
from tallyroll.sources import sinks
from tallyroll.sources.tables import load_table

HOURS = "payroll_run_id bigint, employee_id bigint, hourly_rate decimal(10,2), total_hours decimal(14,2)"


def hours(spark, *rows):
    return spark.createDataFrame([(r, e, Decimal("40"), Decimal(h)) for r, e, h in rows], HOURS)


def test_anomaly_is_strictly_above_the_threshold(spark):
    found = review.anomalies(hours(spark, (1, 1, "300.00"), (1, 2, "300.01")), Decimal("300"))
    assert [r.employee_id for r in found.collect()] == [2]


def test_flags_routes_and_release(spark):
    runs = data.runs(spark, (1, 2026, 8), (2, 2026, 9), (3, 2031, 6))
    worked = hours(spark, (1, 1, "40"), (1, 4, "312"), (2, 1, "40"), (2, 2, "300"))
    flags = review.review_flags(runs, worked, Decimal("300"))
    assert sorted(map(tuple, flags.collect())) == [(1, 1, True), (2, 0, False), (3, 0, False)]
    routes = review.route(flags)
    assert {r.payroll_run_id: r.route for r in routes.collect()} == {
        1: "REVIEW_REQUIRED", 2: "PROCEED", 3: "PROCEED",
    }
    # One anomalous employee holds back all of the run.
    released = review.release(worked, routes).collect()
    assert sorted((r.payroll_run_id, r.employee_id) for r in released) == [(2, 1), (2, 2)]


@pytest.mark.parametrize("flag, way", [(True, "REVIEW_REQUIRED"), (False, "PROCEED"), (None, "PROCEED")])
def test_route_of_a_flag(spark, flag, way):
    flags = spark.createDataFrame([(1, flag)], "payroll_run_id bigint, has_anomalies boolean")
    assert review.route(flags).first().route == way


def test_request_validation(spark):
    requests = spark.createDataFrame(
        [(1, 1, 2000), (2, 12, 2031), (3, 0, 2026), (4, 13, 1999), (5, 6, 1999), (6, None, None)],
        "id bigint, period_month int, period_year int",
    )
    checked = run_ops.validate_run_requests(requests)
    assert {r.id: r.invalid_fields for r in checked.collect()} == {
        1: [], 2: [], 3: ["periodMonth"], 4: ["periodMonth", "periodYear"], 5: ["periodYear"],
        6: ["periodMonth", "periodYear"],
    }
    created = run_ops.create_runs(requests, data.AT)
    assert sorted((r.id, r.status, r.started_at) for r in created.collect()) == [
        (1, "STARTED", data.AT), (2, "STARTED", data.AT),
    ]


def test_current_state_follows_the_log(spark):
    created = run_ops.create_runs(data.requests(spark, (1, 2026, 8), (2, 2026, 8)), data.AT)
    first = run_ops.current_runs(created)
    held = run_ops.hold_runs(first.filter("id = 1"), data.AT)
    done = run_ops.complete_runs(first.filter("id = 2"), data.AT)
    log = created.unionByName(held).unionByName(done)
    assert log.dtypes == spark.createDataFrame([], RUN_STATES).dtypes
    current = run_ops.current_runs(log)
    assert current.dtypes == spark.createDataFrame([], PAYROLL_RUNS).dtypes
    assert sorted(map(tuple, current.collect())) == [
        (1, 8, 2026, "AWAITING_REVIEW", data.AT, None),
        (2, 8, 2026, "COMPLETED", data.AT, data.AT),
    ]
    resumed = run_ops.resumed_states(run_ops.resume(current.select("id").filter("id = 1"), current), data.AT)
    finished = run_ops.complete_runs(current.filter("id = 1"), data.LATER)
    assert run_ops.current_runs(log.unionByName(resumed)).filter("id = 1").first().status == "STARTED"
    last = run_ops.current_runs(log.unionByName(resumed).unionByName(finished)).filter("id = 1").first()
    assert (last.status, last.started_at, last.completed_at) == ("COMPLETED", data.AT, data.LATER)


def test_lookup_and_resume_in_every_status(spark):
    statuses = ["STARTED", "AWAITING_REVIEW", "COMPLETED", "FAILED"]
    runs = spark.createDataFrame(
        [(i, 8, 2026, status, data.AT, None) for i, status in enumerate(statuses)], PAYROLL_RUNS
    )
    requests = spark.createDataFrame([(i,) for i in (0, 1, 1, 2, 3, 99)], "id bigint")
    found = run_ops.lookup_runs(requests, runs)
    assert found.count() == 6
    assert [(r.id, r.error) for r in found.filter("error is not null").collect()] == [
        (99, "PayrollRun not found: 99")
    ]
    outcomes = run_ops.resume(requests, runs)
    text = "PayrollRun {} cannot be resumed: status is {}, expected AWAITING_REVIEW"
    assert sorted((r.id, r.status or "", r.error or "") for r in outcomes.collect()) == [
        (0, "STARTED", text.format(0, "STARTED")),
        (1, "STARTED", ""),
        (1, "STARTED", ""),
        (2, "COMPLETED", text.format(2, "COMPLETED")),
        (3, "FAILED", text.format(3, "FAILED")),
        (99, "", "PayrollRun not found: 99"),
    ]
    assert run_ops.resumed_states(outcomes, data.LATER).count() == 1


def history(spark, count=57):
    start = datetime(2026, 1, 1)
    rows = [
        (i, i % 12 + 1, 2020 + i % 5, "STARTED", start + timedelta(days=i % 10), None) for i in range(count)
    ]
    return spark.createDataFrame(rows, PAYROLL_RUNS).repartition(5), rows


def test_pages_of_the_history(spark):
    runs, rows = history(spark)
    ordered = [r[0] for r in sorted(rows, key=lambda r: (-r[4].timestamp(), r[0]))]
    pages = [[r.id for r in run_ops.run_history_page(runs, page).collect()] for page in range(4)]
    assert pages == [ordered[0:20], ordered[20:40], ordered[40:57], []]
    by_year = [r.id for r in run_ops.run_history_page(runs, 0, 5, "period_year", False).collect()]
    assert by_year == [0, 5, 10, 15, 20]
    with pytest.raises(ValueError):
        run_ops.run_history_page(runs, sort="salary")
    with pytest.raises(ValueError):
        run_ops.run_history_page(runs, page=-1)


@pytest.mark.parametrize("page", [0, 1, 7, 8, 9, 20])
def test_deep_pages_equal_shallow_ones(spark, page):
    runs, _ = history(spark)
    plain = runs.orderBy(F.col("started_at").desc(), "id").collect()[page * 7 : page * 7 + 7]
    got = run_ops.run_history_page(runs, page, 7)
    assert got.columns == runs.columns
    assert got.collect() == plain


@pytest.mark.parametrize("count, size, pages", [(57, 20, 3), (40, 20, 2), (0, 20, 0), (1, 20, 1)])
def test_page_totals(spark, count, size, pages):
    assert tuple(run_ops.page_totals(spark.range(count), size).first()) == (count, pages)


def test_launch_guard(spark):
    runs = data.runs(spark, (1, 2026, 8), (2, 2026, 8))
    monthly = run_ops.launch_requests(runs, run_ops.MONTHLY_JOB)
    finalize = run_ops.launch_requests(runs, run_ops.FINALIZE_JOB)
    executions = monthly.withColumn(
        "status", F.when(F.col("payroll_run_id") == 1, "COMPLETED").otherwise("FAILED")
    )
    free = run_ops.launchable(monthly.unionByName(finalize), executions)
    assert sorted(map(tuple, free.collect())) == [
        ("monthlyPayrollJob", 2, "2026-08"),
        ("payrollFinalizeJob", 1, "2026-08"),
        ("payrollFinalizeJob", 2, "2026-08"),
    ]


def test_an_earlier_clock_does_not_reorder_the_log(spark, tmp_path):
    root, late, early = str(tmp_path), datetime(2026, 9, 1, 3), datetime(2026, 9, 1, 2)
    requests = spark.createDataFrame([(1, 8, 2026)], "id long, period_month int, period_year int")
    assert monthly.create(spark, root, requests, late).count() == 0
    log = load_table(spark, root, "payroll_run_states")
    sinks.append_run_state(run_ops.complete_runs(run_ops.current_runs(log), early), root)
    assert run_ops.current_runs(load_table(spark, root, "payroll_run_states")).first().status == "COMPLETED"


def test_known_and_repeated_ids_are_refused(spark, tmp_path):
    root, at = str(tmp_path), datetime(2026, 9, 1, 3)
    kind = "id long, period_month int, period_year int"
    assert monthly.create(spark, root, spark.createDataFrame([(7, 8, 2026)], kind), at).count() == 0
    again = spark.createDataFrame([(7, 9, 2026), (8, 9, 2026), (9, 1, 2026), (9, 2, 2026), (10, 1, 10000)], kind)
    refused = {(r.id, tuple(r.invalid_fields)) for r in monthly.create(spark, root, again, at).collect()}
    assert refused == {(7, ("id",)), (9, ("id",)), (10, ("periodYear",))}
    runs = {r.id: r.period_month for r in run_ops.current_runs(load_table(spark, root, "payroll_run_states")).collect()}
    assert runs == {7: 8, 8: 9}


def test_an_unknown_status_stays(spark):
    runs = data.runs(spark, (1, 2026, 8), (2, 2026, 8))
    states = run_ops.changed_state(runs, "PAUSED", datetime(2026, 9, 1), run_ops.HOLD)
    assert {r.status for r in run_ops.current_runs(states).collect()} == {"PAUSED"}


def test_nulls_are_the_largest_and_keys_may_be_several(spark):
    day = datetime(2026, 9, 1)
    rows = [(1, 8, 2026, "A", day, None), (2, 8, 2026, "A", day, day), (3, 8, 2025, "B", day, None)]
    kind = "id long, period_month int, period_year int, status string, started_at timestamp_ntz, completed_at timestamp_ntz"
    runs = spark.createDataFrame(rows, kind)
    page = lambda **k: [r.id for r in run_ops.run_history_page(runs, 0, 5, **k).collect()]
    assert page(sort="completed_at") == [1, 3, 2]
    assert page(sort="completed_at", descending=False) == [2, 1, 3]
    assert page(sort=[("status", True), ("id", True)]) == [3, 2, 1]


def test_hours_of_very_many_months_and_of_unknown_employees(spark):
    months = [(i, 1 + i % 12, 2000 + i // 12) for i in range(2400)]
    runs = spark.createDataFrame(months, "id long, period_month int, period_year int")
    entries = runs.selectExpr(
        "1L as employee_id", "period_year as work_year", "period_month as work_month", "8.00bd as hours_worked"
    )
    known = spark.createDataFrame([(1,)], "id long").selectExpr("id", "cast(30 as decimal(10,2)) as hourly_rate")
    assert hours_ops.hours_by_employee(entries, known, runs, strict=True).count() == 2400
    with pytest.raises(Exception, match="unknown employee: 1"):
        hours_ops.hours_by_employee(entries, known.filter("id > 1"), runs, strict=True).collect()
