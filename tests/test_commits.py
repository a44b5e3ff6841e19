"""Commits over several tables, and jobs of which a step fails."""

import os
import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import data
from tallyroll.operators import hours as hours_ops
from tallyroll.operators import runs as run_ops
from tallyroll.plans import monthly
from tallyroll.schemas import TABLES, Params
from tallyroll.sources import manifest, sinks
from tallyroll.sources.manifest import Commit, CommitConflictError
from tallyroll.sources.tables import load_month_sums, load_table
from tallyroll.sources.timesheets import with_lineage

STORED = ["timesheet_entries", "month_sums", "rejected_timesheet_entries", "payslips", "payroll_run_states"]


class StepError(RuntimeError):
    pass


@pytest.fixture
def root(spark, tmp_path):
    data.employees(spark).write.parquet(str(tmp_path / "db" / "employees"))
    return str(tmp_path / "db")


@pytest.fixture
def params(tmp_path):
    return Params(export_dir=str(tmp_path / "exports"))


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id bigint")


def content(spark, root):
    """All rows of all tables that jobs write."""
    return {name: sorted(map(str, load_table(spark, root, name).collect())) for name in STORED}


def entries(spark, *rows):
    return with_lineage(data.entries(spark, *rows), data.AT, "a.csv")


def failing(monkeypatch, target, name, when="after", call=1):
    """Make the given call of a function fail, before or after its work."""
    real, calls = getattr(target, name), []

    def step(*args, **kwargs):
        calls.append(1)
        if len(calls) == call and when == "before":
            raise StepError(name)
        result = real(*args, **kwargs)
        if len(calls) == call and when == "after":
            raise StepError(name)
        return result

    monkeypatch.setattr(target, name, step)


def test_uncommitted_segments_are_not_read(spark, root):
    sinks.write_entries(entries(spark, (1, "2027-03-01", "8")), root)
    before = content(spark, root)
    commit = Commit(spark, root)
    sinks.add_entries(commit, entries(spark, (2, "2027-03-01", "4")))
    assert content(spark, root) == before
    assert sinks.written(commit, "timesheet_entries").count() == 1
    commit.publish()
    assert load_table(spark, root, "timesheet_entries").count() == 2


def test_a_first_commit_that_fails_leaves_empty_tables(spark, root):
    sinks.add_entries(Commit(spark, root), entries(spark, (2, "2027-03-01", "4")))
    assert all(load_table(spark, root, name).count() == 0 for name in STORED)
    assert load_month_sums(spark, root).count() == 0


def test_commits_at_a_time_both_count(spark, root):
    one, other = Commit(spark, root), Commit(spark, root)
    sinks.add_entries(one, entries(spark, (1, "2027-03-01", "8")))
    sinks.add_entries(other, entries(spark, (2, "2027-03-01", "4")))
    other.publish()
    assert one.publish().version == 2
    assert load_table(spark, root, "timesheet_entries").count() == 2


def test_a_decision_on_old_state_is_refused(spark, root):
    commit = Commit(spark, root)
    sinks.append_run_state(run_ops.create_runs(data.requests(spark, (1, 2027, 3)), data.AT), root)
    commit.done("job", 1, "phase", "token")
    with pytest.raises(CommitConflictError, match="payroll_run_states"):
        commit.publish(unchanged=("payroll_run_states",))
    assert manifest.current(spark, root).phase("job", 1, "phase") is None


def test_manifest_numbers_are_taken_once(spark, root):
    from tallyroll.sources.storage import publish_text, read_text

    assert publish_text(spark, f"{root}/x.json", "first")
    assert not publish_text(spark, f"{root}/x.json", "second")
    assert read_text(spark, f"{root}/x.json") == "first"
    assert [n for n in os.listdir(root) if "x.json" in n and not n.endswith(".crc")] == ["x.json"]


def test_vacuum_deletes_what_readers_do_not_see(spark, root):
    sinks.write_entries(entries(spark, (1, "2027-03-01", "8")), root)
    sinks.add_entries(Commit(spark, root), entries(spark, (2, "2027-03-01", "4")))
    before = content(spark, root)
    deleted = manifest.vacuum(spark, root, {name: columns for name, (_, columns) in TABLES.items() if name != "employees"})
    assert len(deleted) == 2 and not any(os.path.exists(f) for f in deleted)
    assert content(spark, root) == before


@pytest.mark.parametrize("step", ["add_rejected", "add_entries"])
def test_a_failed_import_leaves_the_old_state_and_its_repeat_counts_once(spark, root, tmp_path, params, monkeypatch, step):
    path = data.write_csv(tmp_path / "march.csv", data.month_lines())
    monthly.import_timesheets(spark, root, path, 1, data.AT, params)
    before = content(spark, root)
    with monkeypatch.context() as patch:
        failing(patch, sinks, step)
        with pytest.raises(StepError):
            monthly.import_timesheets(spark, root, path, 1, data.LATER, params)
    assert content(spark, root) == before
    monthly.import_timesheets(spark, root, path, 1, data.LATER, params)
    assert load_table(spark, root, "timesheet_entries").count() == 54
    assert load_table(spark, root, "rejected_timesheet_entries").count() == 8


MONTHLY_STEPS = [("add_entries", "after"), ("add_payslips", "before"), ("export_summary", "after"), ("add_run_states", "after")]


@pytest.mark.parametrize("step, when", MONTHLY_STEPS)
def test_a_monthly_job_that_failed_is_repeated(spark, root, tmp_path, params, monkeypatch, step, when):
    """Run 1 is held, run 2 is paid, whichever step failed before."""
    path = data.write_csv(tmp_path / "t.csv", data.month_lines() + [f"{data.email('Ines', 'Okafor')},2027-04-01,8.00"])
    monthly.create(spark, root, data.requests(spark, (1, 2027, 3), (2, 2027, 4)), data.AT)
    job = lambda: monthly.run_monthly(spark, root, ids(spark, 1, 2), data.AT, params, path, import_run_id=1)
    with monkeypatch.context() as patch:
        failing(patch, sinks, step, when)
        with pytest.raises(StepError):
            job()
    assert load_table(spark, root, "payslips").count() == 0
    assert {r.route for r in job().collect()} == {"REVIEW_REQUIRED", "PROCEED"}
    assert load_table(spark, root, "timesheet_entries").count() == 28
    current = run_ops.current_runs(load_table(spark, root, "payroll_run_states")).collect()
    assert {r.id: r.status for r in current} == {1: "AWAITING_REVIEW", 2: "COMPLETED"}
    assert [(r.payroll_run_id, str(r.total_hours)) for r in load_table(spark, root, "payslips").collect()] == [(2, "8.00")]


@pytest.mark.parametrize("step, when", MONTHLY_STEPS[1:])
def test_a_finalise_that_failed_is_repeated(spark, root, tmp_path, params, monkeypatch, step, when):
    path = data.write_csv(tmp_path / "t.csv", data.month_lines())
    monthly.create(spark, root, data.requests(spark, (1, 2027, 3)), data.AT)
    monthly.run_monthly(spark, root, ids(spark, 1), data.AT, params, path, import_run_id=1)
    before = content(spark, root)
    with monkeypatch.context() as patch:
        failing(patch, sinks, step, when)
        with pytest.raises(StepError):
            monthly.run_finalize(spark, root, ids(spark, 1), data.LATER, params)
    assert content(spark, root) == before
    (outcome,) = monthly.run_finalize(spark, root, ids(spark, 1), data.LATER, params).collect()
    assert outcome.error is None
    slips = {r.employee_id: str(r.net_pay) for r in load_table(spark, root, "payslips").collect()}
    assert slips == {i: net for i, (*_, net) in data.GOLDEN.items()}
    log = load_table(spark, root, "payroll_run_states").orderBy("seq").collect()
    assert [r.status for r in log] == ["STARTED", "AWAITING_REVIEW", "STARTED", "COMPLETED"]


def test_other_files_for_a_run_that_has_imported_are_refused(spark, root, tmp_path, params, monkeypatch):
    monthly.create(spark, root, data.requests(spark, (1, 2027, 3)), data.AT)
    with monkeypatch.context() as patch:
        failing(patch, sinks, "export_summary")
        with pytest.raises(StepError):
            path = data.write_csv(tmp_path / "t.csv", data.month_lines())
            relaxed = Params(export_dir=params.export_dir, anomaly_threshold_hours=Decimal("400"))
            monthly.run_monthly(spark, root, ids(spark, 1), data.AT, relaxed, path, import_run_id=1)
    other = data.write_csv(tmp_path / "other.csv", data.month_lines())
    with pytest.raises(monthly.LaunchRefusedError, match="imported other files"):
        monthly.run_monthly(spark, root, ids(spark, 1), data.AT, params, other, import_run_id=1)
    with pytest.raises(monthly.LaunchRefusedError, match="PayrollRun not found: 9"):
        monthly.run_monthly(spark, root, ids(spark, 1), data.AT, params, path, import_run_id=9)


def test_month_sums_equal_a_sum_of_all_entries(spark, root, tmp_path, params):
    """After late imports, and with entries that no sink has written."""
    runs = data.runs(spark, (1, 2027, 3), (2, 2027, 4), (3, 2027, 3))
    employees = data.employees(spark)

    def figures(rows):
        hours = hours_ops.hours_by_employee(rows, employees, runs)
        return sorted((r.payroll_run_id, r.employee_id, str(r.total_hours)) for r in hours.collect())

    for lines in (data.month_lines(), data.month_lines(2027, 4), [f"{data.email('Pavel', 'Quispe')},2027-03-30,1.25"]):
        path = data.write_csv(tmp_path / "t.csv", lines)
        monthly.import_timesheets(spark, root, path, 1, data.AT, params)
        assert figures(load_month_sums(spark, root)) == figures(load_table(spark, root, "timesheet_entries"))
    commit = Commit(spark, root)
    sinks._add(commit, "timesheet_entries", entries(spark, (2, "2027-04-30", "2.50")))
    commit.publish()
    assert figures(load_month_sums(spark, root)) == figures(load_table(spark, root, "timesheet_entries"))


def test_pay_does_not_scan_entries(spark, root):
    sinks.write_entries(entries(spark, (1, "2027-03-01", "8")), root)
    files = load_month_sums(spark, root).inputFiles()
    assert files and all("/month_sums/" in f for f in files)


def test_staged_rows_are_read_once_by_each_write(spark, root, tmp_path, params, monkeypatch):
    """Limits and counters come from the pass that stages them."""
    reads = []
    real = monthly.stage
    monkeypatch.setattr(monthly, "stage", lambda df, *a, **k: reads.append(df) or real(df, *a, **k))
    path = data.write_csv(tmp_path / "t.csv", data.month_lines())
    counters = monthly.import_timesheets(spark, root, path, 1, data.AT, params)
    assert tuple(counters.first()) == (1, 31, 27, 4, 0, 4, 0)
    assert len(reads) == 1 and "CollectMetrics" in reads[0]._jdf.queryExecution().optimizedPlan().toString()
    empty = data.write_csv(tmp_path / "e.csv", [])
    assert tuple(monthly.import_timesheets(spark, root, empty, 1, data.AT, params).first()) == (1, 0, 0, 0, 0, 0, 0)


def test_rows_that_break_a_rule_of_the_state_log_are_not_written(spark, root):
    good = run_ops.create_runs(data.requests(spark, (1, 2027, 3)), data.AT)
    for column, value, rule in (("status", F.lit("PAUSED"), "status_known"), ("period_month", F.lit(13), "period_month_in_range"), ("id", F.lit(None).cast("long"), "id is null")):
        with pytest.raises(Exception, match=rule):
            sinks.append_run_state(good.withColumn(column, value), root)
    long_name = with_lineage(data.entries(spark, (1, "2027-03-01", "8")), data.AT, "f" * 256)
    with pytest.raises(Exception, match="source_file_length"):
        sinks.write_entries(long_name, root)
    assert all(load_table(spark, root, name).count() == 0 for name in STORED)


def test_snapshot_and_tail_equal_the_whole_log(spark, root):
    """After any order of appends and compactions."""
    rng, whole, at = random.Random(3), None, data.AT
    for step in range(6):
        at += timedelta(minutes=rng.choice([-7, 1, 5]))
        known = [] if whole is None else [r.id for r in run_ops.current_runs(whole).collect()]
        if not known or rng.random() < 0.4:
            new = run_ops.create_runs(data.requests(spark, (100 + step, 2027, 3), (200 + step, 2027, 4)), at)
        else:
            chosen = run_ops.current_runs(whole).filter(F.col("id").isin(rng.sample(known, k=min(2, len(known)))))
            new = rng.choice([run_ops.hold_runs, run_ops.complete_runs])(chosen, at)
        new = spark.createDataFrame(run_ops.after_log(new, load_table(spark, root, "payroll_run_states")).collect(), new.schema)
        sinks.append_run_state(new, root)
        whole = new if whole is None else whole.unionByName(new)
        if rng.random() < 0.5:
            sinks.compact_run_states(spark, root)
            log = load_table(spark, root, "payroll_run_states")
            assert log.count() == log.select("id").distinct().count()
        got = run_ops.current_runs(load_table(spark, root, "payroll_run_states"), known_statuses=True)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, run_ops.current_runs(whole).collect()))


def test_changes_of_one_run_keep_their_order_behind_an_earlier_log(spark):
    runs = data.runs(spark, (1, 2027, 3), (2, 2027, 3))
    log = run_ops.hold_runs(runs.filter("id = 1"), data.LATER)
    new = run_ops.changed_state(runs, "STARTED", data.AT, run_ops.RESUME).unionByName(run_ops.complete_runs(runs, data.AT))
    placed = run_ops.after_log(new, log).orderBy("id", "seq").collect()
    assert [(r.id, r.status) for r in placed] == [(i, s) for i in (1, 2) for s in ("STARTED", "COMPLETED")]
    assert placed[0].seq == log.first().seq + 1
