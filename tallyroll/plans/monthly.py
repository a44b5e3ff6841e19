"""The monthly payroll job and the job that finishes held runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyroll.operators import hours as hours_ops
from tallyroll.operators import imports, metrics, review
from tallyroll.operators import payslips as payslip_ops
from tallyroll.operators import runs as run_ops
from tallyroll.operators.quality import duplicate_emails, duplicate_ids, require_clean
from tallyroll.schemas import AWAITING_REVIEW, COMPLETED, Params
from tallyroll.sources import manifest, sinks
from tallyroll.sources.manifest import Commit
from tallyroll.sources.storage import remove, stage, working_folder
from tallyroll.sources.tables import load_month_sums, load_table
from tallyroll.sources.timesheets import (
    normalise_raw,
    require_no_blank_lines,
    scan_timesheets,
    well_formed,
    with_lineage,
)


#: Name of the import among the phases of a job that manifests keep.
IMPORT_PHASE = "import"


class LaunchRefusedError(ValueError):
    """The job already completed for a requested run, or the run is missing."""


def create(spark: SparkSession, root: str, requests: DataFrame, at: datetime) -> DataFrame:
    """Store a started run for each valid request (id, month, year). Returns
    the requests refused, with the fields out of bounds; a known or repeated
    id is refused too."""
    log = load_table(spark, root, "payroll_run_states")
    checked = stage(run_ops.with_known_ids(requests, log), working_folder(spark, "create"))
    good = checked.filter(F.size("invalid_fields") == 0).drop("invalid_fields")
    sinks.append_run_state(run_ops.create_runs(good, at), root)
    return checked.filter(F.size("invalid_fields") > 0)


def import_timesheets(
    spark: SparkSession,
    root: str,
    csv_path: str | list[str],
    run_id: int,
    at: datetime,
    params: Params = Params(),
    malformed: str = "fail",
    check_blank_lines: bool = False,
    phase_of: str | None = None,
) -> DataFrame:
    """Import files for a run: entries appended, rejects quarantined.

    The classified rows are staged once and counted on the way, so the limits are checked
    before anything is stored; both writes read the staged table and are committed
    together. Nothing is seen of an import that fails. With ``phase_of``, the name of a job, the commit
    notes that the job has imported these files for the run. Returns the import counters.
    """
    if malformed not in ("fail", "quarantine"):
        raise ValueError(f"malformed must be 'fail' or 'quarantine', not {malformed!r}")
    if check_blank_lines:
        require_no_blank_lines(spark, csv_path)
    employees = load_table(spark, root, "employees")
    require_clean(duplicate_emails(employees))
    require_clean(duplicate_ids(employees, "employees"))
    scanned = scan_timesheets(spark, csv_path)
    rows = well_formed(scanned, fail=True) if malformed == "fail" else normalise_raw(scanned)
    classified = imports.classify(rows, employees).withColumn(
        "payroll_run_id", F.lit(run_id).cast("bigint")
    )
    seen = Observation()
    folder = working_folder(spark, "import")
    try:
        counted = classified.observe(seen, *metrics.import_counters(), imports.sub_cent_employee().alias("sub_cent"))
        staged = stage(counted, folder, partition_by=["outcome"])
        counters = dict(seen.get)
        sub_cent = counters.pop("sub_cent")
        imports.check_skip_limit(run_id, counters["items_skipped"], params.skip_limit)
        if sub_cent is not None:
            raise ValueError(f"hours of employee {sub_cent} round to 0.00")
        entries, rejected = imports.split(staged)
        commit = Commit(spark, root)
        sinks.add_rejected(commit, rejected)
        sinks.add_entries(commit, with_lineage(entries, at))
        if phase_of is not None:
            commit.done(phase_of, run_id, IMPORT_PHASE, _files(csv_path))
        commit.publish()
        return spark.createDataFrame([(run_id, *counters.values())], f"payroll_run_id long, {metrics.IMPORT_COUNTERS}")
    finally:
        remove(spark, folder)


def _files(csv_path: str | list[str]) -> str:
    return "\n".join([csv_path] if isinstance(csv_path, str) else sorted(csv_path))


def run_monthly(
    spark: SparkSession,
    root: str,
    requests: DataFrame,
    at: datetime,
    params: Params = Params(),
    csv_path: str | list[str] | None = None,
    import_run_id: int | None = None,
    malformed: str = "fail",
) -> DataFrame:
    """Import, sum hours, route each requested run (column ``id``), then hold
    it for review or pay, export and complete it.

    The file is imported once for all runs; its rejects belong to
    ``import_run_id``. Import and the rest are a commit each, so a job that failed can be repeated as it
    was: it does not import again what it has imported, and no run is held, paid or complete
    unless all are. Returns the routed runs.
    """
    runs = _requested(spark, root, requests)
    _require_launchable(spark, root, requests, runs, run_ops.MONTHLY_JOB)
    if csv_path is not None:
        if import_run_id is None:
            raise ValueError("an import needs the run its rejects belong to")
        _require_known(run_ops.lookup_runs(spark.createDataFrame([(import_run_id,)], "id long"), _current(spark, root)))
        files = manifest.current(spark, root).phase(run_ops.MONTHLY_JOB, import_run_id, IMPORT_PHASE)
        if files is None:
            import_timesheets(spark, root, csv_path, import_run_id, at, params, malformed, phase_of=run_ops.MONTHLY_JOB)
        elif files != _files(csv_path):
            raise LaunchRefusedError(f"payroll run {import_run_id} has imported other files: {files}")

    folder = working_folder(spark, "hours")
    try:
        commit = Commit(spark, root)
        hours = _staged_hours(spark, root, runs, folder)
        flags = review.review_flags(runs, hours, params.anomaly_threshold_hours)
        routes = stage(review.route(flags), working_folder(spark, "routes"))
        held = _runs_in(runs, review.runs_on(routes, review.REVIEW_REQUIRED))
        proceeding = _runs_in(runs, review.runs_on(routes, review.PROCEED))
        states = run_ops.hold_runs(held, at).unionByName(run_ops.complete_runs(proceeding, at))
        _pay(commit, proceeding, review.release(hours, routes), states, at, params)
        return routes
    finally:
        remove(spark, folder)


def run_finalize(
    spark: SparkSession, root: str, requests: DataFrame, at: datetime, params: Params = Params()
) -> DataFrame:
    """Resume requested runs that wait for review: hours are summed again and
    paid, without import or anomaly check. Returns the outcome of each
    request. Resumption, payslips and completion are one commit, so a run waits for review
    until it is paid, and a job that failed can be repeated."""
    commit = Commit(spark, root)
    outcomes = stage(run_ops.resume(requests, _current(spark, root)), working_folder(spark, "resume"))
    folder = working_folder(spark, "hours")
    try:
        resumed = run_ops.resumed_states(outcomes, at)
        runs = resumed.drop("seq")
        if runs.head(1):
            hours = _staged_hours(spark, root, runs, folder)
            states = resumed.unionByName(run_ops.complete_runs(runs, at))
            _pay(commit, runs, hours, states, at, params)
        return outcomes
    finally:
        remove(spark, folder)


def _current(spark: SparkSession, root: str) -> DataFrame:
    return run_ops.current_runs(load_table(spark, root, "payroll_run_states"), known_statuses=True)


def _requested(spark: SparkSession, root: str, requests: DataFrame) -> DataFrame:
    """Current state of the requested runs, staged: later status changes must
    not alter what this job works on."""
    return stage(_runs_in(_current(spark, root), requests, "id"), working_folder(spark, "runs"))


def _runs_in(runs: DataFrame, ids: DataFrame, column: str = "payroll_run_id") -> DataFrame:
    return runs.join(ids.select(F.col(column).alias("id")), "id", "left_semi")


def _require_launchable(
    spark: SparkSession, root: str, requests: DataFrame, runs: DataFrame, job_name: str
) -> None:
    _require_known(run_ops.lookup_runs(requests.select("id"), runs))
    # A held run ends its monthly job as well as a completed one does.
    ended = load_table(spark, root, "payroll_run_states").filter(
        F.col("status").isin(AWAITING_REVIEW, COMPLETED)
    )
    executions = run_ops.launch_requests(ended, job_name).withColumn("status", F.lit(COMPLETED))
    wanted = run_ops.launch_requests(runs, job_name)
    refused = wanted.join(
        run_ops.launchable(wanted, executions), wanted.columns, "left_anti"
    ).head(1)
    if refused:
        raise LaunchRefusedError(
            f"Unable to launch {job_name} for payrollRunId={refused[0].payroll_run_id}"
        )


def _require_known(found: DataFrame) -> None:
    missing = found.filter(F.col("error").isNotNull()).head(1)
    if missing:
        raise LaunchRefusedError(missing[0].error)


def _staged_hours(spark: SparkSession, root: str, runs: DataFrame, folder: str) -> DataFrame:
    """Hours of the runs, from the sums that each import has left, staged: routing and payslips read
    the same figures. The join with the months prunes the scan to theirs."""
    sums = load_month_sums(spark, root)
    employees = load_table(spark, root, "employees")
    require_clean(duplicate_ids(employees, "employees"))
    hours = hours_ops.hours_by_employee(sums, employees, runs, strict=True)
    return stage(hours.withColumn("total_hours", F.col("total_hours").cast("decimal(14,2)")), folder)


def _pay(
    commit: Commit, runs: DataFrame, hours: DataFrame, states: DataFrame, at: datetime, params: Params
) -> None:
    """Payslips, summary and states. Summaries are replaced as a whole before the commit,
    by which payslips and states are seen together."""
    sinks.add_payslips(commit, payslip_ops.payslips(hours, params, at), runs)
    sinks.export_summary(
        commit.spark,
        sinks.written(commit, "payslips"),
        load_table(commit.spark, commit.root, "employees"),
        runs,
        params.export_dir,
    )
    sinks.add_run_states(commit, states)
    # Nothing of what was read may have changed meanwhile: a run must not be paid twice.
    commit.publish(unchanged=("payroll_run_states", "timesheet_entries"))
