"""Writing of entries, rejects, payslips, run states and summaries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.functions.periods import period_key
from tallyroll.operators.payslips import as_stored, with_employee_columns
from tallyroll.operators.quality import duplicate_emails, duplicate_ids, guarded, require_clean
from tallyroll.operators.runs import after_log, current_runs
from tallyroll.schemas import LOOKUP_COLUMNS, REJECTED_ENTRIES, SUMMARY_COLUMNS, TABLES
from tallyroll.sources.manifest import SEGMENT, Commit
from tallyroll.sources.storage import list_names, remove, replace_path, write_text
from tallyroll.sources.tables import load_table, read_segments, table_path


#: Bytes of a row group in tables whose rows are looked up: a lookup reads whole row groups.
LOOKUP_GROUP_BYTES = 16 << 20


def write_employees(employees: DataFrame, root: str) -> None:
    """Replace the employees. Repeated ids or emails raise before anything is published.

    Rows are dealt by ranges of the id, so a file holds few ids and their order in it
    is theirs: see :func:`tables.find`.
    """
    commit = Commit(employees.sparkSession, root)
    _add(commit, "employees", employees.repartitionByRange("id"))
    stored = written(commit, "employees")
    require_clean(duplicate_ids(stored, "employees"))
    require_clean(duplicate_emails(stored))
    commit.retire("employees", commit.base.of("employees"))
    commit.publish(unchanged=("employees",))


def write_entries(entries: DataFrame, root: str) -> None:
    """Append accepted entries by month. Importing a file twice counts its
    hours twice, so nothing is de-duplicated."""
    commit = Commit(entries.sparkSession, root)
    add_entries(commit, entries)
    commit.publish()


def write_rejected(rejected: DataFrame, root: str) -> None:
    """Append rejected rows to the quarantine of their run."""
    commit = Commit(rejected.sparkSession, root)
    add_rejected(commit, rejected)
    commit.publish()


def write_payslips(payslips: DataFrame, root: str, runs: DataFrame | None = None) -> None:
    """Write the payslips of some runs, replacing those of the same runs only:
    a repeated job leaves one payslip per run and employee.

    ``runs`` (column ``id``) are all runs that were calculated. Those of them
    that have no payslips now keep none from before.
    """
    commit = Commit(payslips.sparkSession, root)
    add_payslips(commit, payslips, runs)
    commit.publish()


def append_run_state(states: DataFrame, root: str) -> None:
    """Append status changes to the log that stands for the run table. Each
    change comes after those its run has in the log."""
    commit = Commit(states.sparkSession, root)
    add_run_states(commit, states)
    commit.publish()


def add_entries(commit: Commit, entries: DataFrame) -> None:
    """Entries and their sums by employee and month, from which runs are paid."""
    _add(commit, "timesheet_entries", entries)
    keys = ["employee_id", "work_year", "work_month"]
    sums = written(commit, "timesheet_entries").groupBy(*keys).agg(F.sum("hours_worked").cast("decimal(14,2)").alias("hours_worked"))
    _add(commit, "month_sums", sums)


def add_rejected(commit: Commit, rejected: DataFrame) -> None:
    _add(commit, "rejected_timesheet_entries", rejected.select(*REJECTED_ENTRIES.fieldNames()))


def add_payslips(commit: Commit, payslips: DataFrame, runs: DataFrame | None = None) -> None:
    _add(commit, "payslips", as_stored(payslips))
    calculated = written(commit, "payslips").select("payroll_run_id")
    if runs is not None:
        calculated = calculated.unionByName(runs.select(F.col("id").alias("payroll_run_id")))
    _add(commit, "payslip_runs", calculated.distinct())


def add_run_states(commit: Commit, states: DataFrame) -> None:
    name = "payroll_run_states"
    if commit.base.of(name) or list_names(commit.spark, table_path(commit.root, name)):
        states = after_log(states, load_table(commit.spark, commit.root, name))
    _add(commit, name, states)


def compact_run_states(spark: SparkSession, root: str) -> None:
    """Put the log so far into one segment with a row for each run: its last status, first start and last completion.

    Readers then read this snapshot and what was appended later. The rows it stands for
    stay in their folders until ``manifest.vacuum`` deletes them.
    """
    commit = Commit(spark, root)
    log = read_segments(spark, root, "payroll_run_states", commit.base.of("payroll_run_states"))
    latest = log.groupBy("id").agg(F.max("seq").alias("seq"))
    _add(commit, "payroll_run_states", current_runs(log, known_statuses=True).join(latest, "id"))
    commit.retire("payroll_run_states", commit.base.of("payroll_run_states"))
    commit.publish()


def written(commit: Commit, name: str) -> DataFrame:
    """The rows that a commit has written to a table and not published yet."""
    return read_segments(commit.spark, commit.root, name, [commit.segment]).drop(SEGMENT)


def _add(commit: Commit, name: str, df: DataFrame) -> None:
    """Write in the stored layout. The rebalance gathers each partition value
    into files of a sensible size and splits a value that holds much of the
    data, where a plain shuffle on it would leave it to one task."""
    schema, partition_by = TABLES[name]
    df = guarded(df, name).select(*schema.fieldNames())
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df, keys = commit.tag(df), LOOKUP_COLUMNS.get(name, [])
    if keys:
        df = df.sortWithinPartitions(*partition_by, SEGMENT, keys[0])
    writer = df.write.mode("append").partitionBy(*partition_by, SEGMENT).options(**_lookup_options(keys))
    writer.parquet(table_path(commit.root, name))
    commit.added(name)


def _lookup_options(keys: list[str]) -> dict[str, str]:
    if not keys:
        return {}
    # Adaptive filters are sized by the distinct values of their row group.
    options = {"parquet.block.size": str(LOOKUP_GROUP_BYTES), "parquet.bloom.filter.adaptive.enabled": "true"}
    return options | {f"parquet.bloom.filter.enabled#{key}": "true" for key in keys}


def export_summary(
    spark: SparkSession,
    payslips: DataFrame,
    employees: DataFrame,
    runs: DataFrame,
    folder: str,
    single_file: bool = False,
) -> list[str]:
    """Write ``payroll-summary-<yyyy-MM>.csv`` for the period of each run.

    Each is a folder of part files, which read in the order of their names give
    the employees in order; each part has the header. ``single_file`` makes each
    a plain file instead, written by one task. A run without payslips gets the
    header alone. Of several runs of one period the one with the highest id
    stays, as if they had been exported one after the other.

    The files are written beside their targets, so a move never leaves the
    filesystem, and a target is replaced as a whole.
    """
    exported = (
        runs.groupBy("period_year", "period_month")
        .agg(F.max("id").alias("payroll_run_id"))
        .select(
            "payroll_run_id",
            period_key(F.col("period_year"), F.col("period_month")).alias("period"),
        )
    )
    # Twelve a year: only the names of the periods pass through the driver.
    periods = [period for (period,) in exported.select("period").orderBy("period").collect()]
    if not periods:
        return []
    chosen = with_employee_columns(payslips.join(exported, "payroll_run_id"), employees)
    rows = chosen.select("period", *SUMMARY_COLUMNS)
    dealt = rows.repartition("period") if single_file else rows.repartitionByRange("period", "employee_id")
    staging = f"{folder.rstrip('/')}/.staging-{uuid.uuid4().hex}"
    try:
        (
            dealt.sortWithinPartitions("period", "employee_id")
            .write.partitionBy("period")
            .option("header", True)
            .csv(f"{staging}/files")
        )
        return _promote(spark, periods, staging, folder, single_file)
    finally:
        remove(spark, staging)


def _promote(
    spark: SparkSession, periods: list[str], staging: str, folder: str, single_file: bool
) -> list[str]:
    """Give the staged files their final names."""
    targets = []
    written = set(list_names(spark, f"{staging}/files"))
    for period in periods:
        target = f"{folder.rstrip('/')}/payroll-summary-{period}.csv"
        source = f"{staging}/files/period={period}"
        if f"period={period}" not in written:
            write_text(spark, f"{source}/part-00000.csv", ",".join(SUMMARY_COLUMNS) + "\n")
        replace_path(spark, _only_file(spark, source) if single_file else source, target)
        targets.append(target)
    return targets


def _only_file(spark: SparkSession, folder: str) -> str:
    (name,) = [name for name in list_names(spark, folder) if name.startswith("part-")]
    return f"{folder}/{name}"
