"""Payroll runs: requests, state changes, lookup, history."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.functions.periods import period_key
from tallyroll.operators.paging import page_of
from tallyroll.schemas import AWAITING_REVIEW, COMPLETED, PAYROLL_RUNS, RUN_STATES, STARTED, STATUSES

# Order of the status changes one job makes at one time.
CREATE, HOLD, RESUME, COMPLETE = 0, 1, 2, 3
MONTHLY_JOB = "monthlyPayrollJob"
FINALIZE_JOB = "payrollFinalizeJob"
SORTABLE = PAYROLL_RUNS.fieldNames()


def validate_run_requests(requests: DataFrame) -> DataFrame:
    """Add ``invalid_fields``: the fields of a request out of bounds."""
    month_bad = ~F.coalesce(F.col("period_month").between(1, 12), F.lit(False))
    year_bad = ~F.coalesce(F.col("period_year").between(2000, 9999), F.lit(False))
    failing = F.array(
        F.when(month_bad, F.lit("periodMonth")),
        F.when(year_bad, F.lit("periodYear")),
    )
    return requests.withColumn("invalid_fields", F.array_compact(failing))


def _seq(at: datetime, change: int) -> Column:
    micros = (at - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    return F.lit(micros * 4 + change).cast("bigint")


def create_runs(requests: DataFrame, at: datetime) -> DataFrame:
    """Started state of each valid request. A period may have several runs;
    the ids are the caller's."""
    valid = validate_run_requests(requests).filter(F.size("invalid_fields") == 0)
    return valid.select(
        _seq(at, CREATE).alias("seq"),
        "id",
        "period_month",
        "period_year",
        F.lit(STARTED).alias("status"),
        F.lit(at).cast("timestamp_ntz").alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"),
    )


def changed_state(runs: DataFrame, status: str, at: datetime, change: int) -> DataFrame:
    """State rows that give each run a new status."""
    completed_at = F.lit(at).cast("timestamp_ntz") if status == COMPLETED else F.col("completed_at")
    return runs.select(
        _seq(at, change).alias("seq"),
        "id",
        "period_month",
        "period_year",
        F.lit(status).alias("status"),
        "started_at",
        completed_at.alias("completed_at"),
    ).select(*RUN_STATES.fieldNames())


def after_log(states: DataFrame, log: DataFrame) -> DataFrame:
    """``states`` with sequence numbers above those their runs have in ``log``,
    whatever the caller's clock says. Several changes of a run keep their order."""
    first = states.groupBy("id").agg(F.min("seq").alias("_first"))
    last = log.join(first.select("id"), "id", "left_semi").groupBy("id").agg(F.max("seq").alias("_last"))
    shift = F.greatest(F.lit(0), F.coalesce(F.col("_last") + 1 - F.col("_first"), F.lit(0)))
    moved = states.join(first, "id", "left").join(last, "id", "left").withColumn("seq", F.col("seq") + shift)
    return moved.select(*RUN_STATES.fieldNames())


def with_known_ids(requests: DataFrame, log: DataFrame) -> DataFrame:
    """Requests validated; ``id`` is among the invalid fields if the log has
    the id already, or several requests share it, or it is null."""
    repeated = requests.groupBy("id").agg((F.count("*") > 1).alias("_repeated"))
    known = log.select("id").distinct().withColumn("_known", F.lit(True))
    checked = validate_run_requests(requests).join(repeated, "id", "left").join(known, "id", "left")
    taken = F.col("id").isNull() | F.coalesce("_repeated", F.lit(False)) | F.coalesce("_known", F.lit(False))
    fields = F.when(taken, F.array_append("invalid_fields", F.lit("id"))).otherwise(F.col("invalid_fields"))
    return checked.withColumn("invalid_fields", fields).drop("_repeated", "_known")


def hold_runs(runs: DataFrame, at: datetime) -> DataFrame:
    return changed_state(runs, AWAITING_REVIEW, at, HOLD)


def complete_runs(runs: DataFrame, at: datetime) -> DataFrame:
    return changed_state(runs, COMPLETED, at, COMPLETE)


def current_runs(states: DataFrame, known_statuses: bool = False) -> DataFrame:
    """The run table: latest status, first start and latest completion.

    One aggregation instead of a window: states are reduced before the
    shuffle, so a run with very many states does not fill a task. The status
    travels as its position in the fixed list, which keeps the aggregation
    buffer numeric; a text that is not in the list is looked up after. The sinks
    store no such text, so readers of stored logs may leave that out by ``known_statuses``.
    """
    known = F.array(*map(F.lit, STATUSES))
    code = F.array_position(known, F.col("status")).cast("int")
    latest = (
        states.withColumn("code", code)
        .groupBy("id")
        .agg(
            F.max_by("period_month", "seq").alias("period_month"),
            F.max_by("period_year", "seq").alias("period_year"),
            F.max_by("code", "seq").alias("code"),
            F.max("seq").alias("_seq"),
            F.min("started_at").alias("started_at"),
            F.max("completed_at").alias("completed_at"),
        )
    )
    status = F.get(known, F.col("code") - 1)
    if not known_statuses:
        other = (
            states.filter(~F.col("status").isin(*STATUSES))
            .groupBy("id", F.col("seq").alias("_seq"))
            .agg(F.min("status").alias("_other"))
        )
        latest, status = latest.join(other, ["id", "_seq"], "left"), F.coalesce(status, F.col("_other"))
    return latest.withColumn("status", status).select(*PAYROLL_RUNS.fieldNames())


def lookup_runs(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """Each requested id with its run, or the message that it is missing."""
    found = runs.withColumn("found", F.lit(True))
    missing = F.concat(F.lit("PayrollRun not found: "), F.col("id").cast("string"))
    return (
        requests.join(found, "id", "left")
        .withColumn("error", F.when(F.col("found").isNull(), missing))
        .drop("found")
    )


def resume(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """Outcome of each resume request. ``error`` is null where the run waits
    for review and may go on; its ``status`` is then ``STARTED``."""
    refused = F.concat(
        F.lit("PayrollRun "),
        F.col("id").cast("string"),
        F.lit(" cannot be resumed: status is "),
        F.col("status"),
        F.lit(f", expected {AWAITING_REVIEW}"),
    )
    checked = lookup_runs(requests, runs).withColumn(
        "error",
        F.when(F.col("error").isNotNull(), F.col("error")).when(
            F.col("status") != AWAITING_REVIEW, refused
        ),
    )
    status = F.when(F.col("error").isNull(), F.lit(STARTED)).otherwise(F.col("status"))
    return checked.withColumn("status", status)


def resumed_states(outcomes: DataFrame, at: datetime) -> DataFrame:
    """State rows of the runs that go on; two requests for a run resume it
    once."""
    going_on = outcomes.filter(F.col("error").isNull()).select(*PAYROLL_RUNS.fieldNames())
    return changed_state(going_on.dropDuplicates(["id"]), STARTED, at, RESUME)


def run_history_page(
    runs: DataFrame,
    page: int = 0,
    size: int = 20,
    sort: str | list[tuple[str, bool]] = "started_at",
    descending: bool = True,
) -> DataFrame:
    """One page of the run history, newest first by default; equal values are
    ordered by id. A page past the end is empty.

    ``sort`` is a column, or several with whether each is descending. Nulls are
    the largest values, as in PostgreSQL: first descending, last ascending.
    The page is found by selection (``paging``), without a sort or write of the table.
    """
    if page < 0 or size < 1:
        raise ValueError("page must be at least 0 and size at least 1")
    keys = [(sort, descending)] if isinstance(sort, str) else sort
    for name, _ in keys:
        if name not in SORTABLE:
            raise ValueError(f"cannot sort by {name!r}, expected one of {SORTABLE}")
    return page_of(runs, [*keys, ("id", False)], page * size, size)


def page_totals(rows: DataFrame, size: int) -> DataFrame:
    """Number of rows and of pages of ``size``."""
    counted = rows.agg(F.count("*").alias("total_elements"))
    pages = F.call_function("div", F.col("total_elements") + (size - 1), F.lit(size))
    return counted.select("total_elements", pages.cast("bigint").alias("total_pages"))


def launch_requests(runs: DataFrame, job_name: str) -> DataFrame:
    """What identifies the launch of a job for a run."""
    return runs.select(
        F.lit(job_name).alias("job_name"),
        F.col("id").alias("payroll_run_id"),
        period_key(F.col("period_year"), F.col("period_month")).alias("period"),
    )


def launchable(requests: DataFrame, executions: DataFrame) -> DataFrame:
    """Requests whose job, run and period have no completed execution."""
    keys = ["job_name", "payroll_run_id", "period"]
    done = executions.filter(F.col("status") == COMPLETED).select(*keys)
    return requests.join(done, keys, "left_anti")
