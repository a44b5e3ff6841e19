"""Validation of timesheet rows and the split into entries and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.functions.fields import (
    decimal_text,
    hours_in_range,
    stored_hours,
    truncated,
    work_date_value,
)
from tallyroll.schemas import RAW_LINE_LENGTH, REASON_LENGTH, REJECTED_ENTRIES
from tallyroll.sources.timesheets import MALFORMED as MALFORMED_LINE
from tallyroll.sources.timesheets import MALFORMED_REASON

# Outcome of each row, in the order the checks are made.
OK = "ok"
MALFORMED = "malformed"
NOT_A_NUMBER = "not_a_number"
OUT_OF_RANGE = "out_of_range"
BAD_DATE = "bad_date"
UNKNOWN_EMAIL = "unknown_email"
NOT_A_NUMBER_TEXT = "hours_worked is not a valid number: "
OUT_OF_RANGE_TEXT = "hours_worked must be > 0 and <= 24, was: "
BAD_DATE_TEXT = "work_date is not a valid ISO date: "
UNKNOWN_EMAIL_TEXT = "Unknown employee email: "


class SkipLimitExceededError(ValueError):
    """More rows were rejected than the import tolerates."""


def parse_rows(raw: DataFrame) -> DataFrame:
    """Normalised rows plus what their text means: ``hours_ok`` (null unless
    a number), ``hours`` as stored and ``day``."""
    hours = F.col("hours_worked")
    parsed = raw.withColumns({"hours": stored_hours(hours), "day": work_date_value(F.col("work_date"))})
    return parsed.withColumn("hours_ok", hours_in_range(hours, F.col("hours")))


def resolve_employee(raw: DataFrame, employees: DataFrame) -> DataFrame:
    """Add ``employee_id`` by exact email, null where no employee has it.

    Emails are unique (checked by ``duplicate_emails``), so rows never
    multiply. Spark broadcasts the employees when they are small by its own
    threshold; otherwise both sides are shuffled and a hot email's partition
    is split at run time.
    """
    lookup = employees.select("email", F.col("id").alias("employee_id"))
    return raw.join(lookup, "email", "left")


def unknown_emails(raw: DataFrame, employees: DataFrame) -> DataFrame:
    """Emails without an employee and their number of rows. Rows are counted
    per email first, so a frequent email travels once."""
    counted = raw.groupBy("email").agg(F.count("*").alias("rows"))
    return counted.join(employees.select("email"), "email", "left_anti")


def classify(raw: DataFrame, employees: DataFrame) -> DataFrame:
    """Outcome and reject reason of every row; the first failing check of
    number, range, date, email decides. Rows scanned with their malformed
    lines kept are rejected with the whole line."""
    if MALFORMED_LINE not in raw.columns:
        raw = raw.withColumn(MALFORMED_LINE, F.lit(None).cast("string"))
    resolved = resolve_employee(parse_rows(raw), employees)
    outcome = (
        F.when(F.col(MALFORMED_LINE).isNotNull(), MALFORMED)
        .when(F.col("hours_ok").isNull(), NOT_A_NUMBER)
        .when(~F.col("hours_ok"), OUT_OF_RANGE)
        .when(F.col("day").isNull(), BAD_DATE)
        .when(F.col("employee_id").isNull(), UNKNOWN_EMAIL)
        .otherwise(OK)
    )
    return resolved.withColumn("outcome", outcome).withColumn("reason", _reason(F.col("outcome")))


def _reason(outcome: Column) -> Column:
    return (
        F.when(outcome == MALFORMED, F.lit(MALFORMED_REASON))
        .when(outcome == NOT_A_NUMBER, F.concat(F.lit(NOT_A_NUMBER_TEXT), "hours_worked"))
        .when(outcome == OUT_OF_RANGE, F.concat(F.lit(OUT_OF_RANGE_TEXT), decimal_text(F.col("hours_worked"))))
        .when(outcome == BAD_DATE, F.concat(F.lit(BAD_DATE_TEXT), "work_date"))
        .when(outcome == UNKNOWN_EMAIL, F.concat(F.lit(UNKNOWN_EMAIL_TEXT), "email"))
    )


def accepted_entries(classified: DataFrame) -> DataFrame:
    """Accepted rows as typed entries; other columns of the row are kept."""
    return _as_entries(classified.filter(F.col("outcome") == OK)).drop(
        "outcome", "reason", MALFORMED_LINE
    )


def valid_rows(raw: DataFrame) -> DataFrame:
    """Typed rows that pass every check but the email lookup.

    The generator emits the typed values of a valid row and nothing for
    another one. A filter on them would be pushed down to the text and parse
    every field once more for each time it is mentioned.
    """
    parsed = parse_rows(raw)
    typed = F.struct(
        F.col("day").alias("work_date"),
        F.col("hours").alias("hours_worked"),
        F.year("day").alias("work_year"),
        F.month("day").alias("work_month"),
    )
    valid = F.col("hours_ok") & F.col("day").isNotNull()
    kept = [name for name in raw.columns if name not in ("work_date", "hours_worked")]
    return parsed.select(*kept, F.inline(F.when(valid, F.array(typed))))


def import_accepted(raw: DataFrame, employees: DataFrame) -> DataFrame:
    """Accepted entries alone: bad rows drop out before the join, which is
    then an inner one."""
    lookup = employees.select("email", F.col("id").alias("employee_id"))
    return valid_rows(raw).join(lookup, "email")


def _as_entries(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "work_date": F.col("day"),
            "hours_worked": F.col("hours"),
            "work_year": F.year("day"),
            "work_month": F.month("day"),
        }
    ).drop("hours_ok", "hours", "day")


def raw_line() -> Column:
    """The three fields joined by commas, or the malformed line itself."""
    fields = F.concat_ws(",", "email", "work_date", "hours_worked")
    return F.coalesce(F.col(MALFORMED_LINE), fields)


def rejected_rows(classified: DataFrame) -> DataFrame:
    """Reject records: raw line, reason and run of every row not accepted."""
    return classified.filter(F.col("outcome") != OK).select(
        truncated(raw_line(), RAW_LINE_LENGTH).alias("raw_line"),
        truncated(F.coalesce("reason", "outcome"), REASON_LENGTH).alias("reason"),
        "payroll_run_id",
    ).select(*REJECTED_ENTRIES.fieldNames())


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries and rejects of one classified set. Stage the set first when
    both are written, so that the files are read once."""
    return accepted_entries(classified), rejected_rows(classified)


def skip_limit_report(classified: DataFrame, limit: int) -> DataFrame:
    """Rejected rows per run against the number tolerated."""
    rejected = F.count_if(F.col("outcome") != OK)
    return (
        classified.groupBy("payroll_run_id")
        .agg(rejected.alias("rejected"))
        .select(
            "payroll_run_id",
            "rejected",
            F.lit(limit).cast("bigint").alias("skip_limit"),
            (F.col("rejected") > limit).alias("exceeded"),
        )
    )


def enforce_skip_limit(classified: DataFrame, limit: int) -> None:
    """Raise when a run rejects more than ``limit`` rows. Call it before any
    write, so that a failed import leaves nothing behind."""
    over = skip_limit_report(classified, limit).filter("exceeded").orderBy("payroll_run_id").head(1)
    if over:
        check_skip_limit(over[0].payroll_run_id, over[0].rejected, limit)


def check_skip_limit(run_id: int, rejected: int, limit: int) -> None:
    if rejected > limit:
        raise SkipLimitExceededError(f"payroll run {run_id}: {rejected} rejected rows, limit {limit}")


def sub_cent_employee() -> Column:
    """Aggregate over classified rows: the least employee id of an accepted row whose hours are stored as 0.00."""
    return F.min(F.when((F.col("outcome") == OK) & (F.col("hours") <= 0), F.col("employee_id")))


def sub_cent_entries(entries: DataFrame) -> DataFrame:
    """Accepted rows whose hours are stored as 0.00, which a table of entries
    must not hold."""
    return entries.filter(F.col("hours_worked") <= 0)
