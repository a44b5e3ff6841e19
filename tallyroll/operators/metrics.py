"""Counters and timings of jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.operators import imports
from tallyroll.sources.timesheets import MALFORMED_REASON


IMPORT_COUNTERS = "items_read long, items_written long, items_skipped long, read_skips long, process_skips long, write_skips long"


def import_counters() -> list[Column]:
    """Rows read, written and skipped, skips split by phase. A malformed line
    is skipped before it counts as read; every other reject is skipped while
    rows are checked, and none while they are written."""
    outcome = F.col("outcome")
    malformed = F.count_if(outcome == imports.MALFORMED)
    rejected = F.count_if(outcome != imports.OK)
    return [
        F.count_if(outcome != imports.MALFORMED).alias("items_read"),
        F.count_if(outcome == imports.OK).alias("items_written"),
        rejected.alias("items_skipped"),
        malformed.alias("read_skips"),
        (rejected - malformed).alias("process_skips"),
        F.lit(0).cast("bigint").alias("write_skips"),
    ]


def import_metrics(classified: DataFrame) -> DataFrame:
    """:func:`import_counters` of each run."""
    return classified.groupBy("payroll_run_id").agg(*import_counters())


def range_metrics(ranges: DataFrame, hours: DataFrame, payslips: DataFrame) -> DataFrame:
    """Aggregates read and payslips written per id range; both inputs carry
    ``range_id``. Ranges without rows count zero."""
    read = hours.groupBy("range_id").agg(F.count("*").alias("items_read"))
    written = payslips.groupBy("range_id").agg(F.count("*").alias("items_written"))
    return (
        ranges.join(read, "range_id", "left")
        .join(written, "range_id", "left")
        .na.fill(0, ["items_read", "items_written"])
    )


def elapsed(step_log: DataFrame) -> DataFrame:
    """Milliseconds from the first start to the last end of the steps of each
    execution, 0 when either is unknown."""
    millis = F.call_function("div", _micros("last") - _micros("first"), F.lit(1000))
    return (
        step_log.groupBy("execution_id")
        .agg(F.min("started_at").alias("first"), F.max("ended_at").alias("last"))
        .select("execution_id", F.coalesce(millis, F.lit(0)).alias("elapsed_ms"))
    )


def _micros(name: str) -> Column:
    """Microseconds of a time without zone, which no session zone shifts."""
    time = F.col(name)
    days = F.unix_date(time.cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(time)) * 60 + F.minute(time)
    seconds = F.extract(F.lit("SECOND"), time)
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def speedup(sequential_ms: Column, parallel_ms: Column) -> Column:
    """How many times faster the parallel execution is, 0 if it took no time."""
    return F.when(parallel_ms == 0, F.lit(0.0)).otherwise(sequential_ms / parallel_ms)


def reason_class(reason: Column) -> Column:
    """Kind of a reject, from the fixed start of its reason."""
    kinds = {
        MALFORMED_REASON: imports.MALFORMED,
        imports.NOT_A_NUMBER_TEXT: imports.NOT_A_NUMBER,
        imports.OUT_OF_RANGE_TEXT: imports.OUT_OF_RANGE,
        imports.BAD_DATE_TEXT: imports.BAD_DATE,
        imports.UNKNOWN_EMAIL_TEXT: imports.UNKNOWN_EMAIL,
    }
    kind = F.lit("other")
    for text, name in kinds.items():
        kind = F.when(reason.startswith(text), F.lit(name)).otherwise(kind)
    return kind


def reject_report(rejected: DataFrame) -> DataFrame:
    """Rejects per run and kind of reason."""
    return rejected.groupBy("payroll_run_id", reason_class(F.col("reason")).alias("reason_class")).agg(
        F.count("*").alias("rejected")
    )
