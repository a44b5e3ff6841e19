"""The timesheet CSV scan."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroll.functions.fields import clean_text, truncated
from tallyroll.schemas import RAW_LINE_LENGTH

RAW_FIELDS = ["email", "work_date", "hours_worked"]
MALFORMED = "_corrupt_record"
MALFORMED_REASON = "wrong number of fields, expected 3"

_CSV_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in [*RAW_FIELDS, MALFORMED]]
)


class MalformedTimesheetError(ValueError):
    """A line of the file does not have three fields."""


def scan_timesheets(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every data line: three text fields, the file name, and the whole line
    where its number of fields is wrong. A missing path raises."""
    # Spark refuses a query for the malformed line alone, so it is tied to a field.
    line = F.when(F.col(MALFORMED).isNotNull(), F.coalesce(MALFORMED, RAW_FIELDS[0]))
    return (
        spark.read.schema(_CSV_SCHEMA)
        .options(
            header=True,
            sep=",",
            quote='"',
            escape='"',
            comment="#",
            multiLine=False,
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=MALFORMED,
            # With pruning, a query that needs fewer fields would not notice a wrong number of them.
            columnPruning=False,
        )
        .csv(path)
        .select(*RAW_FIELDS, line.alias(MALFORMED), F.col("_metadata.file_name").alias("source_file"))
    )


def well_formed(scanned: DataFrame, fail: bool = False) -> DataFrame:
    """Normalised rows with three fields, and the file they come from.

    With ``fail`` the query that reads the rows raises on any other line, in
    the same pass over the file.
    """
    complete = F.col(MALFORMED).isNull()
    if fail:
        message = F.concat(F.lit(f"{MALFORMED_REASON}: "), F.col(MALFORMED))
        complete = F.when(complete, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return normalise_raw(scanned.filter(complete).drop(MALFORMED))


def malformed_lines(scanned: DataFrame) -> DataFrame:
    """Raw lines with a wrong number of fields, ready for the quarantine."""
    return scanned.filter(F.col(MALFORMED).isNotNull()).select(
        truncated(F.col(MALFORMED), RAW_LINE_LENGTH).alias("raw_line"),
        F.lit(MALFORMED_REASON).alias("reason"),
        "source_file",
    )


def read_timesheets(
    spark: SparkSession,
    path: str | list[str],
    malformed: str = "fail",
    check_blank_lines: bool = False,
) -> DataFrame:
    """Normalised rows of a timesheet file.

    ``malformed='fail'`` makes the query raise on a line with a wrong number
    of fields, as the batch import does; ``'quarantine'`` leaves those lines
    to :func:`malformed_lines`. Spark drops blank lines;
    ``check_blank_lines`` reads the text a second time to raise on them.
    """
    if malformed not in ("fail", "quarantine"):
        raise ValueError(f"malformed must be 'fail' or 'quarantine', not {malformed!r}")
    if check_blank_lines:
        require_no_blank_lines(spark, path)
    return well_formed(scan_timesheets(spark, path), fail=malformed == "fail")


def require_no_blank_lines(spark: SparkSession, path: str | list[str]) -> None:
    """Raise when a line of the file holds nothing but blanks."""
    blank = spark.read.text(path).filter(F.trim("value") == "")
    if blank.head(1):
        raise MalformedTimesheetError(f"blank line in {path}")


def normalise_raw(raw: DataFrame) -> DataFrame:
    """Trimmed fields; an empty or missing field is the empty string."""
    return raw.withColumns({name: clean_text(F.col(name)) for name in RAW_FIELDS})


def with_lineage(entries: DataFrame, imported_at: datetime, source_file: str | None = None) -> DataFrame:
    """File name and import time of each row. The time is a parameter of the
    job, so a retried task writes the same rows."""
    if source_file is not None:
        entries = entries.withColumn("source_file", F.lit(source_file))
    return entries.withColumn("imported_at", F.lit(imported_at).cast("timestamp_ntz"))
