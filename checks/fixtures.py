"""Payroll tables derived from the test tables.

Every row of a source table yields a row here. Faults are planted by changing
values, never by leaving rows out.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.operators import imports
from tallyroll.schemas import AWAITING_REVIEW, COMPLETED, FAILED, HOURS, MONEY, STARTED, Params
from tallyroll.sources.storage import stage, working_folder
from tallyroll.sources.timesheets import normalise_raw

EVENTS_RUN = 202401
AT = datetime(2024, 2, 1, 3, 0, 0)
LATER = datetime(2024, 2, 2, 9, 0, 0)
# Overtime and review limits at which both routes occur among the line items.
LINEITEM_PARAMS = Params(
    overtime_threshold_hours=Decimal("100"), anomaly_threshold_hours=Decimal("150")
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def timestamp_text(column: str) -> Column:
    return F.date_format(F.col(column).cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")


# Events and customers: one month of raw rows with every kind of reject.


def customer_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    known = F.concat(F.lit("cust"), text(key), F.lit("@example.com"))
    former = F.concat(F.lit("former"), text(key), F.lit("@example.org"))
    return table(spark, sf_dir, "customer").select(
        key.alias("id"),
        F.lit("Customer").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(key % 10 == 7, former).otherwise(known).alias("email"),
        F.col("c_mktsegment").alias("department"),
        (key % 60 + 20).cast(MONEY).alias("hourly_rate"),
        F.concat(F.lit("FR76"), F.lpad(text(key), 30, "0")).alias("bank_account"),
    )


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untrimmed text rows; the three source columns stay beside them."""
    event = F.col("event_id")
    email = F.concat(F.lit("cust"), text("user_id"), F.lit("@example.com"))
    padded = F.concat(F.lit(" "), email, F.lit("\t"))
    hours = text(F.col("value").cast("decimal(10,2)"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "ts",
        F.when(event % 5 == 0, padded).otherwise(email).alias("email"),
        F.when(event % 97 == 0, "not-a-date").otherwise(text(F.col("ts").cast("date"))).alias("work_date"),
        F.when(event % 89 == 0, "not-a-number")
        .when(event % 83 == 0, "0.00")
        .otherwise(hours)
        .alias("hours_worked"),
    )


def event_timesheet(spark: SparkSession, sf_dir: str, run_id: Column | None = None) -> DataFrame:
    """Normalised rows, tagged with the run that imports them."""
    run = F.lit(EVENTS_RUN) if run_id is None else run_id
    rows = normalise_raw(event_rows(spark, sf_dir)).withColumn("payroll_run_id", run.cast("bigint"))
    return rows.select("payroll_run_id", "email", "work_date", "hours_worked")


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run for each month with events."""
    return _started(_months(table(spark, sf_dir, "events"), "ts"), F.array(_month_id()))


def _months(rows: DataFrame, day: str) -> DataFrame:
    return rows.select(
        F.year(day).alias("period_year"), F.month(day).alias("period_month")
    ).distinct()


def _month_id() -> Column:
    return (F.col("period_year") * 100 + F.col("period_month")).cast("bigint")


def _started(months: DataFrame, ids: Column) -> DataFrame:
    """Started runs, stored like the run table they stand for: its size is
    known when a query is planned, so no large side is shuffled for it."""
    runs = months.select(
        F.explode(ids).alias("id"),
        "period_month",
        "period_year",
        F.lit(STARTED).alias("status"),
        F.lit(AT).cast("timestamp_ntz").alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"),
    )
    return stage(runs.coalesce(1), working_folder(months.sparkSession, "runs"))


# Line items and suppliers: many months, whole hours.


def supplier_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("id"),
        F.lit("Supplier").alias("first_name"),
        F.col("s_name").alias("last_name"),
        F.concat(F.lit("supp"), text(key), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("Nation "), text("s_nationkey")).alias("department"),
        (key % 60 + 20).cast(MONEY).alias("hourly_rate"),
        F.concat(F.lit("FR76"), F.lpad(text(key), 30, "0")).alias("bank_account"),
    )


def lineitem_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the import accepts of all line items; it rejects quantities above 24."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("employee_id"),
        text(F.col("l_shipdate").cast("date")).alias("work_date"),
        text("l_quantity").alias("hours_worked"),
        F.lit("lineitem").alias("source_file"),
    )
    return imports.valid_rows(rows).select(
        "employee_id", "work_date", F.col("hours_worked").cast(HOURS).alias("hours_worked"),
        "source_file", "work_year", "work_month",
    )


def monthly_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run for each month with orders, and a second one from 2000 on."""
    first = _month_id()
    ids = F.when(F.col("period_year") >= 2000, F.array(first, first + 1000000)).otherwise(F.array(first))
    return _started(_months(table(spark, sf_dir, "orders"), "o_orderdate"), ids)


# Orders as run history, events as logs.


def order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    started = F.col("o_orderdate").cast("timestamp_ntz")
    status = (
        F.when(F.col("o_orderstatus") == "F", COMPLETED)
        .when(F.col("o_orderstatus") == "O", STARTED)
        .otherwise(AWAITING_REVIEW)
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.month(started).alias("period_month"),
        F.year(started).alias("period_year"),
        status.alias("status"),
        started.alias("started_at"),
        F.when(status == COMPLETED, started).alias("completed_at"),
    )


def order_run_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested ids, half of them beyond the last run."""
    return table(spark, sf_dir, "orders").select((F.col("o_orderkey") * 2).alias("id"))


def order_create_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        (key % 15).cast("int").alias("period_month"),
        (key % 40 + 1990).cast("int").alias("period_year"),
    )


def event_run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts").cast("timestamp_ntz")
    status = (
        F.when(F.col("event_type") == "purchase", COMPLETED)
        .when(F.col("event_type") == "error", FAILED)
        .when(F.col("event_type") == "click", AWAITING_REVIEW)
        .otherwise(STARTED)
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("id"),
        F.month(at).alias("period_month"),
        F.year(at).alias("period_year"),
        status.alias("status"),
        at.alias("started_at"),
        F.when(status == COMPLETED, at).alias("completed_at"),
    )


def event_step_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    start = F.col("ts").cast("timestamp_ntz")
    end = (F.col("ts").cast("timestamp") + F.make_dt_interval(secs=event % 60)).cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("execution_id"),
        start.alias("started_at"),
        F.when(event % 50 != 0, end).alias("ended_at"),
    )


def document_timesheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents in place of hours: long lines that must be cut."""
    rows = table(spark, sf_dir, "documents").select(
        F.lit(EVENTS_RUN).cast("bigint").alias("payroll_run_id"),
        F.concat(F.lit("cust"), text("doc_id"), F.lit("@example.com")).alias("email"),
        F.lit("2024-01-15").alias("work_date"),
        F.col("text").alias("hours_worked"),
    )
    return normalise_raw(rows)

