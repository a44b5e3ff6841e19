"""Table schemas and run parameters."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import types as T

HOURS = T.DecimalType(4, 2)
TOTAL_HOURS = T.DecimalType(6, 2)
MONEY = T.DecimalType(10, 2)
# Results of the pay arithmetic: wide enough for any sum of hours. Only the
# payslip table limits them to the types above.
CALCULATED_HOURS = T.DecimalType(14, 2)
CALCULATED_MONEY = T.DecimalType(24, 2)

EMPLOYEES = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("first_name", T.StringType(), False),
        T.StructField("last_name", T.StringType(), False),
        T.StructField("email", T.StringType(), False),
        T.StructField("department", T.StringType(), False),
        T.StructField("hourly_rate", MONEY, False),
        T.StructField("bank_account", T.StringType(), False),
    ]
)

TIMESHEET_ENTRIES = T.StructType(
    [
        T.StructField("employee_id", T.LongType(), False),
        T.StructField("work_date", T.DateType(), False),
        T.StructField("hours_worked", HOURS, False),
        T.StructField("source_file", T.StringType(), False),
        T.StructField("imported_at", T.TimestampNTZType(), False),
        T.StructField("work_year", T.IntegerType(), False),
        T.StructField("work_month", T.IntegerType(), False),
    ]
)

PAYROLL_RUNS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("period_month", T.IntegerType(), False),
        T.StructField("period_year", T.IntegerType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at", T.TimestampNTZType(), False),
        T.StructField("completed_at", T.TimestampNTZType(), True),
    ]
)

# One row per status change; ``seq`` orders the changes of a run.
RUN_STATES = T.StructType(
    [T.StructField("seq", T.LongType(), False), *PAYROLL_RUNS.fields]
)

PAYSLIPS = T.StructType(
    [
        T.StructField("employee_id", T.LongType(), False),
        T.StructField("total_hours", TOTAL_HOURS, False),
        T.StructField("gross_pay", MONEY, False),
        T.StructField("deductions", MONEY, False),
        T.StructField("net_pay", MONEY, False),
        T.StructField("generated_at", T.TimestampNTZType(), False),
        T.StructField("payroll_run_id", T.LongType(), False),
    ]
)

REJECTED_ENTRIES = T.StructType(
    [
        T.StructField("raw_line", T.StringType(), False),
        T.StructField("reason", T.StringType(), False),
        T.StructField("payroll_run_id", T.LongType(), False),
    ]
)

# Hours of each employee and month in one import, so that a run need not sum entries again.
MONTH_SUMS = T.StructType(
    [
        T.StructField("employee_id", T.LongType(), False),
        T.StructField("hours_worked", T.DecimalType(14, 2), False),
        T.StructField("work_year", T.IntegerType(), False),
        T.StructField("work_month", T.IntegerType(), False),
    ]
)

# Runs calculated in one commit: its payslips are those of the run until a later commit names it.
PAYSLIP_RUNS = T.StructType([T.StructField("payroll_run_id", T.LongType(), False)])

SUMMARY_COLUMNS = [
    "employee_id",
    "first_name",
    "last_name",
    "email",
    "department",
    "total_hours",
    "gross_pay",
    "deductions",
    "net_pay",
]

# name -> (schema, partition columns of the stored layout)
TABLES = {
    "employees": (EMPLOYEES, []),
    "timesheet_entries": (TIMESHEET_ENTRIES, ["work_year", "work_month"]),
    "payroll_run_states": (RUN_STATES, []),
    "payslips": (PAYSLIPS, ["payroll_run_id"]),
    "month_sums": (MONTH_SUMS, ["work_year", "work_month"]),
    "payslip_runs": (PAYSLIP_RUNS, []),
    "rejected_timesheet_entries": (REJECTED_ENTRIES, ["payroll_run_id"]),
}

# Columns by which single rows of a stored table are looked up. Files are sorted by the first one,
# and each has a Bloom filter in every row group.
LOOKUP_COLUMNS = {
    "employees": ["id", "email"],
    "payroll_run_states": ["id"],
    "payslips": ["employee_id"],
}

# Run statuses and text limits of the tables.
STARTED = "STARTED"
AWAITING_REVIEW = "AWAITING_REVIEW"
COMPLETED = "COMPLETED"
FAILED = "FAILED"
STATUSES = [STARTED, AWAITING_REVIEW, COMPLETED, FAILED]
RAW_LINE_LENGTH = 500
REASON_LENGTH = 255
TEXT_LENGTHS = {
    "employees": {
        "first_name": 100,
        "last_name": 100,
        "email": 255,
        "department": 100,
        "bank_account": 34,
    },
    "timesheet_entries": {"source_file": 255},
    "payroll_runs": {"status": 30},
    "payroll_run_states": {"status": 30},
    "rejected_timesheet_entries": {"raw_line": RAW_LINE_LENGTH, "reason": REASON_LENGTH},
}


@dataclass(frozen=True)
class Params:
    """Settings of a payroll job. Amounts are decimals, never floats."""

    skip_limit: int = 50
    anomaly_threshold_hours: Decimal = Decimal("300")
    overtime_threshold_hours: Decimal = Decimal("160")
    overtime_multiplier: Decimal = Decimal("1.5")
    deduction_rate: Decimal = Decimal("0.15")
    grid_size: int = 4
    export_dir: str = "exports"
