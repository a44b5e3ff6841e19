"""Payslips and their summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tallyroll.functions import pay
from tallyroll.schemas import (
    CALCULATED_HOURS,
    CALCULATED_MONEY,
    MONEY,
    SUMMARY_COLUMNS,
    TOTAL_HOURS,
    Params,
)


def payslips(hours: DataFrame, params: Params = Params(), generated_at: datetime | None = None) -> DataFrame:
    """One payslip per row of hours."""
    slips = (
        hours.withColumn("gross", pay.gross_pay(F.col("total_hours"), F.col("hourly_rate"), params))
        .withColumn("deducted", pay.deductions(F.col("gross"), params))
        .select(
            "payroll_run_id",
            "employee_id",
            F.col("total_hours").cast(CALCULATED_HOURS).alias("total_hours"),
            F.col("gross").cast(CALCULATED_MONEY).alias("gross_pay"),
            F.col("deducted").cast(CALCULATED_MONEY).alias("deductions"),
            pay.net_pay(F.col("gross"), F.col("deducted")).cast(CALCULATED_MONEY).alias("net_pay"),
        )
    )
    if generated_at is not None:
        slips = slips.withColumn("generated_at", F.lit(generated_at).cast("timestamp_ntz"))
    return slips


def as_stored(slips: DataFrame) -> DataFrame:
    """Payslips in the types of the payslip table. An amount that does not
    fit them raises, as the table would refuse it."""
    types = {"total_hours": TOTAL_HOURS, "gross_pay": MONEY, "deductions": MONEY, "net_pay": MONEY}
    return slips.withColumns({name: _fitting(name, kind) for name, kind in types.items()})


def _fitting(name: str, kind: DecimalType) -> Column:
    """The cast of a column, with an error of its own whatever the session
    does about overflow."""
    value, cast = F.col(name), F.col(name).try_cast(kind)
    message = F.concat(F.lit(f"{name} "), value.cast("string"), F.lit(f" does not fit {kind.simpleString()}"))
    return F.when(cast.isNotNull() | value.isNull(), cast).otherwise(F.raise_error(message).cast(kind))


def for_run(rows: DataFrame, run_id: int) -> DataFrame:
    """Payslips or rejects of one run; on stored tables only its partition is
    read."""
    return rows.filter(F.col("payroll_run_id") == run_id)


def with_employee_columns(rows: DataFrame, employees: DataFrame) -> DataFrame:
    """Names, email and department of the employee of each row."""
    person = employees.select(
        F.col("id").alias("employee_id"), "first_name", "last_name", "email", "department"
    )
    return rows.join(person, "employee_id")


def payroll_summary(slips: DataFrame, employees: DataFrame) -> DataFrame:
    """Payslips with their employee, ordered by run and employee."""
    return (
        with_employee_columns(slips, employees)
        .select("payroll_run_id", *SUMMARY_COLUMNS)
        .orderBy("payroll_run_id", "employee_id")
    )
