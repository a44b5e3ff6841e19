"""Anomalous hours, and which runs wait for a human."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.functions.pay import exact

REVIEW_REQUIRED = "REVIEW_REQUIRED"
PROCEED = "PROCEED"


def anomalies(hours: DataFrame, threshold: Decimal) -> DataFrame:
    """Employees of a run with more hours than the threshold."""
    return hours.filter(F.col("total_hours") > exact(threshold))


def review_flags(runs: DataFrame, hours: DataFrame, threshold: Decimal) -> DataFrame:
    """Anomalous employees of each run, and whether there are any. A run
    without hours has none."""
    counted = hours.groupBy("payroll_run_id").agg(
        F.count_if(F.col("total_hours") > exact(threshold)).alias("anomaly_employee_count")
    )
    count = F.coalesce("anomaly_employee_count", F.lit(0)).cast("bigint")
    return (
        runs.select(F.col("id").alias("payroll_run_id"))
        .join(counted, "payroll_run_id", "left")
        .select(
            "payroll_run_id",
            count.alias("anomaly_employee_count"),
            (count > 0).alias("has_anomalies"),
        )
    )


def route(flags: DataFrame) -> DataFrame:
    """Add the way of each run: a missing flag proceeds."""
    flagged = F.coalesce("has_anomalies", F.lit(False))
    return flags.withColumn("route", F.when(flagged, REVIEW_REQUIRED).otherwise(PROCEED))


def runs_on(routes: DataFrame, way: str) -> DataFrame:
    """Ids of the runs routed one way."""
    return routes.filter(F.col("route") == way).select("payroll_run_id")


def release(hours: DataFrame, routes: DataFrame) -> DataFrame:
    """Hours of the runs that proceed. One anomalous employee holds back the
    whole run."""
    return hours.join(runs_on(routes, REVIEW_REQUIRED), "payroll_run_id", "left_anti")
