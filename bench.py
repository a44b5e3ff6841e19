"""Times the headline queries and prints one JSON line.

``payslip_step_*`` repeats the published benchmark of the payslip step: hours
of generated employees with 4 entries each are summed, payslips are computed
and written. The published 8.651 s (parallel) include row-wise inserts over
JDBC, ours a Parquet write, so the two are not like for like.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from checks.registry import QUERIES
from tallyroll.operators.hours import hours_by_employee
from tallyroll.operators.payslips import payslips
from tallyroll.session import build_session
from tallyroll.sources import sinks
from tallyroll.sources.storage import stage, working_folder
from tallyroll.sources.tables import load_table
from tallyroll.sources.timesheets import with_lineage

HEADLINE = [
    "payslips",
    "payslips_many_runs",
    "payslips_released",
    "hours_by_employee",
    "entries_for_runs",
    "payroll_summary",
    "import_classify",
    "import_accepted",
    "import_rejected",
    "import_metrics",
    "reject_report",
    "review_flags",
    "current_run_state",
    "run_history_page",
    "resume_outcomes",
    "launch_guard",
    "fk_violations",
    "csv_import",
    "payslips_rerun",
    "import_job",
    "summary_roundtrip",
    "monthly_job",
    "finalized_payslips",
]
REPEATS = 3
AT = datetime(2099, 2, 1)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def run_query(spark: SparkSession, sf_dir: str, name: str) -> None:
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def payslip_step(spark: SparkSession, employees_count: int):
    """Store employees and their entries; return the step to time and the folder."""
    root = working_folder(spark, "bench")
    # Only the sizes matter here: a rate for each employee and four entries of 8 hours.
    ids = spark.range(1, employees_count + 1)
    name = F.concat(F.lit("p"), F.col("id").cast("string"))
    employees = ids.select(
        "id",
        *(name.alias(c) for c in ("first_name", "last_name", "email", "department", "bank_account")),
        F.lit(30).cast("decimal(10,2)").alias("hourly_rate"),
    )
    day = F.explode(F.sequence(F.lit("2099-01-01").cast("date"), F.lit("2099-01-04").cast("date")))
    entries = ids.select(
        F.col("id").alias("employee_id"),
        day.alias("work_date"),
        F.lit(8).cast("decimal(4,2)").alias("hours_worked"),
        F.lit("bench").alias("source_file"),
        F.lit(2099).alias("work_year"),
        F.lit(1).alias("work_month"),
    )
    employees.write.parquet(f"{root}/employees")
    sinks.write_entries(with_lineage(entries, AT), root)
    runs = stage(
        spark.range(1, 2).select(
            "id", F.lit(1).alias("period_month"), F.lit(2099).alias("period_year")
        ),
        f"{root}/runs",
    )

    def step() -> None:
        hours = hours_by_employee(
            load_table(spark, root, "timesheet_entries"), load_table(spark, root, "employees"), runs
        )
        sinks.write_payslips(payslips(hours, generated_at=AT), root)

    return step, root


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run_query(spark, sf_dir, name)
        seconds[name] = statistics.median(
            timed(lambda: run_query(spark, sf_dir, name)) for _ in range(REPEATS)
        )
    for label, count in (("10k", 10_000), ("1m", 1_000_000)):
        step, root = payslip_step(spark, count)
        step()
        seconds[f"payslip_step_{label}"] = statistics.median(timed(step) for _ in range(REPEATS))
        written = load_table(spark, root, "payslips").count()
        if written != count:
            raise AssertionError(f"{written} payslips written for {count} employees")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
