"""Small tables for the tests."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from tallyroll.schemas import EMPLOYEES, STARTED

AT = datetime(2027, 4, 2, 4, 15, 0)
LATER = datetime(2027, 4, 5, 11, 40, 0)

PEOPLE = [
    (1, "Ines", "Okafor", "Foundry", "27.40"),
    (2, "Tomasz", "Lindqvist", "Foundry", "31.25"),
    (3, "Yuki", "Barros", "Dispatch", "24.10"),
    (4, "Noor", "Haddad", "Dispatch", "36.80"),
    (5, "Pavel", "Quispe", "Office", "29.95"),
]
# Days and hours a day of each in the month below, and by hand: hours, gross, deductions and net pay.
WORKED = {1: (4, "7.25"), 2: (3, "9.40"), 3: (5, "6.15"), 4: (14, "23.50"), 5: (1, "5.35")}
GOLDEN = {
    1: ("29.00", "794.60", "119.19", "675.41"),
    2: ("28.20", "881.25", "132.19", "749.06"),
    3: ("30.75", "741.08", "111.16", "629.92"),
    4: ("329.00", "15216.80", "2282.52", "12934.28"),
    5: ("5.35", "160.23", "24.03", "136.20"),
}


def email(first: str, last: str) -> str:
    return f"{first}.{last}@example.com".lower()


def employees(spark):
    rows = [
        (i, first, last, email(first, last), department, Decimal(rate), f"FR76{i:030d}")
        for i, first, last, department, rate in PEOPLE
    ]
    return spark.createDataFrame(rows, EMPLOYEES)


def month_lines(year: int = 2027, month: int = 3) -> list[str]:
    """31 lines: 27 good ones and one of each kind of reject."""
    emails = {i: email(first, last) for i, first, last, _, _ in PEOPLE}
    good = [f"{emails[i]},{date(year, month, day)},{value}" for i, (days, value) in WORKED.items() for day in range(1, days + 1)]
    return good + [
        f"{emails[5]},{date(year, month, 9)},24.25",
        f"{emails[2]},{date(year, month, 9)},n/a",
        f"{emails[3]},{year}-{month:02d}-32,6.15",
        f"visitor@example.net,{date(year, month, 9)},6.15",
    ]


#: What the import makes of the bad lines above.
REJECTED = [
    ("pavel.quispe@example.com,2027-03-09,24.25", "hours_worked must be > 0 and <= 24, was: 24.25"),
    ("tomasz.lindqvist@example.com,2027-03-09,n/a", "hours_worked is not a valid number: n/a"),
    ("visitor@example.net,2027-03-09,6.15", "Unknown employee email: visitor@example.net"),
    ("yuki.barros@example.com,2027-03-32,6.15", "work_date is not a valid ISO date: 2027-03-32"),
]


def write_csv(path, lines, header="email,work_date,hours_worked"):
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def requests(spark, *rows):
    """Run requests (id, year, month)."""
    return spark.createDataFrame(rows, "id bigint, period_year int, period_month int")


def runs(spark, *rows):
    """Started runs (id, year, month)."""
    full = [(i, month, year, STARTED, AT, None) for i, year, month in rows]
    return spark.createDataFrame(
        full,
        "id bigint, period_month int, period_year int, status string, started_at timestamp_ntz, completed_at timestamp_ntz",
    )


def raw(spark, *rows, run_id=7):
    """Text rows (email, date, hours) tagged with a run."""
    df = spark.createDataFrame(rows, "email string, work_date string, hours_worked string")
    from pyspark.sql import functions as F

    return df.withColumn("payroll_run_id", F.lit(run_id).cast("bigint"))


def entries(spark, *rows):
    """Typed entries (employee, date text, hours text)."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "employee_id bigint, work_date string, hours_worked string")
    return df.select(
        "employee_id",
        F.col("work_date").cast("date").alias("work_date"),
        F.col("hours_worked").cast("decimal(4,2)").alias("hours_worked"),
        F.year(F.col("work_date").cast("date")).alias("work_year"),
        F.month(F.col("work_date").cast("date")).alias("work_month"),
    )
