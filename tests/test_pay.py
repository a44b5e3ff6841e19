"""Hours, gross pay, deductions, payslips and summary."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

import data
from tallyroll.functions import pay
from tallyroll.functions.periods import in_period, previous_period
from tallyroll.operators import hours as hours_ops
from tallyroll.operators import imports, payslips
from tallyroll.schemas import Params


def gross(spark, pairs, params=Params()):
    rows = [(i, Decimal(h), Decimal(r)) for i, (h, r) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, h decimal(14,2), r decimal(10,2)")
    out = df.withColumn("g", pay.gross_pay(F.col("h"), F.col("r"), params)).orderBy("i")
    return [str(r.g) for r in out.collect()]


def test_gross_pay_around_the_threshold(spark):
    cases = {
        ("40", "40.00"): "1600.00",
        ("160", "40.00"): "6400.00",
        ("160.01", "40.00"): "6400.60",
        ("200", "40.00"): "8800.00",
        ("312", "38.00"): "14744.00",
    }
    assert gross(spark, list(cases)) == list(cases.values())


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.decimals("0.01", "9999.99", places=2), st.decimals("0.01", "99999.99", places=2)
        ),
        min_size=1,
        max_size=50,
    )
)
def test_gross_pay_matches_exact_arithmetic(spark, pairs):
    from decimal import ROUND_HALF_UP

    def expected(h, r):
        value = h * r if h <= 160 else 160 * r + (h - 160) * r * Decimal("1.5")
        return str(value.quantize(Decimal("0.01"), ROUND_HALF_UP))

    assert gross(spark, pairs) == [expected(h, r) for h, r in pairs]


def test_deductions_and_net(spark):
    df = spark.createDataFrame(
        [(Decimal("1000.00"),), (Decimal("8800.00"),), (Decimal("0.10"),)], "g decimal(24,2)"
    )
    out = df.withColumn("d", pay.deductions(F.col("g"))).withColumn("n", pay.net_pay(F.col("g"), F.col("d")))
    assert [(str(r.d), str(r.n)) for r in out.collect()] == [
        ("150.00", "850.00"),
        ("1320.00", "7480.00"),
        ("0.02", "0.08"),
    ]


def test_floats_are_refused():
    with pytest.raises(TypeError):
        pay.exact(0.15)


def test_golden_payslips(spark):
    lines = [tuple(line.split(",")) for line in data.month_lines()]
    raw, employees = data.raw(spark, *lines), data.employees(spark)
    runs = data.runs(spark, (1, 2027, 3), (2, 2027, 2))
    entries = imports.import_accepted(raw, employees)
    by_id = hours_ops.hours_by_employee(entries, employees, runs)
    by_email = hours_ops.hours_by_email(imports.valid_rows(raw), employees, runs)
    assert sorted(map(tuple, by_id.collect())) == sorted(map(tuple, by_email.collect()))
    slips = payslips.as_stored(payslips.payslips(by_id)).collect()
    assert {r.payroll_run_id for r in slips} == {1}
    got = {r.employee_id: tuple(map(str, (r.total_hours, r.gross_pay, r.deductions, r.net_pay))) for r in slips}
    assert got == data.GOLDEN


def test_entries_belong_to_a_run_by_month_only(spark):
    entries = data.entries(
        spark, (1, "2026-08-31", "8"), (1, "2026-09-01", "7"), (1, "2025-08-15", "6"), (9, "2026-08-01", "5")
    )
    runs = data.runs(spark, (1, 2026, 8), (2, 2026, 8), (3, 2026, 9), (4, 2030, 1))
    got = hours_ops.hours_by_employee(entries, data.employees(spark), runs).collect()
    # Two runs of one month count its entries each; unknown employees have no rate.
    assert sorted((r.payroll_run_id, r.employee_id, str(r.total_hours)) for r in got) == [
        (1, 1, "8.00"), (2, 1, "8.00"), (3, 1, "7.00"),
    ]
    joined = hours_ops.entries_for_runs(runs, entries)
    assert joined.groupBy("payroll_run_id").count().orderBy("payroll_run_id").collect() == [(1, 2), (2, 2), (3, 1)]


def test_id_ranges_split_the_hours(spark):
    entries = data.entries(spark, *[(i, "2026-08-03", "8") for i in range(1, 6)])
    employees, runs = data.employees(spark), data.runs(spark, (1, 2026, 8))

    def ids(low, high):
        hours = hours_ops.hours_by_employee(entries, employees, runs, id_range=(low, high))
        return sorted(r.employee_id for r in hours.collect())

    assert (ids(1, 2), ids(3, 5), ids(2, 1), ids(4, 4)) == ([1, 2], [3, 4, 5], [], [4])


def test_period_filter_reaches_the_scan(spark, tmp_path):
    entries = data.entries(spark, (1, "2026-08-01", "1"), (1, "2026-08-31", "2"), (1, "2026-09-01", "3"), (1, "2026-12-31", "4"))
    entries.write.parquet(str(tmp_path / "e"))
    stored = spark.read.parquet(str(tmp_path / "e"))
    august = hours_ops.period_entries(stored.drop("work_year", "work_month"), 2026, 8)
    assert august.count() == 2
    assert stored.filter(in_period(F.col("work_date"), 2026, 12)).count() == 1
    plan = august._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(work_date,2026-08-01)" in plan and "LessThan(work_date,2026-09-01)" in plan


def test_totals_beyond_the_column_fail_only_when_stored(spark):
    hours = spark.createDataFrame(
        [(1, 1, Decimal("40.00"), Decimal("10000.00"))],
        "payroll_run_id bigint, employee_id bigint, hourly_rate decimal(10,2), total_hours decimal(14,2)",
    )
    slips = payslips.payslips(hours)
    assert str(slips.first().total_hours) == "10000.00"
    with pytest.raises(SparkRuntimeException, match="total_hours 10000.00 does not fit"):
        payslips.as_stored(slips).collect()


def test_summary_columns_and_order(spark):
    employees, runs = data.employees(spark), data.runs(spark, (1, 2026, 8))
    entries = data.entries(spark, *[(i, "2026-08-03", "8") for i in (5, 3, 1)])
    slips = payslips.payslips(hours_ops.hours_by_employee(entries, employees, runs))
    rows = payslips.payroll_summary(slips, employees).collect()
    assert [(r.employee_id, r.first_name, r.email) for r in rows] == [
        (1, "Ines", "ines.okafor@example.com"),
        (3, "Yuki", "yuki.barros@example.com"),
        (5, "Pavel", "pavel.quispe@example.com"),
    ]
    assert payslips.for_run(slips, 2).count() == 0


def test_previous_period(spark):
    df = spark.createDataFrame([("2026-01-15",), ("2026-03-31",), ("2024-03-30",)], "d string")
    got = df.select(previous_period(F.col("d").cast("date")).alias("p")).collect()
    assert [r.p for r in got] == ["2025-12", "2026-02", "2024-02"]


def test_period_of_stored_entries_prunes_to_its_month(spark, tmp_path):
    entries = data.entries(spark, (1, "2026-08-01", "1"), (1, "2026-08-31", "2"), (1, "2026-09-01", "3"))
    entries.write.partitionBy("work_year", "work_month").parquet(str(tmp_path / "e"))
    august = hours_ops.period_entries(spark.read.parquet(str(tmp_path / "e")), 2026, 8)
    assert august.count() == 2
    files = {r.f for r in august.selectExpr("_metadata.file_path as f").collect()}
    assert all("work_month=8" in f for f in files)
    plan = august._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(work_year" in plan
