"""Lookups by key in stored tables."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import data
from tallyroll.operators.quality import ConstraintViolationError
from tallyroll.schemas import PAYSLIPS
from tallyroll.sources import sinks
from tallyroll.sources.manifest import current
from tallyroll.sources.tables import find, load_table

ROWS = 120_000


def many_employees(spark, rows=ROWS):
    i = F.col("id")
    return spark.range(0, rows, 1, 4).select(
        "id",
        F.lit("Ada").alias("first_name"),
        F.hex(F.xxhash64(i)).alias("last_name"),
        # No order of emails follows that of ids.
        F.concat(F.hex(F.xxhash64(i, F.lit(1))), F.lit("@example.com")).alias("email"),
        F.lit("Ops").alias("department"),
        F.lit(20).cast("decimal(10,2)").alias("hourly_rate"),
        F.lit("ES00").alias("bank_account"),
    )


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lookups"))
    whole, sinks.LOOKUP_GROUP_BYTES = sinks.LOOKUP_GROUP_BYTES, 64 << 10
    try:
        sinks.write_employees(many_employees(spark), root)
    finally:
        sinks.LOOKUP_GROUP_BYTES = whole
    return root


def rows_scanned(df):
    """Rows that the scans of a query passed on, after whole row groups were left out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(n).metrics().apply("numOutputRows").value() for n in range(leaves.size()))


def test_ten_ids_and_ten_emails_read_a_small_share_of_the_row_groups(spark, stored):
    ids = [7, 12_001, 12_002, 40_000, 40_001, 77_777, 77_778, 77_779, ROWS - 1, ROWS + 5]
    by_id = find(spark, stored, "employees", "id", ids)
    assert sorted(r.id for r in by_id.collect()) == ids[:-1]
    assert rows_scanned(by_id) < ROWS / 3
    emails = [r.email for r in by_id.collect()[:3]] + ["nobody@example.com"]
    by_email = find(spark, stored, "employees", "email", emails)
    assert sorted(r.email for r in by_email.collect()) == sorted(emails[:3])
    assert rows_scanned(by_email) < ROWS / 3
    nobody = find(spark, stored, "employees", "email", ["nobody@example.com", "no one"])
    assert nobody.count() == 0 and rows_scanned(nobody) < ROWS / 10


def test_more_keys_than_one_list_nulls_repeats_and_none(spark, stored):
    keys = list(range(0, ROWS, 3_500))
    found = find(spark, stored, "employees", "id", [*keys, None, keys[0]])
    assert sorted(r.id for r in found.collect()) == keys
    assert find(spark, stored, "employees", "id", [None]).count() == 0
    with pytest.raises(ValueError, match="join"):
        find(spark, stored, "employees", "id", list(range(1_001)))
    with pytest.raises(KeyError, match="department"):
        find(spark, stored, "employees", "department", ["Ops"])


def test_replaced_employees_and_repeated_keys(spark, tmp_path):
    root = str(tmp_path)
    assert find(spark, root, "employees", "id", [1]).count() == 0
    sinks.write_employees(many_employees(spark, 20), root)
    later = many_employees(spark, 30).withColumn("department", F.lit("HR"))
    sinks.write_employees(later, root)
    assert load_table(spark, root, "employees").count() == 30
    assert [r.department for r in find(spark, root, "employees", "id", [3]).collect()] == ["HR"]
    version = current(spark, root).version
    for bad in (later.unionAll(later.limit(1)), later.withColumn("email", F.lit("a@b.c"))):
        with pytest.raises(ConstraintViolationError):
            sinks.write_employees(bad, root)
    assert current(spark, root).version == version
    assert load_table(spark, root, "employees").count() == 30


def test_payslips_and_states_are_found_through_their_commits(spark, tmp_path):
    root = str(tmp_path)
    runs = data.runs(spark, (1, 2026, 8), (2, 2026, 9))
    sinks.append_run_state(runs.withColumn("seq", F.lit(1).cast("bigint")), root)
    assert [r.id for r in find(spark, root, "payroll_run_states", "id", [2, 9]).collect()] == [2]
    for net in ("7.00", "8.00"):
        rows = [(e, Decimal(9), Decimal(9), Decimal(1), Decimal(net), data.AT, run) for run in (1, 2) for e in range(5)]
        paid = spark.createDataFrame(rows, PAYSLIPS)
        sinks.write_payslips(paid if net == "7.00" else paid.filter("payroll_run_id = 2"), root)
    found = find(spark, root, "payslips", "employee_id", [3]).collect()
    assert sorted((r.payroll_run_id, str(r.net_pay)) for r in found) == [(1, "7.00"), (2, "8.00")]
