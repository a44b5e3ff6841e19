"""Every registered query against its SQL, and figures known beforehand."""

import os
import sys
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from checks import fixtures as fx
from checks import registry
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.registry import QUERIES
from tallyroll.operators import imports
from tallyroll.schemas import Params

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")

# Without rows in the smallest tables.
EMPTY_WHEN_SMALL = {"duplicate_emails"}


@pytest.fixture(scope="module")
def small():
    return connect(SMALL)


def test_registry_and_sql_have_the_same_names():
    assert set(QUERIES) == set(ORACLE)
    # The entry adds the training-data operators where they are present.
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, name):
    problem = difference(spark, small, SMALL, name)
    if problem == "no rows to compare" and name in EMPTY_WHEN_SMALL:
        return
    assert problem is None


def test_entry(spark):
    assert entry_module.entry(spark).columns == [
        "payroll_run_id", "employee_id", "total_hours", "gross_pay", "deductions", "net_pay",
    ]


@pytest.mark.parametrize(
    "sf_dir, outcomes, slips, overtime, anomalous, hours, gross",
    [
        (SMALL, (333, 12, 619, 7, 29), 14, 13, 3, "3750.06", "123232.19"),
        (MEDIUM, (3267, 113, 6183, 37, 400), 135, 131, 45, "36241.49", "2015543.90"),
    ],
)
def test_known_figures(spark, sf_dir, outcomes, slips, overtime, anomalous, hours, gross):
    kinds = (imports.OK, imports.NOT_A_NUMBER, imports.OUT_OF_RANGE, imports.BAD_DATE, imports.UNKNOWN_EMAIL)
    counted = {
        r.outcome: r["count"] for r in registry.import_classify(spark, sf_dir).groupBy("outcome").count().collect()
    }
    assert tuple(counted[kind] for kind in kinds) == outcomes
    paid = registry.payslips(spark, sf_dir).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("total_hours") > Params().overtime_threshold_hours).alias("overtime"),
        F.count_if(F.col("total_hours") > Params().anomaly_threshold_hours).alias("anomalous"),
        F.sum("total_hours").alias("hours"),
        F.sum("gross_pay").alias("gross"),
    ).first()
    assert (paid.n, paid.overtime, paid.anomalous) == (slips, overtime, anomalous)
    assert (paid.hours, paid.gross) == (Decimal(hours), Decimal(gross))


def test_hours_are_scanned_once_for_routing_and_pay(spark):
    df = registry.payslips_released(spark, SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    scans = [line for line in final.splitlines() if "FileScan" in line and "lineitem" in line]
    assert len(scans) == 1 and "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in scans[0]


def test_hot_keys_keep_results_whole(spark):
    """A third of the rows on one email: sums are made before the lookup."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "cust1@example.com")
        .otherwise(F.concat(F.lit("cust"), (F.col("id") % 100).cast("string"), F.lit("@example.com")))
        .alias("email"),
        F.lit("2024-01-05").alias("work_date"),
        F.lit("1.00").alias("hours_worked"),
    )
    from tallyroll.operators.hours import hours_by_email

    got = hours_by_email(imports.valid_rows(rows), fx.customer_employees(spark, MEDIUM), fx.event_runs(spark, MEDIUM))
    hot = got.filter("employee_id = 1").first()
    expected = sum(1 for i in range(3000) if i % 3 == 0 or i % 100 == 1)
    assert hot.total_hours == expected


def test_module_path():
    assert os.path.dirname(os.path.abspath(entry_module.__file__)) in sys.path
