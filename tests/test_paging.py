"""Pages found by selection against a plain sort."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyroll.operators import paging
from tallyroll.operators import runs as run_ops
from tallyroll.schemas import PAYROLL_RUNS

DAY = datetime(2027, 1, 1)
STATUSES = ["STARTED", "STARTED", "COMPLETED", "AWAITING_REVIEW", "AWAITING_REVIEX", "ÅTER", "", "a" * 40, "a" * 39 + "b"]


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(8)
    rows = [
        (i, rng.randint(1, 12), rng.choice([2026, 2027]), rng.choice(STATUSES), DAY + timedelta(microseconds=rng.choice([0, 1, 10**6, 86_400_000_000]) * rng.randint(0, 3)),
         DAY if rng.random() < 0.3 else None)
        for i in range(-600, 599)
    ]
    return spark.createDataFrame(rows, PAYROLL_RUNS).coalesce(1).cache()


@pytest.fixture
def near(monkeypatch):
    """So few rows to pass over that every search takes several steps."""
    monkeypatch.setattr(paging, "NEAR", 60)
    monkeypatch.setattr(paging, "CUTS", 5)


ORDERS = [
    [("started_at", True)], [("completed_at", True), ("status", False)], [("status", True), ("period_year", False)],
]


@pytest.mark.parametrize("keys", ORDERS)
def test_pages_equal_a_sort(history, near, keys):
    order = [F.col(c).desc_nulls_first() if down else F.col(c).asc_nulls_last() for c, down in [*keys, ("id", False)]]
    ordered = [r.id for r in history.orderBy(*order).collect()]
    for page, size in ((0, 7), (80, 7), (3, 150), (171, 7), (180, 7)):
        got = [r.id for r in run_ops.run_history_page(history, page, size, keys).collect()]
        assert got == ordered[page * size : page * size + size], (page, size)


def test_equal_rows_and_empty_tables(spark, near):
    row = (1, 1, 2027, "STARTED", DAY, None)
    same = spark.createDataFrame([row] * 90, PAYROLL_RUNS)
    assert len(run_ops.run_history_page(same, 4, 20).collect()) == 10
    assert run_ops.run_history_page(same.limit(0), 3, 20).collect() == []


def test_a_page_is_no_write_and_no_sort_of_the_table(history):
    plan = run_ops.run_history_page(history, 3, 20)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_numbers_beyond_doubles_keep_their_order(spark, near):
    ids = [(1 << 62) + i for i in range(200)] + [-(1 << 62) - i for i in range(200)]
    runs = spark.createDataFrame([(i, 1, 2027, "STARTED", DAY, None) for i in ids], PAYROLL_RUNS)
    for down in (False, True):
        got = [r.id for r in run_ops.run_history_page(runs, 28, 7, [("id", down)]).collect()]
        assert got == sorted(ids, reverse=down)[196:203]
