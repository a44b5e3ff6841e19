"""Id ranges, per-range counters and timings."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyroll.operators import metrics, ranges


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id bigint")


@pytest.mark.parametrize(
    "values, grid, expected",
    [
        (range(1, 101), 4, [(1, 25), (26, 50), (51, 75), (76, 100)]),
        (range(1, 11), 3, [(1, 4), (5, 8), (9, 10)]),
        ([42], 4, [(42, 42)]),
        ([1, 2], 4, [(1, 1), (2, 2)]),
        (range(1, 6), 4, [(1, 2), (3, 4), (5, 5)]),
        ([10, 1000], 4, [(10, 257), (258, 505), (506, 753), (754, 1000)]),
        ([], 4, [(1, 0)]),
    ],
)
def test_id_ranges(spark, values, grid, expected):
    planned = ranges.id_ranges(ids(spark, values), grid).orderBy("range_id").collect()
    assert [(r.min_id, r.max_id) for r in planned] == expected
    assert [r.range_id for r in planned] == list(range(len(expected)))


def test_bounds(spark):
    assert tuple(ranges.id_bounds(ids(spark, [5, 2, 9])).first()) == (2, 9)
    assert tuple(ranges.id_bounds(ids(spark, [])).first()) == (None, None)


@pytest.mark.parametrize("values", [range(1, 11), [7], [3, 50, 51, 52, 1000]])
def test_every_row_lies_in_its_range(spark, values):
    employees = ids(spark, values)
    rows = employees.withColumnRenamed("id", "employee_id")
    placed = ranges.assign_range(rows, employees, 3).join(ranges.id_ranges(employees, 3), "range_id")
    assert placed.count() == rows.count()
    assert placed.filter(~F.col("employee_id").between(F.col("min_id"), F.col("max_id"))).count() == 0


def test_range_metrics_count_empty_ranges(spark):
    employees = ids(spark, [1, 2, 3, 100])
    rows = ranges.assign_range(employees.withColumnRenamed("id", "employee_id"), employees, 4)
    counted = metrics.range_metrics(ranges.id_ranges(employees, 4), rows, rows.filter("employee_id <> 2"))
    got = counted.orderBy("range_id").select("items_read", "items_written").collect()
    assert [tuple(r) for r in got] == [(3, 2), (0, 0), (0, 0), (1, 1)]


def test_elapsed_and_speedup(spark):
    start = datetime(2026, 8, 1)
    rows = [
        (1, start, start + timedelta(milliseconds=1500)),
        (1, start + timedelta(seconds=1), start + timedelta(milliseconds=25088, microseconds=900)),
        (2, start, None),
        (3, None, start),
        (4, start + timedelta(seconds=2), None),
        (4, None, start + timedelta(seconds=5)),
    ]
    log = spark.createDataFrame(rows, "execution_id bigint, started_at timestamp_ntz, ended_at timestamp_ntz")
    assert {r.execution_id: r.elapsed_ms for r in metrics.elapsed(log).collect()} == {
        1: 25088, 2: 0, 3: 0, 4: 3000,
    }
    # The clock change of a session zone is no elapsed time.
    spring = [(1, datetime(2026, 3, 29, 1, 30), datetime(2026, 3, 29, 3, 30, 0, 123456))]
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        spring_log = spark.createDataFrame(spring, log.schema)
        assert metrics.elapsed(spring_log).first().elapsed_ms == 7_200_123
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    pairs = spark.createDataFrame([(25088, 8651), (5, 0)], "s bigint, p bigint")
    got = pairs.select(metrics.speedup(F.col("s"), F.col("p")).alias("x")).collect()
    assert [round(r.x, 2) for r in got] == [2.9, 0.0]
