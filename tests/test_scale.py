"""Plans that must hold when inputs are large or lopsided."""

import pytest
from pyspark.sql import functions as F

import data
from tallyroll.operators import hours as hours_ops
from tallyroll.operators import imports, review
from tallyroll.operators import runs as run_ops

# Small limits, so that small tables count as large and a small partition as hot.
LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def lopsided(spark):
    for key, value in LIMITS.items():
        spark.conf.set(key, value)
    yield
    for key in LIMITS:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """150,000 rows, a third of them for one of 2,000 employees."""
    root = tmp_path_factory.mktemp("scale")
    i = F.col("id")
    key = F.when(i % 3 == 0, 7).otherwise(F.pmod(F.xxhash64(i), F.lit(2000)))
    spark.range(0, 150_000, 1, 8).select(
        F.concat(F.lit("e"), key.cast("string"), F.lit("@x")).alias("email"),
        F.date_add(F.lit("2026-08-01").cast("date"), (i % 60).cast("int")).cast("string").alias("work_date"),
        F.concat((i % 30).cast("string"), F.lit("."), F.lpad((i % 100).cast("string"), 2, "0")).alias("hours_worked"),
        F.lit(1).cast("bigint").alias("payroll_run_id"),
    ).write.parquet(f"{root}/raw")
    spark.range(0, 1900).select(
        "id",
        F.concat(F.lit("e"), i.cast("string"), F.lit("@x")).alias("email"),
        (i % 60 + 20).cast("decimal(10,2)").alias("hourly_rate"),
    ).coalesce(1).write.parquet(f"{root}/employees")
    data.runs(spark, (1, 2026, 8), (2, 2026, 9), (3, 2026, 8)).coalesce(1).write.parquet(f"{root}/runs")
    return tuple(spark.read.parquet(f"{root}/{name}") for name in ("raw", "employees", "runs"))


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_email_is_split_in_the_lookup(spark, tables, lopsided):
    raw, employees, _ = tables
    classified = imports.classify(raw, employees).select("email", "outcome", "reason")
    rows = classified.collect()
    assert len(rows) == 150_000
    assert "SortMergeJoin(skew=true)" in final_plan(classified)


def test_large_and_small_inputs_give_the_same(spark, tables):
    raw, employees, runs = tables

    def figures():
        by_email = hours_ops.hours_by_email(imports.valid_rows(raw), employees, runs)
        entries = imports.import_accepted(raw, employees)
        by_id = hours_ops.hours_by_employee(entries, employees, runs)
        flags = review.review_flags(runs, by_id, "300")
        return (
            sorted(map(tuple, by_email.collect())),
            sorted(map(tuple, by_id.collect())),
            sorted(map(tuple, flags.collect())),
        )

    broadcast = figures()
    assert broadcast[0] == broadcast[1]
    for key, value in LIMITS.items():
        spark.conf.set(key, value)
    try:
        assert figures() == broadcast
    finally:
        for key in LIMITS:
            spark.conf.unset(key)


def test_rows_are_summed_before_they_travel(spark, tables):
    raw, employees, runs = tables
    hours = hours_ops.hours_by_email(imports.valid_rows(raw), employees, runs)
    hours.collect()
    plan = final_plan(hours)
    (exchange,) = [n for n, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning(email" in line]
    assert "partial_sum" in plan.splitlines()[exchange + 1]
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_run_states_are_reduced_without_a_window(spark, tmp_path):
    created = run_ops.create_runs(data.requests(spark, (1, 2026, 8)), data.AT)
    current = run_ops.current_runs(created)
    current.collect()
    plan = final_plan(current)
    assert "partial_max_by" in plan and "Window" not in plan and "SortAggregate" not in plan
