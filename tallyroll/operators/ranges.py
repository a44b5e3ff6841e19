"""Contiguous employee id ranges and the rows that fall into them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_bounds(employees: DataFrame) -> DataFrame:
    """Lowest and highest employee id, null without employees."""
    return employees.agg(F.min("id").alias("min_id"), F.max("id").alias("max_id"))


def range_width(low: Column, high: Column, parts: Column) -> Column:
    """Ids per range: the span divided by the number of ranges, rounded up."""
    return F.call_function("div", high - low + parts, parts)


def slice_of_id(employee_id: Column, low: Column, high: Column, parts: Column) -> Column:
    """Number of the range that holds an id, counted from 0."""
    return F.call_function("div", employee_id - low, range_width(low, high, parts))


def id_ranges(employees: DataFrame, grid_size: int) -> DataFrame:
    """Up to ``grid_size`` ranges of equal width, without gap or overlap, the
    last one holding the rest. Without employees there is one range (1, 0),
    which holds nothing."""
    grid = F.lit(grid_size).cast("bigint")
    planned = id_bounds(employees).withColumn(
        "width", range_width(F.col("min_id"), F.col("max_id"), grid)
    )
    starts = planned.select(
        "max_id", "width", F.posexplode_outer(F.expr("sequence(min_id, max_id, width)")).alias("pos", "start")
    )
    end = F.least(F.col("start") + F.col("width") - 1, F.col("max_id"))
    return starts.select(
        F.coalesce("pos", F.lit(0)).alias("range_id"),
        F.coalesce("start", F.lit(1)).cast("bigint").alias("min_id"),
        F.when(F.col("start").isNull(), 0).otherwise(end).cast("bigint").alias("max_id"),
    )


def assign_range(rows: DataFrame, employees: DataFrame, grid_size: int, id_column: str = "employee_id") -> DataFrame:
    """Add the ``range_id`` of each row. The two bounds are one-row subqueries,
    so the rows are neither joined nor shuffled."""
    bounds = employees.agg(
        F.struct(F.min("id").alias("low"), F.max("id").alias("high")).alias("bounds")
    ).scalar()
    grid = F.lit(grid_size).cast("bigint")
    number = slice_of_id(F.col(id_column), bounds.getField("low"), bounds.getField("high"), grid)
    return rows.withColumn("range_id", number.cast("int"))
