"""Scans of the business tables, from Parquet or over JDBC."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroll.schemas import LOOKUP_COLUMNS, PAYROLL_RUNS, TABLES
from tallyroll.sources import manifest
from tallyroll.sources.manifest import SEGMENT
from tallyroll.sources.storage import list_names

JDBC_TABLES = {
    "employees": "id",
    "timesheet_entries": "employee_id",
    "payroll_runs": "id",
    "payslips": "employee_id",
    "rejected_timesheet_entries": "payroll_run_id",
}


def table_path(root: str, name: str) -> str:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}, expected one of {sorted(TABLES)}")
    return f"{root.rstrip('/')}/{name}"


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table with its declared schema; empty before the first write.

    Of tables written by the sinks, the rows of committed segments are read. A folder of
    plain Parquet files, as ``employees`` is, is read as it is.
    """
    live = manifest.current(spark, root)
    if name != "payslips":
        return _stored(spark, root, name, live)
    if not live.of("payslips"):
        return spark.createDataFrame([], TABLES["payslips"][0])
    # The last commit that calculated a run has its payslips, if there are any.
    calculated = read_segments(spark, root, "payslip_runs", live.of("payslip_runs"))
    latest = calculated.groupBy("payroll_run_id").agg(F.max(SEGMENT).alias(SEGMENT))
    slips = read_segments(spark, root, "payslips", live.of("payslips"))
    return slips.join(latest, ["payroll_run_id", SEGMENT]).select(*TABLES["payslips"][0].fieldNames())


#: Keys of one lookup, as they are part of the query; larger sets are a table to join with.
MOST_KEYS = 1000


def find(spark: SparkSession, root: str, name: str, column: str, keys: list) -> DataFrame:
    """The rows of a stored table whose ``column`` is one of ``keys``, from the row groups that may hold them.

    The sinks sort files by the first lookup column and give each lookup column a Bloom filter
    per row group, so that ranges or filters leave out the row groups without a key. Spark
    passes on lists of up to a number of values to the files, so longer ones are split. Null keys match nothing.
    """
    if column not in LOOKUP_COLUMNS.get(name, ()):
        raise KeyError(f"{name} has no lookup by {column!r}")
    wanted = sorted({key for key in keys if key is not None})
    if len(wanted) > MOST_KEYS:
        raise ValueError(f"{len(wanted)} keys, at most {MOST_KEYS}: join with a table of keys instead")
    rows = load_table(spark, root, name)
    if not wanted:
        return rows.limit(0)
    passed = max(int(spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold")), 1)
    lists = [wanted[i : i + passed] for i in range(0, len(wanted), passed)]
    return rows.filter(reduce(or_, [F.col(column).isin(some) for some in lists]))


def _stored(spark: SparkSession, root: str, name: str, live: manifest.Manifest) -> DataFrame:
    schema, _ = TABLES[name]
    path = table_path(root, name)
    if live.of(name):
        return read_segments(spark, root, name, live.of(name)).drop(SEGMENT)
    if name in live.segments or not any(n.endswith(".parquet") or "=" in n for n in list_names(spark, path)):
        return spark.createDataFrame([], schema)
    return read_segments(spark, root, name, []).drop(SEGMENT) if _only_failed(spark, path, name) else spark.read.schema(schema).parquet(path)


def _only_failed(spark: SparkSession, path: str, name: str) -> bool:
    """Whether a folder without committed segments holds segments all the same: what failed jobs left."""
    folder = path
    for _ in TABLES[name][1]:
        folder = f"{folder}/{next(n for n in list_names(spark, folder) if '=' in n)}"
    return any(n.startswith(f"{SEGMENT}=") for n in list_names(spark, folder))


def read_segments(spark: SparkSession, root: str, name: str, segments: list[str]) -> DataFrame:
    """The rows of some segments of a table, with the segment of each. Other segments are pruned by their folders."""
    schema, _ = TABLES[name]
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(SEGMENT, T.StringType())])).parquet(table_path(root, name))
    return rows.filter(F.coalesce(SEGMENT, F.lit("")).isin(segments))


def load_month_sums(spark: SparkSession, root: str) -> DataFrame:
    """Hours by employee, month and import, in the columns that sums of hours read. Entries that have
    no sums, because they were not written by the sinks, stand for themselves."""
    live = manifest.current(spark, root)
    columns = TABLES["month_sums"][0].fieldNames()
    bare = [s for s in live.of("timesheet_entries") if s not in set(live.of("month_sums"))]
    if bare or not live.of("month_sums"):
        entries = read_segments(spark, root, "timesheet_entries", bare) if bare else _stored(spark, root, "timesheet_entries", live)
        entries = entries.withColumn("hours_worked", F.col("hours_worked").cast("decimal(14,2)")).select(*columns)
        if not live.of("month_sums"):
            return entries
        return _stored(spark, root, "month_sums", live).select(*columns).unionByName(entries)
    return _stored(spark, root, "month_sums", live)


def jdbc_options(
    url: str, name: str, lower: int, upper: int, partitions: int, fetch_size: int = 10_000
) -> dict[str, str]:
    """Reader options for a scan in ``partitions`` ranges of the id column.
    The bounds only place the ranges; rows outside them are read too."""
    return {
        "url": url,
        "dbtable": name,
        "partitionColumn": JDBC_TABLES[name],
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def load_jdbc_table(
    spark: SparkSession,
    url: str,
    name: str,
    lower: int,
    upper: int,
    partitions: int,
    **properties: str,
) -> DataFrame:
    """A table of a relational database, in the declared column types."""
    rows = (
        spark.read.format("jdbc")
        .options(**jdbc_options(url, name, lower, upper, partitions), **properties)
        .load()
    )
    return declared(rows, name)


def declared(rows: DataFrame, name: str) -> DataFrame:
    """Rows of a relational table in the declared column types. Entries get the
    month columns of the stored layout, which a database does not keep."""
    schema = PAYROLL_RUNS if name == "payroll_runs" else TABLES[name][0]
    if name == "timesheet_entries" and "work_year" not in rows.columns:
        rows = rows.withColumns({"work_year": F.year("work_date"), "work_month": F.month("work_date")})
    present = [field for field in schema.fields if field.name in rows.columns]
    return rows.select(*(F.col(field.name).cast(field.dataType).alias(field.name) for field in present))
