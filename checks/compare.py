"""Run queries and their SQL side by side: ``python -m checks.compare [sf_dir] [names...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from glob import glob
from pathlib import Path

import duckdb

from checks.oracle import ORACLE
from checks.registry import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def sql_rows(connection, sql: str) -> tuple[list[str], list[str], Counter]:
    """Column names in order, their types, and the rows with their counts."""
    result = connection.sql(sql)
    order = sorted(range(len(result.columns)), key=lambda i: result.columns[i])
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return [result.columns[i] for i in order], [str(result.types[i]).lower() for i in order], rows


def spark_rows(df) -> tuple[list[str], list[str], Counter]:
    names = sorted(df.columns)
    ordered = df.select(*names)
    types = [kind.replace("string", "varchar") for _, kind in ordered.dtypes]
    return names, types, Counter(tuple(row) for row in ordered.collect())


def difference(spark, connection, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    names, types, got = spark_rows(QUERIES[name](spark, sf_dir))
    want_names, want_types, want = sql_rows(connection, ORACLE[name])
    if names != want_names:
        return f"columns {names} against {want_names}"
    if types != want_types:
        return f"types {dict(zip(names, types))} against {dict(zip(names, want_types))}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; "
            f"extra {list(extra.items())[:2]}, missing {list(missing.items())[:2]}"
        )
    if not want:
        return "no rows to compare"
    return None


def main() -> int:
    from tallyroll.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.perf_counter()
        try:
            problem = difference(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.perf_counter() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failures} differences")
    return failures


if __name__ == "__main__":
    sys.exit(main())
