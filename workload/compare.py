"""Run queries next to their SQL and compare names, types, counts and values.

``python -m workload.compare [sf_dir] [query ...]``
"""

from __future__ import annotations

import sys
import time

import duckdb
import pyarrow as pa

from starload.session import session_builder
from workload.oracle import ORACLE
from workload.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _kind(dtype: pa.DataType) -> str:
    return "string" if pa.types.is_string(dtype) or pa.types.is_large_string(dtype) else str(dtype)


def _rows(table: pa.Table, names: list[str]) -> list[tuple]:
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=lambda row: tuple((v is not None, str(v)) for v in row))


def difference(ours: pa.Table, theirs: pa.Table) -> str | None:
    """What differs, or None; row order and column order do not count."""
    names = sorted(ours.column_names)
    if names != sorted(theirs.column_names):
        return f"columns {names} / {sorted(theirs.column_names)}"
    kinds = [
        (n, _kind(ours.schema.field(n).type), _kind(theirs.schema.field(n).type)) for n in names
    ]
    unlike = [k for k in kinds if k[1] != k[2]]
    if unlike:
        return f"types {unlike}"
    if ours.num_rows != theirs.num_rows:
        return f"rows {ours.num_rows} / {theirs.num_rows}"
    for a, b in zip(_rows(ours, names), _rows(theirs, names)):
        if a != b:
            return f"values {a} / {b}"
    return None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = (
        session_builder("compare")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        begin = time.perf_counter()
        try:
            ours = QUERIES[name](spark, sf_dir).toArrow()
            took = time.perf_counter() - begin
            theirs = connection.sql(ORACLE[name]).to_arrow_table()
            found = difference(ours, theirs)
        except Exception as error:  # report every query, whatever happens to one
            took, found = time.perf_counter() - begin, f"{type(error).__name__}: {str(error)[:600]}"
            ours = None
        failed += found is not None
        print(f"{name:32} {took:6.2f}s {ours.num_rows if ours else 0:8} {found or 'ok'}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
