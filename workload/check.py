"""Compare every registered query with its SQL in DuckDB.

python -m workload.check [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from listingflow.session import build_session
from workload import QUERIES, SQL


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(value: object) -> object:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value


def sort_rows(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: tuple((v is None, type(v).__name__, v) for v in row))


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str:
    """Empty if both sides agree in columns, types and rows; else what differs."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = [tuple(normal(r[c]) for c in columns) for r in df.collect()]
    if name not in SQL:
        return "" if rows else "no rows"
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    at = [names.index(c) for c in columns]
    wanted = [tuple(normal(r[i]) for i in at) for r in result.fetchall()]
    kinds = dict(df.dtypes)
    found = {d[0]: str(d[1]) for d in result.description}
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    for c in columns:
        if same.get(kinds[c]) != found[c]:
            return f"type of {c}: {kinds[c]} != {found[c]}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows != {len(wanted)}"
    for a, b in zip(sort_rows(rows), sort_rows(wanted), strict=True):
        if a != b:
            return f"{columns}: {a} != {b}"
    return "" if rows else "both empty"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "check", "local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                            "spark.driver.memory": "8g", "spark.sql.shuffle.partitions": "8"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in wanted:
        begun = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '}{name} {time.time() - begun:.2f}s {problem}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree; {len(QUERIES) - len(SQL)} have no SQL")


if __name__ == "__main__":
    main()
