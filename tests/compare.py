"""Run every query and its DuckDB SQL on one data folder and compare the rows."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    text = frame.map(lambda v: "" if v is None or v is pd.NA or v != v else
                     f"{v + 0.0:.6f}" if isinstance(v, float) else str(v))
    return text.sort_values(list(text.columns), ignore_index=True)


def difference(spark_rows: pd.DataFrame, duck_rows: pd.DataFrame) -> str:
    if sorted(spark_rows.columns) != sorted(duck_rows.columns):
        return f"columns {sorted(spark_rows.columns)} against {sorted(duck_rows.columns)}"
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows against {len(duck_rows)}"
    left, right = normal(spark_rows), normal(duck_rows)
    unequal = (left != right).any(axis=1)
    if unequal.any():
        return f"{unequal.sum()} rows differ, first:\n{left[unequal].head(3)}\n{right[unequal].head(3)}"
    return ""


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tests.session import local_session

    spark = local_session()
    connection, oracle, failed = duck_connection(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            rows = query(spark, folder).toPandas()
            took, start = time.time() - start, time.time()
            problem = difference(rows, connection.execute(oracle[name]).df()) if name in oracle else "no SQL"
        except Exception as error:  # show all failures in one run
            problem, rows, took = f"{type(error).__name__}: {str(error)[:1500]}", [], time.time() - start
        failed += bool(problem) and name in oracle
        print(f"{name:28} {len(rows):7} rows  spark {took:6.2f}s  duckdb {time.time() - start:6.2f}s  {problem or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
