"""Run named queries and their comparison SQL side by side.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "benchmark", "labels", "conversations")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    """Rows as comparable tuples, sorted; columns in name order."""
    df = df[sorted(df.columns)]
    rows = [tuple(None if v is None or v is pd.NA or (isinstance(v, float) and v != v) else v
                  for v in row) for row in df.astype(object).itertuples(index=False)]
    return sorted(rows, key=repr)


def differences(spark: SparkSession, con, name: str, run, sql: str, folder: str) -> list[str]:
    got_df = run(spark, folder).toPandas()
    want_df = con.execute(sql).df()
    if sorted(got_df.columns) != sorted(want_df.columns):
        return [f"columns {sorted(got_df.columns)} != {sorted(want_df.columns)}"]
    found = [f"type of {c}: {got_df[c].dtype} != {want_df[c].dtype}" for c in got_df.columns
             if len(got_df) and got_df[c].notna().all() and want_df[c].notna().all()
             and got_df[c].dtype.kind != want_df[c].dtype.kind]
    got, want = normal(got_df), normal(want_df)
    if len(got) != len(want):
        found.append(f"{len(got)} rows != {len(want)}")
    found += [f"{g} != {w}" for g, w in zip(got, want) if g != w][:3]
    return found


def main() -> int:
    import __spark_entry__ as entry
    from tallyflow.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", extra={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, run in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        sql = entry.oracle_sql().get(name)
        if sql is None:
            print(f"{name:22} {len(run(spark, folder).toPandas())} rows, no SQL")
            continue
        found = differences(spark, con, name, run, sql, folder)
        rows = con.execute(f"select count(*) from ({sql})").fetchall()[0][0]
        print(f"{name:22} {'ok' if not found else 'DIFFERS':8} {rows:7} rows "
              f"{time.time() - start:6.1f} s", *found, sep="\n    " if found else " ")
        failed += bool(found)
    return failed


if __name__ == "__main__":
    sys.exit(main())
