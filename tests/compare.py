"""Runs queries beside their SQL on the same tables.

``python -m tests.compare [folder] [name …]`` prints one line per query.
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[column]):
            frame[column] = frame[column].astype("datetime64[us]")
        elif str(frame[column].dtype) == "Int64" and frame[column].isna().any():
            frame[column] = frame[column].astype(float)  # as Spark gives whole numbers with nulls
    return frame.sort_values(list(frame.columns), ignore_index=True)


def difference(ours: pd.DataFrame, oracle: pd.DataFrame) -> str | None:
    """None when both hold the same rows, else what differs first."""
    if sorted(ours.columns) != sorted(oracle.columns):
        return f"columns {sorted(ours.columns)} / {sorted(oracle.columns)}"
    if len(ours) != len(oracle):
        return f"rows {len(ours)} / {len(oracle)}"
    left, right = normal(ours), normal(oracle)
    for column in left.columns:
        if left[column].dtype != right[column].dtype:
            return f"type of {column}: {left[column].dtype} / {right[column].dtype}"
        unequal = (left[column] != right[column]) & ~(left[column].isna() & right[column].isna())
        if pd.api.types.is_float_dtype(left[column]):
            unequal |= np.signbit(left[column]) != np.signbit(right[column])
        if unequal.any():
            at = unequal.idxmax()
            return f"{int(unequal.sum())} values of {column}, first {left.loc[at].to_dict()} / {right.loc[at].to_dict()}"
    return None


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from broadsheet.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        start = time.time()
        try:
            ours = entry.queries()[name](spark, sf_dir).toPandas()
            took = time.time() - start
            sql = entry.oracle_sql().get(name)
            verdict = "rows only" if sql is None else difference(ours, con.execute(sql).df()) or "equal"
        except Exception as error:  # noqa: BLE001
            ours, took, verdict = [], time.time() - start, f"ERROR {str(error)[:700]}"
        print(f"{name:28} {took:6.2f}s {len(ours):8} {verdict}", flush=True)


if __name__ == "__main__":
    main()
