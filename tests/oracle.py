"""Compare a Spark result with DuckDB on the same Parquet tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def kind(t: pa.DataType) -> str:
    if pa.types.is_timestamp(t):
        return "timestamp" if t.tz is None else "timestamp with zone"
    return {"large_string": "string"}.get(str(t), str(t))


def normal(table: pa.Table) -> pd.DataFrame:
    frame = table.select(sorted(table.column_names)).to_pandas()
    for column in frame.columns:
        if str(frame[column].dtype).startswith("datetime64"):
            frame[column] = frame[column].astype("datetime64[us]")
    return frame.sort_values(list(frame.columns), na_position="last").reset_index(drop=True)


def compare(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Assert equal columns, types and rows, bit for bit; returns the row count."""
    mine, theirs = result.toArrow(), con.sql(sql).to_arrow_table()
    types = {f.name: kind(f.type) for f in mine.schema}
    assert types == {f.name: kind(f.type) for f in theirs.schema}
    left, right = normal(mine), normal(theirs)
    assert len(left) == len(right)
    pd.testing.assert_frame_equal(left, right, check_exact=True, check_dtype=False)
    return len(left)
