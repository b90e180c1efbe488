"""Run queries beside their SQL twins: ``python -m checks.compare <sf dir> [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as plain tuples, columns by name, rows sorted."""
    columns = sorted(df.columns)
    rows = [tuple(None if pd.isna(x) else x for x in row) for row in df[columns].itertuples(index=False)]
    return sorted(rows, key=lambda row: [(x is not None, str(type(x)), x if x is not None else 0) for x in row])


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf: str, name: str) -> str:
    """Empty when the query and its twin agree."""
    mine = QUERIES[name](spark, sf).toArrow()
    twin = con.sql(ORACLE[name]).to_arrow_table()
    if sorted(mine.column_names) != sorted(twin.column_names):
        return f"columns {sorted(mine.column_names)} against {sorted(twin.column_names)}"
    kinds = [(c, str(mine.schema.field(c).type), str(twin.schema.field(c).type)) for c in mine.column_names]
    odd = [k for k in kinds if k[1] != k[2]]
    a, b = canonical(mine.to_pandas()), canonical(twin.to_pandas())
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}"
    return f"types {odd}" if odd else ""


if __name__ == "__main__":
    folder = sys.argv[1]
    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    database = connect(folder)
    failed = 0
    for key in sys.argv[2:] or QUERIES:
        start = time.time()
        if key not in ORACLE:
            found = f"rows only: {QUERIES[key](session, folder).count()}"
        else:
            found = differences(session, database, folder, key)
            failed += bool(found)
        print(f"{key:28} {time.time() - start:6.2f}s  {found or 'ok'}", flush=True)
    print("failed:", failed)
