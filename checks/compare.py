"""Run queries and their SQL side by side: ``python -m checks.compare FOLDER [name prefix…]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.oracle import oracle_sql
from checks.registry import QUERIES
from lexmill.runtime import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(rows: pd.DataFrame) -> pd.DataFrame:
    """Columns by name and rows by value."""
    rows = rows[sorted(rows.columns)]
    return rows.sort_values(list(rows.columns), kind="stable").reset_index(drop=True)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """What is different, or None."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    a, b = canonical(ours), canonical(theirs)
    for column in a.columns:
        left, right = a[column], b[column]
        if left.dtype.kind != right.dtype.kind:
            left, right = left.astype(object).where(left.notna(), None), right.astype(object).where(right.notna(), None)
        same = (left == right) | (left.isna() & right.isna())
        if not same.all():
            at = same.idxmin()
            return f"{(~same).sum()} values of {column}, first {left[at]!r} / {right[at]!r}"
    return None


def main(folder: str, prefixes: list[str]) -> int:
    spark = local_session(cores="8", **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(folder), oracle_sql(), 0
    for name, run in QUERIES.items():
        if prefixes and not name.startswith(tuple(prefixes)):
            continue
        start = time.time()
        ours = run(spark, folder).toPandas()
        middle = time.time()
        verdict = "no SQL"
        if name in sql:
            verdict = difference(ours, con.execute(sql[name]).df()) or "same"
            failed += verdict != "same"
        print(f"{name:28s} {len(ours):8d} {middle - start:7.2f} {time.time() - middle:7.2f}  {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
