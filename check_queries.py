"""Run queries and their SQL side by side: python check_queries.py [name ...]

Compares column names, row counts and values (sorted columns, sorted rows).
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

from lopside import build_session
from lopside.queries import QUERIES, SQL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = [tuple(None if v is None or v is pd.NaT or (isinstance(v, float) and v != v) else
                  (v.item() if hasattr(v, "item") else v) for v in row)
            for row in df.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = normal(got), normal(want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}"
    kinds = [(c, str(got[c].dtype), str(want[c].dtype)) for c in sorted(got.columns)
             if got[c].dtype.kind != want[c].dtype.kind and len(got)]
    return f"types differ {kinds}" if kinds else None


def main() -> int:
    folder = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = []
    for name in names:
        start = time.time()
        try:
            got = QUERIES[name](spark, folder).toPandas()
            spent = time.time() - start
            if name in SQL:
                start = time.time()
                want = con.execute(SQL[name]).fetchdf()
                problem = compare(got, want)
                note = f"sql {time.time() - start:.1f}s"
            else:
                problem, note = (None if len(got) else "no rows"), "rows only"
        except Exception as error:  # report and go on
            spent, problem, note = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}", ""
            got = []
        if problem:
            failed.append(name)
        print(f"{'FAIL' if problem else 'ok  '} {name} {len(got)} rows {spent:.1f}s {note} {problem or ''}", flush=True)
    print(f"{len(names) - len(failed)} ok, failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
