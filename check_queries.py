"""Compare registered queries with their SQL: python check_queries.py [sf] [name ...]."""

from __future__ import annotations

import datetime
import sys
import time

import duckdb
import numpy as np
import pandas as pd

from hearthmill.queries import ORACLES, QUERIES
from hearthmill.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if value is None or pd.isna(value):
        return None
    if isinstance(value, (pd.Timestamp, datetime.date)):
        return str(pd.Timestamp(value))
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    return float(value) if isinstance(value, (int, float, np.number)) else value


def rows_of(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted(map(repr, [tuple(map(plain, row)) for row in pdf.itertuples(index=False, name=None)]))


def main() -> int:
    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con, failed = local_session(8), duckdb.connect(), 0
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    for name in names or QUERIES:
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            spent = time.time() - start
            if name not in ORACLES:
                print(f"rows  {name} {len(got)} {spent:.1f}s")
                continue
            want = con.execute(ORACLES[name]).df()
            types = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got if c in want and got[c].dtype != want[c].dtype}
            left, right = rows_of(got), rows_of(want)
            same = sorted(got.columns) == sorted(want.columns) and left == right
            print(f"{'ok   ' if same else 'DIFF '} {name} {len(got)} {len(want)} {spent:.1f}s {types or ''}")
            if not same:
                failed += 1
                print("   cols", sorted(got.columns), sorted(want.columns))
                print("   only spark", sorted(set(left) - set(right))[:2])
                print("   only sql  ", sorted(set(right) - set(left))[:2])
        except Exception as problem:
            failed += 1
            print(f"FAIL  {name} {type(problem).__name__}: {str(problem)[:700]}")
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
