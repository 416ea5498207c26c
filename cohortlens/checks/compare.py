"""Run registered queries and their DuckDB twins on the same files and compare.

    python -m cohortlens.checks.compare /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

from cohortlens import session
from cohortlens.checks.oracle import oracle
from cohortlens.checks.queries import QUERIES

# Spark type -> DuckDB type of the same meaning.
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(x):
    if isinstance(x, float):
        if math.isnan(x):
            return "NaN"
        return x + 0.0
    return x


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: column names, types, or the multiset of rows."""
    names = sorted(df.columns)
    rows = Counter(tuple(_plain(r[c]) for c in names) for r in df.collect())
    kinds = dict(df.dtypes)
    result = con.execute(sql)
    theirs = [d[0] for d in result.description]
    if sorted(theirs) != names:
        return [f"columns {names} against {sorted(theirs)}"]
    out = [f"type of {d[0]}: {kinds[d[0]]} against {d[1]}" for d in result.description
           if SAME_TYPE.get(kinds[d[0]]) != str(d[1])]
    at = [theirs.index(c) for c in names]
    expected = Counter(tuple(_plain(r[i]) for i in at) for r in result.fetchall())
    if rows != expected:
        more, less = rows - expected, expected - rows
        out.append(f"{sum(rows.values())} rows against {sum(expected.values())}; "
                   f"only here {list(more)[:3]}; only there {list(less)[:3]}; columns {names}")
    if not rows:
        out.append("no rows at all")
    return out


def main(folder: str, keys: list[str]) -> int:
    spark = session.local()
    spark.sparkContext.setLogLevel("ERROR")
    con, twins, bad = connect(folder), oracle(), 0
    for key in keys or list(QUERIES):
        start = time.time()
        try:
            df = QUERIES[key](spark, folder)
            if key in twins:
                found = differences(df, con, twins[key])
            else:
                found = [] if df.count() else ["no rows at all"]
        except Exception as e:  # keep going, the point is the list of failures
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        mark = "ok " if not found else "BAD"
        print(f"{mark} {key} {time.time() - start:.1f}s {'' if key in twins else '(no twin)'}",
              *found, sep="\n      " if found else " ", flush=True)
    print(f"{bad} of {len(keys or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
