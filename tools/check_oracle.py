"""Run registered queries on Spark and their SQL on DuckDB, and compare.

    python tools/check_oracle.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from adlake.catalog import ORACLES, QUERIES  # noqa: E402
from adlake.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(x):
    """Comparable form of a value from either engine."""
    if x is None:
        return None
    if hasattr(x, "item") and not isinstance(x, (list, tuple)) and getattr(x, "ndim", 1) == 0:
        x = x.item()
    if isinstance(x, float):
        return None if math.isnan(x) else x + 0.0
    if isinstance(x, (list, tuple)) or hasattr(x, "tolist"):
        return tuple(cell(v) for v in x)
    return x


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([cell(r[i]) for i in order] for r in data), key=lambda r: [(v is not None, str(v)) for v in r])


def close(a, b, tol=1e-9):
    if isinstance(a, float) and isinstance(b, (int, float)):
        return a == b or abs(a - b) <= tol * max(1.0, abs(a), abs(b))
    return a == b


def compare(spark_df, con, sql):
    """(verdict, note)"""
    data = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    duck_cols = [d[0] for d in cur.description]
    duck_types = {d[0]: str(d[1]) for d in cur.description}
    duck = cur.fetchall()
    if sorted(spark_df.columns) != sorted(duck_cols):
        return "COLUMNS", f"{sorted(spark_df.columns)} != {sorted(duck_cols)}"
    if len(data) != len(duck):
        return "ROWS", f"{len(data)} != {len(duck)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT"}
    notes = [f"{n}:{t}/{duck_types[n]}" for n, t in spark_df.dtypes if kinds.get(t) and kinds[t] != duck_types[n]]
    a, b = rows_of(spark_df.columns, data), rows_of(duck_cols, duck)
    if a == b:
        return ("OK" if not notes else "TYPES"), f"{len(a)} rows {' '.join(notes)}"
    near = all(close(x, y) for r, s in zip(a, b) for x, y in zip(r, s))
    bad = next((r, s) for r, s in zip(a, b) if r != s)
    return ("NEAR" if near else "VALUES"), f"{len(a)} rows; {bad[0]} vs {bad[1]} {' '.join(notes)}"


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = local_session(), connect(sf_dir)
    names = [n for n in QUERIES if not args.names or any(n.startswith(a) for a in args.names)]
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                verdict, note = compare(df, con, ORACLES[name])
            else:
                verdict, note = "ROWSONLY", f"{len(df.collect())} rows"
        except Exception as e:  # report and go on with the next query
            verdict, note = "ERROR", str(e)[:500]
        failed += verdict not in ("OK", "ROWSONLY")
        print(f"{verdict:9} {name:28} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{len(names)} queries, {failed} not equal")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
