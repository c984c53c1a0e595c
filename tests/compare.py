"""Runs registered queries against their SQL on DuckDB.

``python tests/compare.py [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path("/root/testdata")


def plain(v):
    """Value in a form both engines share."""
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return float(f"{float(v):.12g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def oracle(sf: str, sql: str):
    con = duckdb.connect()
    for f in (ROOT / sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def mismatch(spark, sf: str, query, sql: str | None) -> str | None:
    df = query(spark, str(ROOT / sf))
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None
    want_columns, want = oracle(sf, sql)
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    if not want:
        return "no rows on either side"
    for g, w in zip(got, want):
        if g != w:
            bad = [(c, a, b) for c, a, b in zip(got_columns, g, w) if a != b]
            return f"first difference {bad}"
    return None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from salesmill.session import build
    from salesmill.workload import everything

    spark = build("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = everything()
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.001"
    names = sys.argv[2:] or list(queries)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = mismatch(spark, sf, queries[name], sql.get(name))
        except Exception as err:  # noqa: BLE001
            problem = f"{type(err).__name__}: {str(err)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{time.time() - start:7.2f}s  {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} match")


if __name__ == "__main__":
    main()
