"""Run registered queries beside their SQL twins and compare all rows.

``python -m tests.compare [--sf sf0.01] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time
import traceback
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    """A value in a form that is equal in both engines."""
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v == int(v) and abs(v) < 1e15 else float(f"{v:.12g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, fn, sql):
    """(problem text or None, rows, seconds)."""
    start = time.time()
    df = fn(spark, folder)
    got_rows = df.collect()
    spent = time.time() - start
    names, got = rows_of(df.columns, got_rows)
    if sql is None:
        return None, len(got_rows), spent
    cur = con.execute(sql)
    sql_names, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if names != sql_names:
        return f"columns {names} against {sql_names}", len(got_rows), spent
    if got != want:
        extra, missing = got - want, want - got
        text = f"{sum(extra.values())} rows extra, {sum(missing.values())} missing of {sum(want.values())}"
        return f"{text}; got {list(extra)[:2]} want {list(missing)[:2]}", len(got_rows), spent
    return None, len(got_rows), spent


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="sf0.01")
    parser.add_argument("--only-sql", action="store_true")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sys.path.insert(0, ".")
    from riskloom.plans.catalog import ORACLES, QUERIES
    from riskloom.runtime import build_session

    spark = build_session("compare", 8, **{"spark.ui.showConsoleProgress": "false"})
    folder = f"/root/testdata/{args.sf}"
    con = connect(folder)
    failed = 0
    for name, fn in QUERIES.items():
        if args.names and not any(n in name for n in args.names):
            continue
        if args.only_sql and name not in ORACLES:
            continue
        try:
            problem, n, spent = compare(spark, con, folder, fn, ORACLES.get(name))
        except Exception as e:
            problem, n, spent = f"{type(e).__name__}: {str(e)[:900]}", 0, 0.0
            if "-v" in args.names:
                traceback.print_exc()
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={n} {spent:.1f}s {'' if name in ORACLES else '(rows only) '}{problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
