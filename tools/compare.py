"""Run registered queries next to their SQL on the same tables and compare the rows.

    python tools/compare.py [--sf DIR] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sf_dir, df=None) -> tuple[bool, str]:
    started = time.time()
    df = query.run(spark, sf_dir) if df is None else df
    got_columns = df.columns
    got = rows_of(got_columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    n = sum(got.values())
    if not query.sql:
        return True, f"{n} rows, no SQL, {took:.1f}s"
    started = time.time()
    cur = con.execute(query.sql)
    want_columns = [d[0] for d in cur.description]
    want = rows_of(want_columns, cur.fetchall())
    sql_took = time.time() - started
    if sorted(got_columns) != sorted(want_columns):
        return False, f"columns differ: {sorted(set(got_columns) ^ set(want_columns))}"
    if got != want:
        extra, lost = got - want, want - got
        a = next(iter(extra), None)
        b = next(iter(lost), None)
        names = sorted(got_columns)
        text = f"{n} rows vs {sum(want.values())}, {sum(extra.values())} extra, {sum(lost.values())} missing"
        if a and b:
            best = min(lost, key=lambda r: sum(x != y for x, y in zip(a, r)))
            diff = [(c, x, y) for c, x, y in zip(names, a, best) if x != y]
            text += f"\n    e.g. {dict(zip(names, a))}\n    differs in (column, spark, sql): {diff[:6]}"
        else:
            text += f"\n    e.g. {dict(zip(names, a or b))}"
        return False, text
    return True, f"{n} rows, spark {took:.1f}s, sql {sql_took:.1f}s"


def main() -> int:
    from stallworks.catalog import REGISTRY
    from stallworks.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session()
    con = connect(args.sf)
    bad = 0
    for name, query in REGISTRY.items():
        if args.names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in args.names):
            continue
        try:
            ok, text = compare(spark, con, query, args.sf)
        except Exception as error:
            ok, text = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {text}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
