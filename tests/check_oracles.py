"""Compare registered queries with their SQL: ``python tests/check_oracles.py [sf_dir] [query ...]``."""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from linkwell.testing import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def main(sf_dir, names):
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = [n for n in oracles if n not in queries]
    for name in names or list(queries):
        start = time.time()
        df = queries[name](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        spent = time.time() - start
        if name not in oracles:
            print(f"{name:26} rows={len(rows):7} spark={spent:6.2f}s  no SQL", flush=True)
            continue
        start = time.time()
        cursor = con.execute(oracles[name])
        columns = [d[0] for d in cursor.description]
        wanted = cursor.fetchall()
        took = time.time() - start
        types = dict(df.dtypes)
        ok = sorted(df.columns) == sorted(columns) and plain(rows, df.columns) == plain(wanted, columns)
        print(f"{name:26} rows={len(rows):7} spark={spent:6.2f}s sql={took:6.2f}s {'ok' if ok else 'DIFFERS'}", flush=True)
        if not ok:
            failed.append(name)
            a, b = plain(rows, df.columns), plain(wanted, columns)
            print("   ", types, columns, len(a), len(b))
            sa, sb = set(map(repr, a)), set(map(repr, b))
            print("    spark only:", sorted(sa - sb)[:3], "\n    sql only:", sorted(sb - sa)[:3])
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(main(args[0] if args else "/root/testdata/sf0.01", args[1:]))
