"""Runs queries against DuckDB and compares the sorted rows.

    python tests/oracle_check.py [sf] [query ...]
"""

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, build, sql, sf_dir):
    """(spark rows, differing rows, message)."""
    df = build(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    if sorted(columns) != sorted(df.columns):
        return len(got), -1, f"columns {sorted(df.columns)} / {sorted(columns)}"
    want = rows_of(columns, cur.fetchall())
    if got == want:
        return len(got), 0, ""
    extra, lacking = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return len(got), max(len(extra), len(lacking), abs(len(got) - len(want))), f"{len(want)} {extra[:2]} {lacking[:2]}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from pulsegrid.session import local_session

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    spark = local_session(cores=8)
    con, builds, sqls = duck(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or builds:
        start = time.time()
        try:
            if name in sqls:
                n, differing, message = compare(spark, con, name, builds[name], sqls[name], sf_dir)
            else:
                n, differing, message = builds[name](spark, sf_dir).count(), 0, "rows only"
        except Exception as e:
            n, differing, message = 0, -2, f"{type(e).__name__} {str(e)[:600]}"
        bad += differing != 0
        print(f"{'ok ' if differing == 0 else 'BAD'} {name:24} rows {n:7} differing {differing:6} {time.time() - start:6.2f}s {message}", flush=True)
    print("bad", bad)
