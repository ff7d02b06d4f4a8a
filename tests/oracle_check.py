"""Run registered queries against their SQL: python tests/oracle_check.py [sf] [name-prefix ...]"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from riskspark.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
    )


def compare(spark_df, rel):
    """None when equal, else a short reason."""
    names, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want_names, want = rows_of(rel.columns, rel.fetchall())
    if names != want_names:
        return f"columns {names} vs {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}; first {got[:1]} vs {want[:1]}"
    for g, w in zip(got, want):
        if g != w or any(type(a) is not type(b) for a, b in zip(g, w)):
            diff = [(n, a, b) for n, a, b in zip(names, g, w) if a != b or type(a) is not type(b)]
            return f"{len([1 for a, b in zip(got, want) if a != b])} rows differ, e.g. {diff[:4]}"
    return None


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session()
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = []
    for name, fn in queries.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                why = compare(df, con.sql(oracles[name]))
            else:
                why = None if df.count() > 0 else "no rows"
        except Exception as e:  # report and go on with the next query
            why = f"{type(e).__name__}: {str(e)[:300]}"
        took = time.time() - t0
        kind = "sql" if name in oracles else "rows"
        if why:
            bad.append(name)
        if why or took > 8 or prefixes:
            print(f"{'BAD ' if why else 'ok  '} {name} [{kind}] {took:.1f}s {why or ''}", flush=True)
    print(f"{len(bad)} bad: {bad}")
