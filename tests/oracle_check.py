"""Run registered queries in Spark and their SQL oracles in DuckDB and compare
the results as multisets (columns matched by name).

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import collections
import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = [tuple(_norm(v) for v in r) for r in rel.fetchall()]
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} oracle={d_cols}")
    else:
        order = [d_cols.index(c) for c in s_cols]
        d_rows = [tuple(r[i] for i in order) for r in d_rows]
        cs, cd = collections.Counter(s_rows), collections.Counter(d_rows)
        if cs != cd:
            only_s = list((cs - cd).elements())[:3]
            only_d = list((cd - cs).elements())[:3]
            problems.append(f"rows spark={len(s_rows)} oracle={len(d_rows)} "
                            f"only_spark={only_s} only_oracle={only_d}")
    return problems, len(s_rows), t1 - t0


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from histdim.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, os_ = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in (names or sorted(os_)):
        try:
            problems, n, secs = compare(spark, con, name, qs[name], os_[name], sf_dir)
        except Exception as e:  # report and continue
            problems, n, secs = [f"error {type(e).__name__}: {str(e)[:400]}"], -1, 0
        bad += bool(problems)
        print(f"{'OK ' if not problems else 'BAD'} {name:32s} rows={n:7d} {secs:6.1f}s "
              + "; ".join(problems), flush=True)
    print(f"{len(names or os_) - bad} ok, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
