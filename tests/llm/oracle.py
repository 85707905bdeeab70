"""Holds a query's rows against those of its SQL in DuckDB."""

from __future__ import annotations

import duckdb


def same_rows(spark, query, sql: str, sf_dir: str) -> None:
    got = query(spark, sf_dir)
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    want = con.execute(sql).to_arrow_table().to_pylist()
    rows = [r.asDict() for r in got.collect()]
    assert sorted(got.columns) == sorted(want[0])
    order = sorted(got.columns)
    key = lambda r: tuple((r[c] is None, str(r[c])) for c in order)
    assert sorted(rows, key=key) == sorted(want, key=key)
