"""A corpus query's rows against its SQL on the same tables."""

import math
from pathlib import Path

import duckdb


def norm(v):
    if isinstance(v, float):
        return round(v, 6) if math.isfinite(v) else str(v)
    return [norm(x) for x in v] if isinstance(v, (list, tuple)) else v


def same_rows(spark, queries, oracles, name, sf):
    df = queries[name](spark, sf)
    rows = sorted(repr([norm(r[c]) for c in sorted(df.columns)]) for r in df.collect())
    if name not in oracles:
        assert rows
        return
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from read_parquet('{p}')")
    got = con.sql(oracles[name])
    assert sorted(got.columns) == sorted(df.columns)
    k = [got.columns.index(c) for c in sorted(got.columns)]
    assert rows == sorted(repr([norm(r[i]) for i in k]) for r in got.fetchall())
