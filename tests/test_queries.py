"""Every registered query that has SQL against DuckDB, on the smallest tables; the others run."""

import math
import os
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

from sedgeline import registry  # noqa: E402


def norm(v):
    if isinstance(v, float):
        return round(v, 6) if math.isfinite(v) else str(v)
    return [norm(x) for x in v] if isinstance(v, (list, tuple)) else v


def same_rows(spark, queries, oracles, name, sf=SF):
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


@pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    same_rows(spark, registry.QUERIES, registry.ORACLES, name)


def test_registry_imports_nothing_of_the_corpus_operators():
    for p in Path(__file__).resolve().parents[1].joinpath("sedgeline").rglob("*.py"):
        if "llm" not in p.parts:
            assert ".llm" not in p.read_text() and "llm import" not in p.read_text(), p
