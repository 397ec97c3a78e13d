"""Exact top-k search against all scores sorted."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedgeline.llm import topk


def plainly(rows, asks, k, scale=64):
    """Lists of (query, rank, id, score), every pair scored with Python's numbers."""
    fit = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, v) in enumerate(fit):
        if asks(q):
            all_ = [(-sum(x * y for x, y in zip(v, w)), i is None, i or 0, n) for n, (i, w) in enumerate(fit) if n != at]  # noqa: B905
            out += [(q, rank, None if none else i, -s) for rank, (s, none, i, _) in enumerate(sorted(all_)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, rows, asks, k, kind="array<double>", **how):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}").selectExpr("*", "'x' AS row", "1 AS v", "2 AS rank", "3 AS score").repartition(3)
    got = topk.top_k(df, asks, k, **how)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, got.collect()), key=repr)


def test_edge_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(40)]
    rows += [(40, None), (41, [1.0, None, 0.0, 0.0, 0.0]), (42, [math.nan] * 5), (60, [math.inf, 0.0, 0.0, 0.0, 0.0]), (61, []), (80, [0.5]), (62, [9.0] * 7), (None, [1.0] * 5), (None, [1.0] * 5), (100, [1.0] * 5), (100, [1.0] * 5), (3, rows[3][1])]
    assert found(spark, rows, F.col("vec_id") % 20 == 0, 4) == plainly(rows, lambda q: q is not None and q % 20 == 0, 4)
    assert found(spark, rows, F.lit(True), 100) == plainly(rows, lambda q: True, 100)
    assert found(spark, [], F.col("vec_id") % 20 == 0, 4) == []
    assert found(spark, rows[:1], F.lit(True), 4) == []


def test_a_third_of_all_rows_alike_over_many_blocks(spark):
    rng = np.random.default_rng(4)
    one = rng.normal(size=8).astype(np.float32).tolist()
    rows = [(i, one if i % 3 == 0 else rng.normal(size=8).astype(np.float32).tolist()) for i in range(900)]
    want = plainly(rows, lambda q: q is not None and q % 20 == 0, 20)
    assert found(spark, rows, F.col("vec_id") % 20 == 0, 20, "array<float>", cells=8, slack=1, block=7, components=1000) == want


@pytest.mark.parametrize("size", [1e4, 1e7])
def test_long_vectors_are_exact(spark, size):
    rows = [(i, [size * math.sin(7 * i + j) for j in range(4)]) for i in range(60)]
    assert found(spark, rows, F.col("vec_id") % 20 == 0, 5) == plainly(rows, lambda q: q is not None and q % 20 == 0, 5)


def test_scores_over_64_bits_are_an_error(spark):
    with pytest.raises(ValueError, match="64 bits"):
        found(spark, [(0, [1e300]), (1, [1.0])], F.lit(True), 5)


def test_cells_beyond_their_range_count_no_score_twice(spark):
    # A range of 3 scores is divided into 8 cells; many rows have the scores above it, which earlier rounds counted.
    rows = [(i, [1.0, 0.0] if i == 0 else [(100 + (1 if i % 100 < 8 else 0 if i < 60 else -1)) / 64, 0.0]) for i in range(200)]
    rows += [(i, [(102 + i % 7) / 64, 1.0]) for i in range(201, 212)] + [(i, [(95 + i % 5) / 64, -1.0]) for i in range(221, 300)]
    for k, cells in ((20, 8), (20, 512), (60, 512)):
        assert found(spark, rows, F.col("vec_id") == 0, k, cells=cells, slack=0) == plainly(rows, lambda q: q == 0, k)
