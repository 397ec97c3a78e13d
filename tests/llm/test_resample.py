"""Importance resampling against the same counts, gains and order in plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sedgeline.llm import resample


def plainly(rows, target, percent=10, least_words=20, shortest=1, longest=1, buckets=10_000, seed=2024):
    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return ws, [zlib.crc32(" ".join(ws[i : i + n]).encode()) % buckets for n in range(shortest, longest + 1) for i in range(len(ws) - n + 1)]

    seen = [(d, *features(t)) for d, t in rows]
    s, t = Counter(b for _, _, fs in seen for b in fs), Counter(b for x in target for b in features(x)[1])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in s}
    out = []
    for d, ws, fs in seen:
        weight = sum(gain[b] for b in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, len(ws), len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    most = percent * len(fit) // 100
    drawn = Counter((*r, k) for k, r in enumerate(fit[:most], 1))
    rest = Counter(out) - Counter(r[:5] for r in drawn.elements())
    return sorted([*drawn.elements(), *((*r, None) for r in rest.elements())], key=repr)


ROWS = [(k, " ".join(f"Word{(j * j + k) % (7 + k % 5)}" for j in range(k % 60))) for k in range(200)] + [(300, None), (301, ""), (302, "!?"), (None, "Ünder der Über x" * 9), (303, "a\x00b ÄÄ é" * 8), (5, "again word1 " * 15)]
TARGET = ["word1 word2 word3", "Word1, word2!", None, "", "über"]


@pytest.mark.parametrize("how", [{}, {"percent": 50, "least_words": 1, "shortest": 1, "longest": 3, "buckets": 97}, {"percent": 100, "shortest": 2, "longest": 2, "seed": 7}, {"percent": 0}])
def test_as_plainly(spark, how):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 AS row", "'x' AS rank", "2 AS bucket", "3 AS weight").repartition(5)
    target = spark.createDataFrame([(t, 1) for t in TARGET], "text string, bucket int")
    got = resample.resample(df, target, **how)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == plainly(ROWS, TARGET, **how)


def test_empty_tables(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    none = df.limit(0)
    assert resample.resample(none, df).collect() == []
    assert sorted(map(tuple, resample.resample(df, none).collect()), key=repr) == plainly(ROWS, [])


def test_rows_all_alike_are_ranked_over_partitions(spark):
    df = spark.createDataFrame([(1, "w " * 25)] * 600, "doc_id long, text string").repartition(6)
    got = resample.resample(df, df.limit(1))
    assert sorted(r["rank"] for r in got.where("rank is not null").collect()) == list(range(1, 61))
    assert got.select("weight", "score").distinct().count() == 1


def test_ranks_of_a_distributed_sort(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select("id", (F.col("id") * 7919 % 5000).alias("x"))
        assert df.repartitionByRange(F.col("x").desc()).rdd.getNumPartitions() > 1
        assert all(r["rank"] == 5000 - r["x"] for r in resample.ranked(df, F.col("x").desc()).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_bounds(spark):
    df = spark.createDataFrame(ROWS[:3], "doc_id long, text string")
    for how in ({"buckets": 0}, {"buckets": resample.MOST_BUCKETS + 1}, {"shortest": 2, "longest": 1}, {"percent": 101}):
        with pytest.raises(ValueError, match=r"buckets|percent"):
            resample.resample(df, df, **how)
