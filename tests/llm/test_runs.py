"""Periodic runs against every period of every stretch, and the query against its contract done plainly."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sedgeline.llm import queries, runs


def plainly(s, least=24, times=3):
    """For each period, the stretches in which all words a period apart are alike; of equal ones the smallest period."""
    found = {}
    for q in range(1, len(s) // times + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((x, y - x, q) for (x, y), q in found.items())


def made(rng, n):
    """Words with repeats in repeats."""
    out = []
    while len(out) < n:
        part = [rng.randrange(rng.choice((2, 5, 400))) for _ in range(rng.randrange(1, 40))]
        out += part * rng.choice((1, 1, 2, 3, 4, 30)) + part[: rng.randrange(len(part) + 1)]
    return out[:n]


def test_divided_as_plainly():
    rng = random.Random(1)
    for k in range(400):
        s = made(rng, rng.randrange(0, 300))
        for least, times in ((24, 3), (6, 2), (30, 4))[k % 3 :][:1]:
            assert runs.runs_of(s, least, times) == plainly(s, least, times)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=60))
def test_two_words_as_plainly(s):
    assert runs.runs_of(s, 4, 2) == plainly(s, 4, 2)


@pytest.mark.parametrize(("least", "times"), [(24, 3), (6, 2), (25, 3), (7, 5)])
def test_windows_lose_no_run(least, times):
    rng = random.Random(least)
    for _ in range(60):
        texts = [made(rng, rng.randrange(0, 200)) for _ in range(rng.randrange(1, 9))]
        counts = np.array([len(t) for t in texts])
        hashes = np.array([w * 0x9E3779B97F4A7C15 % 2**64 for t in texts for w in t], np.uint64)
        got = runs.windows(hashes, counts, least, times)
        at = np.cumsum(counts) - counts
        for a, t in zip(at.tolist(), texts, strict=True):
            want = plainly(t, least, times)
            mine = [(x - a, y - a) for x, y in got if a <= x < a + len(t)]
            assert all(any(x <= s and s + n <= y for x, y in mine) for s, n, _ in want)
            assert sorted((x + s, n, q) for x, y in mine for s, n, q in runs.runs_of(t[x:y], least, times)) == want


def test_edge_rows(spark):
    long = " ".join(f"w{i % 7}" for i in range(50_000))
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a " * 30), (4, "a " * 30), (None, "x y " * 20), (5, long), (6, "a b  c " * 9), (7, "one two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS runs", "'x' AS n_words", "2 AS collapsed").repartition(2)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.find_runs(df).collect()), key=repr)
    want = [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 30, [(0, 30, 1)], "a"), (4, 30, [(0, 30, 1)], "a"), (None, 40, [(0, 40, 2)], "x y"), (5, 50_000, [(0, 50_000, 7)], "w0 w1 w2 w3 w4 w5 w6"), (6, 18, [], "a b  c " * 8 + "a b  c"), (7, 2, [], "one two")]
    assert got == sorted(want, key=repr)
    assert runs.find_runs(df.limit(0)).collect() == []


def test_query_as_plainly(spark, tmp_path):
    rng = random.Random(9)
    rows = [(k, " ".join(map(str, made(rng, rng.randrange(0, 160))))) for k in range(-3, 160)] + [(500, None), (501, ""), (7, "a  b\t" * 13), (502, "\n \n")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, str(tmp_path))
    assert got.columns[:8] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want, tails = [], 0
    for doc, text in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc).encode()), len(ws)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
            tails += 1
        found = plainly(ws)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        kept = [w for i, w in enumerate(ws) if not any(s + q <= i < s + m for s, m, q in found)]
        want.append((doc, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(kept))))
    assert tails > 5 and sum(w[1] for w in want) > 50
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
