"""The language model against a plain Python one."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sedgeline.llm import lm

TEXTS = ["a b a c", "A  b\nc", "", None, "d d d d a b", "a b a c", "é ê a\tb", "x y z a b c d", "b c", "a b c"] * 4


def plain(rows, order, weights):
    toks = lambda t: [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), b"\n"]
    grams = Counter()
    for i, t in rows:
        if lm.fold(i) % 10:
            w = toks(t)
            for n in range(1, order + 1):
                full = [b"<"] * (n - 1) + w
                grams.update((n, tuple(full[k : k + n])) for k in range(len(w)))
    docs = sum(1 for i, _ in rows if lm.fold(i) % 10)
    total = sum(c for (n, _), c in grams.items() if n == 1)
    distinct = sum(1 for n, _ in grams if n == 1)
    out = []
    for i, t in rows:
        w, base, score = toks(t), 0.0, 0.0
        for k in range(len(w)):
            p = (grams[1, (w[k],)] + 0.1) / (total + 0.1 * (distinct + 1))
            base += math.log10(p)
            for n in range(2, order + 1):
                h = tuple(([b"<"] * (n - 1) + w)[k : k + n - 1])
                ctx = docs if set(h) == {b"<"} else grams[n - 1, h]
                lam = weights[n - 2][min(int(math.log2(ctx)), 47)] if ctx else 0.0
                p = lam * (grams[n, (*h, w[k])] / ctx if ctx else 0) + (1 - lam) * p
            score += math.log10(p)
        out.append((i, lm.fold(i) % 10 == 0, len(w), sum(grams[1, (x,)] > 0 for x in w), total, round(base, 9), round(score, 9)))
    return sorted(out)


@pytest.mark.parametrize("order", [2, 3])
def test_against_plain(spark, monkeypatch, order):
    rows = list(enumerate(TEXTS))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("nothing", "x").repartition(3)
    seen = []
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda cells: seen.append(learn(cells)) or seen[-1])
    got = sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9), round(r.score, 9)) for r in lm.score(df, order=order).collect())
    assert got == plain(rows, order, seen)
    assert any(w.any() for w in seen)


def test_weights_by_em():
    # ratios 4 and 0 in equal shares: the likelihood is greatest at w = 1/3
    w = lm.learn_weights([(3, round(lm.STEP * math.log10(4)), 10), (3, -32768, 10)])
    assert abs(w[3] - 1 / 3) < 0.02 and w[2] == 0 and w[5] == w[3]


def test_empty_and_nulls(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(none).count() == 0
    one = spark.createDataFrame([(None, "a"), (10, None)], "doc_id long, text string")
    assert lm.score(one).count() == 2


def test_fold_is_crc():
    assert lm.fold(12) == zlib.crc32(b"12") and np.uint64(lm.END) != lm.BEGIN
