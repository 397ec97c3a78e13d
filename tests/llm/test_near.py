"""Near copies against all pairs."""

import random

from sedgeline.llm import near
from sedgeline.llm.graph import components


def shingle_set(t):
    w = (t or "").split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain(rows):
    sets = [shingle_set(t) for _, t in rows]
    texts = [t or "" for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if texts[i] == texts[j] or (a and b and len(a & b) >= 0.8 * len(a | b)):
                links[i] += 1
                links[j] += 1
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {rows[i][0]: (rows[top(i)][0], links[i]) for i in range(len(rows))}


def corpus(seed, n):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(n):
        if out and r.random() < 0.6:
            w = r.choice(out).split()
            for _ in range(r.choice([0, 1, 1, 2, 6])):
                if w:
                    w[r.randrange(len(w))] = r.choice(words)
        else:
            w = r.choices(words, k=r.choice([3, 8, 60, 120]))
        out.append(" ".join(w))
    return out + ["", None, "a b", "a  b", "a b c d e", "A b c d e"]


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near, "CHUNK", 16)
    rows = list(enumerate(corpus(5, 300)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.class_id, r.n_links) for r in near.near_copies(df).collect()}
    want = plain(rows)
    wrong = [k for k in want if got[k] != want[k]]
    assert len(got) == len(want) and not wrong, [(k, got[k], want[k]) for k in wrong[:5]]


def test_recall_of_depth():
    d = near.depth()
    assert near.recall(near.THRESHOLD, d) >= near.RECALL > near.recall(near.THRESHOLD, d + 1)


def test_hot_bucket_in_parts(spark, monkeypatch):
    monkeypatch.setattr(near, "PART", 8)
    base = [f"x{k}" for k in range(80)]
    rows = [(i, " ".join([*base, f"tail{i}"])) for i in range(60)]
    got = near.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 59)}


def test_nulls_empty_and_repeats(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert near.near_copies(none).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, None)], "doc_id long, text string").selectExpr("*", "'z' AS rep", "1 AS n")
    got = near.near_copies(df).collect()
    assert sorted((r.doc_id or -1, r.n_links) for r in got) == [(-1, 0), (-1, 2), (7, 2), (7, 2)]


def test_components(spark):
    e = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 99), (99, 98), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(e).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {98: 98, 99: 98, 100: 98}


def test_rows_that_share_an_id(spark):
    a, b, c = ("one two three four five six seven", "eight nine ten eleven twelve", "red green blue black white")
    rows = [(7, a), (7, b), (8, b + " z"), (None, c), (None, c), (None, "x y z u v w"), (9, a), (3, "x y z u v w")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted((r.doc_id or -1, r.text) for r in near.keep_one(df).collect())
    # One of each text; where a text has ids, the least.
    assert kept == sorted([(7, a), (7, b), (8, b + " z"), (-1, c), (3, "x y z u v w")])
    got = near.near_copies(df.selectExpr("*", "1 AS least", "2 AS other", "3 AS root")).collect()
    assert len({r.class_id for r in got}) == 5 and sorted(r.n_links for r in got) == [0, 0, 1, 1, 1, 1, 1, 1]


def test_keep_one_keeps_one_of_each_group(spark):
    rows = list(enumerate(corpus(11, 150)))
    rows = [(None if k % 13 == 0 else k // 3 if k % 5 == 0 else 1000 + k, t) for k, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain([(k, t) for k, (_, t) in enumerate(rows)])
    group = {t or "": want[k][0] for k, (_, t) in enumerate(rows)}
    kept = [group[r.text or ""] for r in near.keep_one(df).collect()]
    assert sorted(kept) == sorted(set(group.values()))


def test_lower_threshold_against_all_pairs(spark):
    rows = list(enumerate(corpus(6, 120)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r.doc_id: r.n_links for r in near.near_copies(df, threshold=0.5).collect()}
    sets = [shingle_set(t) for _, t in rows]
    for i, (_, t) in enumerate(rows):
        same = [j for j, (_, u) in enumerate(rows) if j != i and ((t or "") == (u or "") or (sets[i] and len(sets[i] & sets[j]) >= 0.5 * len(sets[i] | sets[j])))]
        assert got[i] == len(same)


def test_climb_shortens_prefixes(spark):
    import numpy as np

    r = np.random.default_rng(1)
    one = r.integers(0, 256, 128).astype(np.uint8)
    near_one = one.copy()
    near_one[:20] += 1
    far = r.integers(0, 256, 128).astype(np.uint8)
    tails = np.array([0x000100020003, 0x000100020003, 0x000100020009, 0x000100070000, 0x000900000000])
    sig = np.stack([one, one, near_one, far, near_one])
    root, lead = near._climb(tails, sig, 3, 0.55, 0.97)
    assert root.tolist() == [0, 0, 0, 3, 0] and lead[[0, 3]].all()
    root, lead = near._climb(tails, sig, 3, 0.55, 0.97, True)
    assert root.tolist() == [0, 0, 0, 3, 0] and lead.tolist() == [True, False, True, True, False]


def test_components_of_few_edges_in_one_task(spark, monkeypatch):
    from sedgeline.llm import graph

    r = random.Random(7)
    edges = [(r.randrange(900), r.randrange(900)) for _ in range(500)] + [(2000, k) for k in range(1000, 1300)] + [(k + 1, k) for k in range(3000, 3200)] + [(-5, -9), (4, 4)]
    e = spark.createDataFrame(edges, "a long, b long").repartition(3)
    names = []
    monkeypatch.setattr(graph, "written", lambda df, name, _f=graph.written: names.append(name) or _f(df, name))
    rows = [tuple(x) for x in components(e).collect()]
    assert len(names) == 1 and len(set(rows)) == len(rows)
    # The same in rounds.
    assert dict(rows) == {x.node: x.root for x in components(e, few=0).collect()} and len(names) > 3
    assert dict(rows)[2000] == 1000 and dict(rows)[3200] == 3000 and dict(rows)[-5] == -9
    assert components(e.where("a = 4 AND b = 4")).count() == 0


def test_columns_named_as_helpers_stay(spark):
    rows = [(1, " ".join(f"w{i}" for i in range(60)), "x", 1.5), (2, " ".join(f"w{i}" for i in range(60)), "y", 2.5), (3, "one two", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id string, _h1 double").selectExpr("*", "'n' AS _none", "7 AS own__id")
    got = near.keep_one(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [(1, rows[0][1], "x", 1.5, "n", 7), (3, "one two", None, None, "n", 7)]
    named = near.keep_one(df.drop("_id").withColumnRenamed("doc_id", "_id"), "_id")
    assert sorted(r["_id"] for r in named.collect()) == [1, 3]
