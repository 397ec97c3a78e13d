"""Line dedup against all pairs of lines."""

import random

import pytest

from sedgeline.llm import lines


def plain(docs, threshold=0.8):
    seen, kept = [], {}
    for i, text in sorted(((i, t or "") for i, t in docs), key=lambda r: r[0]):
        kept[i] = []
        for k, line in enumerate(text.split("\n")):
            s = {w for w in line.split(" ") if w}
            if not s:
                continue
            if not any(len(s & o) >= threshold * len(s | o) - 1e-9 for o in seen):
                kept[i].append(k)
            seen.append(s)
    return kept


def corpus(seed, n):
    r = random.Random(seed)
    words = [f"w{min(r.randrange(300), r.randrange(300))}" for _ in range(3000)]
    pool, out = [], []
    for i in range(n):
        ls = []
        for _ in range(r.randrange(1, 8)):
            if pool and r.random() < 0.5:
                w = r.choice(pool).split(" ")
                for _ in range(r.choice([0, 1, 1, 3])):
                    w[r.randrange(len(w))] = r.choice(words)
            else:
                w = r.choices(words, k=r.choice([1, 2, 4, 5, 9, 20, 40]))
            pool.append(" ".join(w))
            ls.append(pool[-1])
        out.append((i, "\n".join(ls)))
    return out + [(n, ""), (n + 1, None), (n + 2, "  \n\n"), (n + 3, "x x y\ny  x\n\nx")]


def test_against_all_pairs(spark):
    docs = corpus(3, 160)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.kept_lines for r in lines.line_report(df).collect()}
    assert got == plain(docs)


def test_texts(spark):
    df = spark.createDataFrame([(2, "b c\n\na", 9), (1, "a\nb c", 8), (3, None, 7)], "doc_id long, text string, line_no int").selectExpr("*", "'q' AS id")
    got = {r.doc_id: r for r in lines.remove_lines(df).collect()}
    assert got[1].text == "a\nb c" and got[2].text == "" and got[3].text is None
    assert got[2].line_no == 9 and got[2].id == "q"


def test_empty_null_ids_and_repeats(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lines.line_report(none).count() == 0 and lines.remove_lines(none).count() == 0
    df = spark.createDataFrame([(None, "a b c d e"), (4, "a b c d e\nq r"), (4, "z")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_lines) for r in lines.line_report(df).collect())
    assert got == [(-1, 1), (4, 1), (4, 2)]


def test_rows_that_share_an_id_against_all_pairs(spark):
    texts = [t for _, t in corpus(8, 90)]
    long = " ".join(f"v{k}" for k in range(20))
    texts += ["alpha beta gamma\n" + long, "delta epsilon zeta\n" + long + " w", "eta theta iota\n" + long, "a b\nonly here one", "a b\nonly there two"]
    ids = [None, None, 7, 7, 3, 100]
    docs = [(ids[k % 6] if k % 6 < 5 else 100 + k, t) for k, t in enumerate(texts)]
    # Rows in the order that is defined, each with a number of its own for the plain version.
    rows = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    kept = plain(list(enumerate(t for _, t in rows)))
    want = sorted((repr(i), t or "", kept[k]) for k, (i, t) in enumerate(rows))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    left = lambda t, ks: "\n".join(x for k, x in enumerate(t.split("\n")) if k in ks or not x.strip(" "))
    report = sorted((repr(r.doc_id), r.n_lines, r.n_removed, r.kept_lines) for r in lines.line_report(df).collect())
    n = lambda t: sum(bool(x.strip(" ")) for x in t.split("\n"))
    assert report == sorted((i, n(t), n(t) - len(ks), ks) for i, t, ks in want)
    got = sorted((repr(r.doc_id), r.text or "") for r in lines.remove_lines(df).collect())
    assert got == sorted((i, left(t, ks)) for i, t, ks in want)


@pytest.mark.parametrize(("threshold", "small"), [(0.5, lines.SMALL), (0.6, 0), (0.8, 0), (0.9, 5), (1.0, lines.SMALL)])
def test_thresholds_and_paths_against_all_pairs(spark, threshold, small):
    r = random.Random(int(100 * threshold))
    docs = corpus(5, 60)
    # Long lines, for which several shared tokens are asked, with copies around the threshold; and the shortest lines.
    for k in range(12):
        long = [f"v{k}x{r.randrange(400)}" for _ in range(r.choice([70, 150, 330]))]
        for share in (0.0, 0.02, 0.1, 0.2, 0.4):
            docs.append((len(docs), " ".join(w if r.random() > share else f"u{r.randrange(99)}" for w in long) + "\na b c\na b c d\na b"))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    kept = lines.kept_lines(lines._docs(lines._keyed(df, "doc_id", "text"), "text"), threshold=threshold, small=small)
    got = {}
    for row in kept.collect():
        got.setdefault(row.id, []).append(row.line_no)
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in plain(docs, threshold).items() if v}


def sets_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = lines._docs(lines._keyed(df, "doc_id", "text"), "text")
    return docs, lines._sets(docs, 0.8).localCheckpoint()


def test_long_strangers_are_not_verified(spark):
    # Each two lines share tokens by chance, some of them in their prefixes, and none are alike.
    r = random.Random(4)
    _, sets = sets_of(spark, [" ".join(r.sample([f"w{k}" for k in range(1500)], 140)) for _ in range(200)])
    none = spark.createDataFrame([], "id long, line_no long")
    assert sets.count() == 200 and lines._met(sets, none, 0.8, True).count() < 20


def test_shorter_side_of_the_join_is_thinned_above_the_shared_shuffle(spark):
    r = random.Random(9)
    texts = [" ".join(r.sample([f"w{k}" for k in range(300)], 40)) for _ in range(60)]
    # Near copies of other lengths, before and after their texts in the order; the later one of each two is met.
    texts += [" ".join(t.split(" ")[:37]) for t in texts[:20]] + [t + " more" for t in texts[40:60]]
    _, sets = sets_of(spark, texts)
    gone = spark.createDataFrame([(60, 0), (61, 0)], "id long, line_no long")
    met = lines._met(sets, gone, 0.8, False)
    got = {(x.ai, x.bi) for x in met.collect()}
    assert {(k, 60 + k) for k in range(2, 20)} | {(k, 40 + k) for k in range(40, 60)} <= got
    assert all(a < b and b not in (60, 61) for a, b in got)
    plan = met._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    shared = plan.index("ReusedExchange")
    # One side is filtered above the shuffle that the other reads again as it is.
    assert "Filter CASE WHEN (monotonically_increasing_id" in plan[:shared] and "monotonically_increasing_id" not in plan[shared:]
    assert plan.index("monotonically_increasing_id") < plan.index("REPARTITION_BY_COL") < shared


def test_first_round_finds_near_copies_among_strangers(spark):
    # Every token stands in a tenth of all lines, so that the lines that share one of them are strangers.
    r = random.Random(5)
    words = [f"w{k}" for k in range(200)]
    firsts = [r.sample(words, 20) for _ in range(300)]
    copies = [w[:k] + [f"new{i}"] + w[k + 1 :] for i, w in enumerate(firsts) for k in [i % 20]]
    docs, sets = sets_of(spark, [" ".join(w) for w in firsts + copies])
    gone = {x.id for x in lines._verified(docs, lines._near(sets, 0.8), 0.8, lines.SMALL)[0].collect()}
    assert gone <= set(range(300, 600)) and len(gone) > 270


def test_first_round_leaves_rare_tokens_to_the_join(spark):
    texts = [" ".join(f"w{k}x{i}" for i in range(10)) for k in range(20)]
    docs, sets = sets_of(spark, texts + [t + " more" for t in texts])
    assert lines._near(sets, 0.8).count() == 0
    none = spark.createDataFrame([], "id long, line_no long")
    assert {(x.ai, x.bi) for x in lines._met(sets, none, 0.8, True).collect()} >= {(k, 20 + k) for k in range(20)}
    assert {x.id for x in lines.kept_lines(docs).collect()} == set(range(20))


def test_odd_thresholds(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for bad in (0, 1.5):
        with pytest.raises(ValueError):
            lines.line_report(df, threshold=bad)


def test_lookup_is_in_no_row(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = lines._sets(lines._docs(lines._keyed(df, "doc_id", "text"), "text"), 0.8)._jdf.queryExecution().optimizedPlan().toString()
    assert "classes" not in plan and "scalar-subquery" in plan


def test_very_long_text(spark):
    text = "\n".join(f"row {k} of {k * k} and {k % 7}" for k in range(30_000))
    df = spark.createDataFrame([(1, text), (2, "row 5 of 25 and 5\nnew words here to stay")], "doc_id long, text string")
    got = {r.doc_id: r for r in lines.line_report(df).collect()}
    assert got[2].kept_lines == [1] and got[1].n_lines == 30_000
    out = {r.doc_id: r.text for r in lines.remove_lines(df).collect()}
    assert out[2] == "new words here to stay" and out[1].count("\n") == len(got[1].kept_lines) - 1


def test_columns_named_as_helpers_stay(spark):
    rows = [(1, "a b c d e\nx y", "p", 1), (2, "a b c d e\nz", "q", 2), (2, "other words here", "r", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id string, `count` long").selectExpr("*", "'n' AS _nth", "7 AS _kept", "8 AS _flags", "9 AS nth")
    got = lines.remove_lines(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [(1, "a b c d e\nx y", "p", 1, "n", 7, 8, 9), (2, "other words here", "r", 3, "n", 7, 8, 9), (2, "z", "q", 2, "n", 7, 8, 9)]
    assert lines.line_report(df).count() == 3
