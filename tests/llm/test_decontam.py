"""Leaks that are planted as they are, with noise, and with other values."""

from sedgeline.llm import decontam

ITEM = "A train leaves the town of Norwich at 45 km and its driver Marta counts 12 bridges before Norwich is out of sight again"


def found(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    b = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontam.decontaminate(d, b, **kw).collect()}


def test_exact_noisy_and_reparameterised(spark):
    other = ITEM.replace("Norwich", "Lisbon").replace("45", "97").replace("12", "30").replace("Marta", "Jonas").replace("km", "miles")
    broken = ITEM.replace("of Norwich", "of Lisbon").replace("12", "31")
    docs = [(1, "Some words before. " + ITEM + " and after"), (2, "x y. " + other), (3, " ".join(w + "###" for w in ITEM.split())), (4, "Nothing of the sort is said in this text at all, which goes on for a while."), (5, broken), (6, None), (7, ITEM[:60]), (None, ITEM)]
    got = found(spark, docs, [(10, ITEM), (11, "unrelated words that do not occur anywhere in these documents at all"), (12, None), (13, "too short")])
    assert {k[0] for k in got} == {None, 1, 2, 3} and {k[1] for k in got} == {10}
    assert got[2, 10].reparameterised and not got[1, 10].reparameterised and got[1, 10].coverage == 1
    assert got[2, 10].slots == 5


def test_inconsistent_slots_do_not_count(spark):
    item = "first 4 apples then 9 pears then 4 plums and so on for every one of the guests here tonight"
    docs = [(1, item.replace("4", "7")), (2, item.replace("4", "7", 1).replace("9", "3"))]
    got = found(spark, docs, [(1, item)], coverage=0.99)
    assert set(got) == {(1, 1)}


def test_upper_case_accents(spark):
    item = "Rrquell. De ueieas ciónue las en de que cióncies y boasrr ciónrrñco ñci uecorr rr"
    assert set(found(spark, [(1, "X!! " + item.upper() + " Y!!")], [(1, item)])) == {(1, 1)}


def test_short_items_and_empty(spark):
    items = [(1, "one two three four five"), (2, "one two three four"), (3, "What is 7 * 8 ?"), (4, "yes"), (5, "?!"), (6, "seen 9 hens")]
    docs = [(1, "we saw one two three four five there"), (2, "One, two\nthree four."), (3, "Then: what is 7 * 8 ? and again what is 7 8"), (4, "what is 7 * 9 ?"), (5, "Yes yes yes"), (6, "one two three"), (None, "Seen 9 hens"), (7, "seen 3 hens")]
    got = found(spark, docs, items)
    assert set(got) == {(1, 1), (1, 2), (2, 2), (3, 3), (5, 4), (None, 6)}
    assert all((r.windows, r.item_windows, r.coverage, r.slots, r.reparameterised) == (1, 1, 1.0, 0, False) for k, r in got.items() if k != (1, 1))
    assert not found(spark, [], [(1, ITEM)]) and not found(spark, [(1, ITEM)], [])


def test_one_broken_slot_leaves_the_other_windows(spark):
    words = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(59)]
    words[5] = words[50] = "4"
    passage = " ".join(words)
    words[50] = "7"
    ask = "if a farmer has 3 hens and buys 5 more at the fair how many hens are there then in the yard"
    thrice = "you add 4 spoons of flour then stir it well and add 4 spoons of milk and then at last add 4 spoons of fine sugar to it"
    docs = [(1, " ".join(words)), (2, ask.replace("5", "3")), (3, ask.replace("5", "9").replace("3", "9")), (4, thrice.replace("4", "6", 2)), (5, "nothing of it")]
    got = found(spark, docs, [(1, passage), (2, ask), (3, thrice)])
    assert set(got) == {(1, 1), (2, 2), (3, 2), (4, 3)}
    assert got[1, 1].windows == 44 and got[1, 1].item_windows == 52 and not got[1, 1].reparameterised
    assert got[3, 2].coverage == 1 and got[3, 2].reparameterised


def test_plain_copies_of_any_slots_case_and_lines(spark):
    dense = "What is 12 + 35 * 7 - 4?"
    long = "3 4 5 6 7 8 9 10 then 11 12 13 14 15 16 17"
    names = "one day old Marta took a bus with her friend Jonas to meet their good uncle Pietro near the big town of Lisbon for tea"
    mixed = "we know that a 1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9 can be told from all the other sorts of it"
    wrapped = names
    for name in ("Marta", "Jonas", "Pietro", "Lisbon"):
        wrapped = wrapped.replace(" " + name, "\n" + name)
    docs = [(1, "Now. " + dense + " Well"), (2, "what is 12 35 8 4"), (3, "x " + long), (4, names.lower()), (5, names.upper()), (6, wrapped), (7, mixed.replace("all", "the")), (8, long.replace("1", "2")), (9, names.replace("Marta", "Jane"))]
    got = found(spark, docs, [(1, dense), (3, long), (4, names), (7, mixed)])
    assert set(got) == {(1, 1), (3, 3), (4, 4), (5, 4), (6, 4), (7, 7), (9, 4)}
    assert got[1, 1].coverage == got[3, 3].coverage == got[4, 4].coverage == got[6, 4].coverage == 1
    assert got[9, 4].reparameterised


def test_rows_without_an_id_of_their_own_are_told_apart(spark, tmp_path):
    import corpus_pipeline

    half = len(ITEM.split()) // 2 + 3
    parts = [" ".join(ITEM.split()[:half - 3]), " ".join(ITEM.split()[half - 3:])]
    docs = [(i, t) for i in (None, 5) for t in ("so " + ITEM, parts[0] + " or so", "and then " + parts[1], "clean words only in here", None, "")]
    spark.createDataFrame([(10, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    left = corpus_pipeline.without_leaks(spark, df, str(tmp_path)).collect()
    key = lambda r: (repr(r[0]), repr(r[1]))
    assert sorted(((r.doc_id, r.text) for r in left), key=key) == sorted((d for d in docs if d[1] != "so " + ITEM), key=key)
    assert {k for k in found(spark, docs, [(10, ITEM)])} == {(None, 10), (5, 10)}


# ---- the whole query against a plain version, on words instead of hashes

def plain_words(text):
    """(template, value, is slot) of each word that has more than punctuation."""
    import re

    out, last = [], None
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        word = m[0]
        bare = "".join(c for c in word.lower() if not (33 <= ord(c) < 128 and not c.isalnum()))
        capital = [c for c in word if "A" <= c <= "Z" or "À" <= c <= "Þ"]
        small = any("a" <= c <= "z" or "ß" <= c <= "ÿ" for c in word)
        starts = last is None or last[0][-1] in ".!?:;" or "\n" in text[last[1] : m.start()]
        last = (word, m.end())
        if not bare:
            continue
        number = all("0" <= c <= "9" for c in bare)
        unit = bool(out) and out[-1][0] == "<number>" and bare in decontam.UNITS
        name = word[0] in capital and len(capital) == 1 and small and not starts
        kind = "<number>" if number else "<unit>" if unit else "<name>" if name else None
        out.append((kind or bare, bare, kind is not None))
    return out


def plain_windows(words, n):
    """position -> (templates or None, plain words, slot places, slot values)."""
    for at in range(len(words) - n + 1):
        w = words[at : at + n]
        places = [k for k in range(n) if w[k][2]]
        yield at, tuple(x[0] for x in w) if 2 * len(places) <= n else None, tuple(x[1] for x in w), places, [w[k][1] for k in places]


def plain_leaks(docs, items):
    from collections import Counter, defaultdict

    index, size = defaultdict(list), {}
    for i, text in items:
        words = plain_words(text or "")
        n = min(len(words), 8)
        if n < 5:
            if n:
                size[i] = (1, 1)
                index[n, tuple(w[1] for w in words)].append((i, 0, [], [], False))
            continue
        rows = list(plain_windows(words, n))
        size[i] = (sum(2 * len(r[3]) <= n for r in rows), len(rows))
        for at, template, plain, places, slot_values in rows:
            if template:
                index[n, template].append((i, at, places, slot_values, False))
            if places:
                index[n, plain].append((i, at, [], [], 2 * len(places) > n))
    out = set()
    for d, text in docs:
        words, lanes = plain_words(text or ""), defaultdict(set)
        for n in range(1, 9):
            for at, template, plain, places, slot_values in plain_windows(words, n):
                seen = [(template, slot_values)] * bool(template) + [(plain, [])] * bool(places) if n > 4 else [(plain, [])]
                for key, mine in seen:
                    for i, ipos, where, theirs, dense in index.get((n, key), ()):
                        lanes[i, at - ipos].add((ipos, tuple(where), tuple(theirs), tuple(mine), dense))
        found = defaultdict(lambda: [set(), set(), 0, False])
        for (i, _), met in lanes.items():
            pairs = {(ipos + k, a, b) for ipos, where, theirs, mine, _ in met for k, a, b in zip(where, theirs, mine, strict=True)}
            votes, total = Counter(p[1:] for p in pairs), Counter(p[1] for p in pairs)
            good = [m for m in met if m[2] == m[3] or all(2 * votes[p] > total[p[0]] for p in zip(m[2], m[3], strict=True))]
            dense = {m[0] for m in met if m[4]}
            used = {p for m in good for p in zip(m[2], m[3], strict=True)}
            x = found[i]
            x[0] |= {m[0] for m in good} - dense
            x[1] |= {m[0] for m in good} & dense
            x[2], x[3] = max(x[2], len(used)), x[3] or any(a != b for a, b in used)
        for i, (at, dense, slots, other) in found.items():
            ways = [(k / of, k, of) for k, of in ((len(at) + len(dense), size[i][1]), (len(at), size[i][0])) if of]
            c, w, of = max(ways)
            if c >= 0.5 and (at or dense):
                out.add((d, i, w, of, round(c, 9), slots, other))
    return out


def test_query_against_plain(spark, tmp_path):
    """All of the smallest tables, and questions asked again with other values."""
    from pathlib import Path

    from sedgeline.llm import queries

    sf = Path("/root/testdata/sf0.001")
    items = [(100_000, "Anna has 3 apples and 5 pears, so how many pieces of fruit does Anna have in all?"), (100_001, "A train goes 40 km in 2 hours and then 60 km in 3 hours; what is its mean speed?"), (100_002, "five words stand here alone"), (100_003, "1 2 3 four 5 6 seven 8 9 10"), (100_004, "What is 7 * 8 ?"), (100_005, "!")]
    docs = [(200_000, "First: Anna has 4 apples and 4 pears, so how many pieces of fruit does Anna have in all? Well."), (200_001, "text before\nBerta has 7 apples and 9 pears, so how many pieces of fruit does Carla have in all?"), (200_002, "A TRAIN GOES 50 MILES IN 2 HOURS AND THEN 60 KM IN 3 HOURS; WHAT IS ITS MEAN SPEED?"), (200_003, "and five words, stand here alone!"), (200_004, "say 1 2 3 four 5 6 seven 8 9 10 now"), (200_005, None), (200_006, ""), (200_007, "so what is 7 * 8 ? and what is 7 8 again"), (200_008, "what is 7 * 9 ?")]
    if sf.is_dir():
        docs += [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
        items += [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r.doc_id, r.item_id, r.windows, r.item_windows, round(r.coverage, 9), r.slots, r.reparameterised) for r in queries.op1_template_decontamination(spark, str(tmp_path)).collect()}
    want = plain_leaks(docs, items)
    assert got == want, (sorted(got - want)[:5], sorted(want - got)[:5])
    assert {(200_000, 100_000), (200_002, 100_001), (200_003, 100_002), (200_004, 100_003), (200_007, 100_004)} <= {x[:2] for x in got}
