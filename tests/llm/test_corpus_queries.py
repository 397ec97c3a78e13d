"""The registered corpus queries against SQL where there is some, the pipeline's stages, and packing, chat and quality."""

import zlib
from pathlib import Path

import numpy as np
import pytest
from corpus_rows import same_rows
from pyspark.sql import functions as F

from sedgeline.llm import chat, packing, quality, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    same_rows(spark, queries.QUERIES, queries.ORACLES, name, SF)


@pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns and 0 < docs.count() <= n
            n = docs.count()
    assert docs.select("doc_id").distinct().count() == n


def texts(spark):
    rows = [(k, " ".join(f"word{j % 97} x{j * k}" for j in range(7 * k))) for k in range(1, 60)] + [(100, ""), (101, None), (102, "<|endoftext|> ſ \x1c ½"), (None, "null id"), (5, "again")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_packing_is_a_partition_of_all_ids(spark):
    rows, df = texts(spark)
    import public_tokenizers
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack(df.selectExpr("*", "1 AS length"), window=64, with_ids=True).collect()
    want = sorted(lib.encode(t or "", add_special_tokens=False).ids + [1] for _, t in rows)
    by, seqs = {}, {}
    for r in got:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    docs = []
    for (_, n), ps in by.items():
        ps.sort(key=lambda r: r.start)
        assert [p.start for p in ps] == list(np.cumsum([0] + [p.length for p in ps[:-1]])) and sum(p.length for p in ps) == n
        docs.append([x for p in ps for x in p.ids])
    assert sorted(docs) == want
    for ps in seqs.values():
        ps.sort(key=lambda r: r.offset)
        total = sum(p.length for p in ps)
        assert [p.offset for p in ps] == list(np.cumsum([0] + [p.length for p in ps[:-1]])) and (total == 64 or total & (total - 1) == 0)
    assert packing.pack(df.limit(0)).count() == 0


def test_packing_keeps_what_was_placed():
    r = np.random.default_rng(4)
    docs = [(k, r.integers(0, 9, int(n))) for k, n in enumerate(r.geometric(0.004, 700))]
    bins = packing.SumOfSquares(512)
    for k, ids in docs:
        n = len(ids) % 512
        if n:
            bins.add((k, len(ids) - n, ids[len(ids) - n :], len(ids)), n)
    left = bins.rest()
    windows = list(packing._closed(left, 512))
    kept = {id(p[2]) for w in windows for p in w if len(w) and sum(len(x[2]) for x in w) == 512}
    placed = sum(len(p[2]) for _, ps in left for p in ps)
    assert sum(len(p[2]) for _, ps in left for p in ps if id(p[2]) in kept) >= 0.9 * placed - 512
    assert sorted((p[0], p[1] + k) for w in windows for p in w for k in range(len(p[2]))) == sorted((p[0], p[1] + k) for _, ps in left for p in ps for k in range(len(p[2])))
    short = [sum(len(p[2]) for p in w) for w in windows if sum(len(p[2]) for p in w) < 512]
    assert sum(short) < 512 and all(n & (n - 1) == 0 for n in short)
    assert list(packing._closed([], 512)) == []


def test_long_text_and_window_of_one(spark):
    df = spark.createDataFrame([(1, "word " * 60_000), (2, "a")], "doc_id long, text string")
    got = packing.pack(df).collect()
    assert sum(r.length for r in got if r.doc_id == 1) == next(r.doc_tokens for r in got if r.doc_id == 1)
    assert all(r.length == 1 and r.sequence_tokens == 1 for r in packing.pack(df.where("doc_id = 2"), window=1).collect())


def test_level_choice_is_the_least_sum():
    r = np.random.default_rng(2)
    bins = packing.SumOfSquares(16)
    for _ in range(300):
        size = int(r.integers(1, 16))
        cost = {}
        for level in [0, *np.flatnonzero(bins.count[: 16 - size + 1])]:
            c = bins.count.copy()
            c[level] -= level > 0
            if level + size < 16:
                c[level + size] += 1
            cost[int(level)] = int((c[1:16] ** 2).sum())
        assert cost[bins.place(size)] == min(cost.values())
        bins.add(("d", 0, np.zeros(size), size), size)


def test_chat_parts_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|end|><|start|>user<|body|>x", "<\\|a [\\INST] <\\\\/s>", "", None, "plain é"]
    one = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    part = lambda t, text=None, ref=None, w=None, h=None, s=None, p=None: (t, text, ref, w, h, s, p)
    rows = [(1, k, "assistant" if k % 2 else "user", [part("text", t)]) for k, t in enumerate(nasty)]
    rows += [(2, 0, "user", [part("text", "see "), part("image", None, "u1", 57, 28), part("audio", None, None, s=1.0)]), (2, 1, None, None), (2, 2, "assistant", [part("document", ref="d", p=3), part("odd", "z")])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{one}>")
    made = chat.format_chat(df).cache()
    got = {r.conv_id: r for r in made.select("*", chat.read_turns(F.col("formatted"), F.col("mask")).alias("ts")).collect()}
    assert [t.text for t in got[1].ts] == [t or "" for t in nasty] and [t.loss for t in got[1].ts] == [(t or "") if k % 2 else "" for k, t in enumerate(nasty)]
    assert [(a.number, a.type, a.ref, a.tokens, a.turn) for a in got[2].attachments] == [(0, "image", "u1", 3, 0), (1, "audio", None, 25, 0), (2, "document", "d", 1536, 2)]
    assert got[2].media_tokens == 3 + 25 + 1536 and got[2].formatted.count("<|document:2|>z") == 1 and got[2].ts[1].role == ""
    for r in chat.loss_spans(made).collect():
        assert chat.END not in got[r.conv_id].formatted[r.start : r.start + r.length]
    assert chat.format_chat(df.limit(0)).count() == 0


def test_quality_rules_agree_with_python(spark):
    r = np.random.default_rng(1)
    x = r.random((900, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] < 0.7)).astype(float)
    m = quality.fit_arrays(x, y, ["upper", "digits", "stops"])
    z = np.full(900, m.bias)
    for rule, w in zip(m.rules, m.weights, strict=True):
        held = np.ones(900, bool)
        for f, over, cut in rule:
            held &= (x[:, ["upper", "digits", "stops"].index(f)] > cut) == over
        z += w * held
    assert ((z > 0) == (y > 0.5)).mean() > 0.97 and 0 < len(m.rules) < 400
    docs = spark.createDataFrame([(k, ("GOOD TEXT " if k % 2 else "bad ### ") * (k % 7 + 1)) for k in range(200)] + [(None, None)], "doc_id long, text string").selectExpr("*", "1 AS score")
    labels = spark.createDataFrame([(k, k % 2) for k in range(150)] + [(3, None), (999, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = docs.select("doc_id", quality.score(model, F.col("text")).alias("s")).collect()
    assert all(0 <= g.s <= 1 for g in got) and all((g.s > 0.5) == bool(g.doc_id % 2) for g in got if g.doc_id is not None)
    none = quality.fit(docs, labels.limit(0))
    assert docs.limit(1).select(quality.score(none, F.col("text"))).first()[0] == pytest.approx(0.5)


def plain_statistics(t):
    import re
    import unicodedata

    n = float(len(t))
    some = max(n, 1.0)
    words, lines = re.split("[ \n]", t), t.split("\n")
    share = lambda chars: sum(c in chars for c in t) / some
    return {
        "n_chars": n, "n_words": len(words), "word_length": n / len(words), "distinct_words": len(set(words)) / len(words), "distinct_lines": len(set(lines)) / len(lines), "line_length": n / len(lines),
        "upper": sum(unicodedata.category(c) == "Lu" for c in t) / some, "digits": share("0123456789"), "symbols": share("#$%&*@^~"), "bars": share("|"), "brackets": share("<>{}[]()=/\\_"), "exclaimed": share("!?"),
        "stops": share("."), "commas": share(","), "blanks": share(" \n"),
    }


@pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
def test_quality_query_against_plain(spark, monkeypatch):
    """Every score of the registered query from plain statistics and the rules, one by one; the fold by zlib."""
    import math

    models = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda *a, **k: models.append(fit(*a, **k)) or models[-1])
    got = {r.doc_id: r for r in queries.op10_rule_ensemble(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs) and len(models) == 1
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    right = held = 0
    for d in docs:
        s, z = plain_statistics(d.text or ""), models[0].bias
        for rule, w in zip(models[0].rules, models[0].weights, strict=True):
            z += w * all((s[f] > cut) == over for f, over, cut in rule)
        r = got[d.doc_id]
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9) and r.predicted == (r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 5 == 0)
        if r.held_out and labels.get(d.doc_id) is not None:
            held += 1
            right += r.predicted == labels[d.doc_id]
    assert right >= 0.9 * held > 0


def test_chat_control_strings_over_several_parts(spark):
    """Whatever is cut into text parts side by side, also around media, gives its own turns back and no others."""
    marks = [chat.START, chat.BODY, chat.END, "</s>", "<s>", "[INST]", "[/INST]", "<\\|end|>", "[\\\\INST]", "<|image:0|>"]
    part = lambda text: ("text", text, None, None, None, None, None)
    image = ("image", None, "r", 1, 1, None, None)
    rows, want = [], {}
    for mark in marks:
        for cut in range(len(mark) + 1):
            one, two = f"a {mark[:cut]}", f"{mark[cut:]} b"
            for parts, text in (([part(one), part(two)], one + two), ([part(one), part(""), part(None), part(two), image, part(two)], f"{one}{two}<|image:0|>{two}")):
                k = len(want)
                want[k] = text
                rows += [(k, 0, "user", parts), (k, 1, "assistant", parts)]
    df = spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts array<{chat.PART}>")
    got = chat.format_chat(df).select("conv_id", chat.read_turns(F.col("formatted"), F.col("mask")).alias("ts")).collect()
    assert len(got) == len(want)
    for r in got:
        text = want[r.conv_id]
        assert [(t.role, t.text.replace("<|image:1|>", "<|image:0|>")) for t in r.ts] == [("user", text), ("assistant", text)]
        assert [len(t.loss or "") for t in r.ts] == [0, len(text)]
