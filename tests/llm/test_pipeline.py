"""The pipeline's rows against the stages done plainly, one document after the other."""

import random
import re
import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from test_lines import plain as plain_lines  # noqa: E402
from test_near import plain as plain_near  # noqa: E402

import corpus_pipeline  # noqa: E402
from sedgeline.llm import packing, quality  # noqa: E402

ITEM = "the quick reader of seven old books finds one more passage that nobody else in town has ever read aloud"


def fixture():
    r = random.Random(11)
    words = [f"w{k}" for k in range(900)]
    text = lambda: "\n".join(" ".join(r.choices(words, k=r.randrange(6, 30))) for _ in range(r.randrange(1, 6)))
    docs, labels = [], []
    for k in range(90):
        t = text()
        if k % 9 == 4:
            t = "\n".join(" ".join(w.upper() + "!!" for w in line.split()) for line in t.split("\n"))
        if k % 10 == 7:
            t = docs[k - 5][1]
        if k % 10 == 8:
            w = docs[k - 4][1].split(" ")
            w[len(w) // 2] = "edited"
            t = " ".join(w)
        if k % 15 == 2:
            t += "\n" + (ITEM if k % 2 else ITEM + " twice")
        docs.append((k, t, "en", "src", len(t)))
        labels.append((k, int("!!" not in t), 0))
    return docs + [(90, "", "en", "src", 0), (91, None, "en", "src", None)], labels


def test_against_plain(spark, tmp_path):
    docs, labels = fixture()
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, ddl).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = quality.fit(df, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    scores = {r.doc_id: r.s for r in df.select("doc_id", quality.score(model, F.col("text")).alias("s")).collect()}
    now = {i: t for i, t, *_ in docs if scores[i] >= 0.3}
    assert not any("!!" in (t or "") for t in now.values()) and len(now) > 60
    kept = plain_lines(list(now.items()))
    after = {}
    for i, t in now.items():
        lines = (t or "").split("\n")
        left = "\n".join(x for k, x in enumerate(lines) if k in kept[i] or not x.strip(" "))
        if left.strip() or not (t or "").strip():
            after[i] = left
    heads = {c for c, _ in plain_near(sorted(after.items())).values()}
    after = {i: t for i, t in after.items() if i in heads}
    norm = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    after = {i: t for i, t in after.items() if norm(ITEM) not in norm(t)}

    tok = packing.WordTokenizer(__import__("public_tokenizers").path("byte_bpe_50k.json"))
    want = {i: len(tok.encode(t)) + 1 for i, t in after.items()}
    size, total = {}, {}
    for r in got:
        size[r.doc_id] = size.get(r.doc_id, 0) + r.length
        total[r.doc_id] = r.doc_tokens
    assert size == total == want
