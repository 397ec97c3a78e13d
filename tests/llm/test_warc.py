"""Archives: round trip, order of the index, the loser tree."""

import random

from sedgeline.llm import warc


def test_loser_tree():
    r = random.Random(1)
    for k in (0, 1, 2, 3, 7, 8):
        runs = [sorted(r.choices(range(50), k=r.randrange(20))) for _ in range(k)]
        assert list(warc.LoserTree([iter(x) for x in runs])) == sorted(sum(runs, []))


def test_url_key():
    assert warc.url_key("http://www.Blog.Example.com:80/A/b?Q=1#x") == "com,example,blog)/a/b?q=1"
    assert warc.url_key(None) == "" and warc.url_key("http://[bad") == "http://[bad"


def test_round_trip_and_order(spark, monkeypatch):
    monkeypatch.setattr(warc, "RUN", 7)
    monkeypatch.setattr(warc, "ARCHIVE", 300)
    same = "<p>same\r\n\r\nbody</p>"
    rows = [(k, f"http://h{k % 5}.example.com/x{k % 3}", f"page {k} é" if k % 4 else same, "extra") for k in range(60)] + [(60, None, None, ""), (61, "http://a/", "", ""), (None, "http://b/", same, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, archive string").repartition(3)
    folder = warc.new_folder(spark)
    runs = warc.write_archives(df, folder)
    index = warc.merge_index(runs, per_range=10)
    got = sorted(index.collect(), key=lambda r: (r.part, r.position))
    assert [(r.urlkey, r.ts, r.page_id) for r in got] == sorted((r.urlkey, r.ts, r.page_id) for r in got) and len(got) == 63
    back = {r.page_id: r for r in warc.read_archives(index, folder).collect()}
    assert len(back) == 63
    for page_id, _, html, _ in rows:
        raw, b = (html or "").encode(), back[page_id]
        assert (b.payload_bytes, b.payload_digest) == (len(raw), warc.digest(raw))
        holder = 56 if html == same else 61 if not raw else page_id
        assert (b.record_type, b.refers_to) == (("response", None) if page_id == holder else ("revisit", holder))
        assert b.payload == (raw if page_id == holder else None)


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    folder = warc.new_folder(spark)
    assert warc.read_archives(warc.merge_index(warc.write_archives(df, folder)), folder).count() == 0
