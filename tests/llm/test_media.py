"""Media: lossless store, order of items, digest join."""

import hashlib
import struct
import zlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from sedgeline.llm import media, queries


@given(st.binary(max_size=1000))
def test_lossless(raw):
    p = media.padded(raw)
    assert len(p) % 192 == 0 and len(p) > 0 and p.startswith(raw) and p[len(raw) :].strip(b" ") == b""
    assert media.decode_image(media.encode_image(p))[2] == p


def test_items_stay_in_order():
    page = '<p>one &amp; two</p><figure><img src="sha256:aa" alt="x"><figcaption>cap <b>A</b></figcaption></figure>mid<script>no("<p>")</script><audio src="sha256:bb"></audio><img alt="alone" src="http://x"><p>end'
    got = [(x["pos"], x["kind"], x["text"], x["digest"], x["caption"]) for x in media.parse_items(page)]
    assert got == [(0, "text", "one & two", None, None), (1, "image", None, "aa", "cap A"), (2, "text", "mid", None, None), (3, "audio", None, "bb", ""), (4, "image", None, None, "alone"), (5, "text", "end", None, None)]
    assert media.parse_items(None) == []


def test_resolve_keeps_missing(spark):
    pages = spark.createDataFrame([(1, '<img src="sha256:zz">t'), (2, None)], "id long, html string")
    facts = media.media_facts(spark.createDataFrame([], "digest string, media binary"))
    got = [(r.id, r.pos, r.kind, r.media_bytes) for r in media.resolve(media.interleave(pages, "id", "html"), facts).collect()]
    assert sorted(got) == [(1, 0, "image", None), (1, 1, "text", None)]


def test_query_against_plain(spark, tmp_path):
    rows = [(1, "héllo"), (2, None), (3, ""), (4, "héllo"), (5, "x" * 192), (6, "y" * 193 + "\x00<p>"), (None, "n"), (1, "héllo")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS digest", "1 AS pos").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r.doc_id or 0), r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in queries.op5_interleaved_media(spark, str(tmp_path)).collect())
    want = []
    for i, t in rows:
        p = media.padded((t or "").encode())
        want.append((i or 0, len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])))
    assert got == sorted(want)


def test_stored_form_is_png():
    raw = media.padded(bytes(range(256)) * 2)
    stored = media.encode_image(raw)
    assert stored[:8] == b"\x89PNG\r\n\x1a\n" and stored[12:16] == b"IHDR" and stored[-8:-4] == b"IEND"
    assert struct.unpack(">IIBBBBB", stored[16:29]) == (64, 3, 8, 2, 0, 0, 0)
    size = struct.unpack(">I", stored[33:37])[0]
    rows = zlib.decompress(stored[41 : 41 + size])
    assert b"".join(rows[k * 193 + 1 : (k + 1) * 193] for k in range(3)) == raw and rows[::193] == b"\0\0\0"
    for bad in (b"P6", stored[:45] + b"!" + stored[46:]):
        with pytest.raises(ValueError):
            media.decode_image(bad)


def test_stored_columns_against_plain(spark, tmp_path):
    rows = [(k, t) for k, t in enumerate(["abc", None, "abc", "é" * 500, "z" * 100_000])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op5_interleaved_media(spark, str(tmp_path)).collect():
        p = media.padded((rows[r.doc_id][1] or "").encode())
        stored = media.encode_image(p)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert r.feature == f"64x{len(p) // 192}:" + ":".join(str(sum(p[c::3])) for c in range(3))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<figure><figcaption>Cap</figcaption><img src='sha256:aa'></figure>", [("image", None, "aa", "Cap")]),
        ("<figure><img><figcaption>One <p>para</p> two</figcaption></figure>after", [("image", None, None, "One para two"), ("text", "after", None, None)]),
        ("<figure><img alt='x'>said<video><source src='sha256:bb'><source src='sha256:cc'></video><figcaption>both</figcaption></figure>", [("image", None, None, "both"), ("text", "said", None, None), ("video", None, "bb", "both")]),
        ("a<figure><figcaption>only words</figcaption></figure>b", [("text", "a", None, None), ("text", "only words", None, None), ("text", "b", None, None)]),
        ("<figure><img src='sha256:aa'><figcaption>not ended", [("image", None, "aa", "not ended")]),
    ],
)
def test_captions(page, want):
    assert [(x["kind"], x["text"], x["digest"], x["caption"]) for x in media.parse_items(page)] == want
