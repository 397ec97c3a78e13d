"""Interleaved documents: ordered text and media references, with payloads in a content-addressed media table.

A page's HTML is parsed into an ordered list of structs, text blocks and media references with their captions; references
name a payload by its digest. The media table holds each payload once more or less (copies made by different tasks may
stand twice, the digest is the same), as an image file without loss: PNG, 64 pixels
wide, three 8-bit samples a pixel.
A join on the digest resolves references; what is asked of a payload is computed where it is stored, once for each digest,
so that payloads do not travel and a payload that a third of all documents share costs what any other does.

Defined results: a null page has no items; a reference that no stored payload has keeps its place with null fields; an
image without caption has its `alt` text or an empty caption; text outside known blocks is kept in order; repeated rows
give repeated documents; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

ROW = 192  # bytes: 64 pixels of three samples
SIGNATURE = b"\x89PNG\r\n\x1a\n"
ITEM = "array<struct<pos:int,kind:string,text:string,digest:string,caption:string>>"
_TAG = re.compile(r"<!--.*?(?:-->|$)|<(script|style)\b.*?(?:</\1\s*>|$)|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>", re.S | re.I)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_MEDIA = {"img": "image", "audio": "audio", "video": "video", "embed": "document"}
_BREAKS = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "td", "th", "tr", "table", "section", "article", "figure", "figcaption", "br", "blockquote", "pre", "body", "html", "head", "title"}


def padded(raw: bytes) -> bytes:
    """Blanks up to a positive multiple of a pixel row."""
    return raw + b" " * (-len(raw) % ROW or (0 if raw else ROW))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_image(payload: bytes) -> bytes:
    """A PNG image, 64 pixels wide, whose samples are the payload; no row is filtered."""
    height = len(payload) // ROW
    rows = np.zeros((height, 1 + ROW), np.uint8)
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(height, ROW)
    head = struct.pack(">IIBBBBB", ROW // 3, height, 8, 2, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows, 5)) + _chunk(b"IEND", b"")


def decode_image(stored: bytes) -> tuple[int, int, bytes]:
    """Width, height and samples of an image as `encode_image` writes it."""
    if not stored.startswith(SIGNATURE):
        raise ValueError("not a stored image")
    chunks: dict[bytes, bytes] = {}
    at = len(SIGNATURE)
    while at < len(stored):
        size, kind = struct.unpack_from(">I4s", stored, at)
        body = stored[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", stored, at + 8 + size)[0] != zlib.crc32(kind + body):
            raise ValueError("an image with a damaged chunk")
        chunks[kind] = chunks.get(kind, b"") + body
        at += 12 + size
    width, height, *form = struct.unpack(">IIBBBBB", chunks[b"IHDR"])
    rows = np.frombuffer(zlib.decompress(chunks[b"IDAT"]), np.uint8)
    if form != [8, 2, 0, 0, 0] or len(rows) != height * (1 + 3 * width):
        raise ValueError("an image of another form")
    rows = rows.reshape(height, -1)
    if rows[:, 0].any():
        raise ValueError("an image with filtered rows")
    return width, height, rows[:, 1:].tobytes()


def parse_items(page: str | None) -> list[dict]:
    """Text and media of a page in order. A figure's caption, wherever it stands in the figure and whatever is in it, belongs to
    the media of the figure; without media it is text. A medium without a source of its own has that of the first `source`
    in it."""
    out: list[dict] = []
    text: list[str] = []
    figure: list[dict] | None = None
    caption: list[str] = []
    in_caption = False
    at = 0

    def put_text() -> None:
        words = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if words and in_caption:
            caption.append(words)
        elif words:
            out.append({"kind": "text", "text": words, "digest": None, "caption": None})

    def end_figure() -> None:
        nonlocal figure, in_caption
        put_text()
        in_caption = False
        said = " ".join(caption)
        caption.clear()
        if said and figure:
            for x in figure:
                x["caption"] = said
        elif said:
            out.append({"kind": "text", "text": said, "digest": None, "caption": None})
        figure = None

    def digest_of(attrs: dict[str, str]) -> str | None:
        src = attrs.get("src", "")
        return src.removeprefix("sha256:") if src.startswith("sha256:") else None

    for m in _TAG.finditer(page or ""):
        text.append(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name in _BREAKS or name in _MEDIA:
            put_text()
        if name == "figure":
            end_figure()
            figure = None if m[2] else []
        elif name == "figcaption":
            put_text()
            in_caption = not m[2]
        elif name in _MEDIA and not m[2] or name == "source" and not m[2]:
            attrs = {k.lower(): entities.unescape(a or b or c) for k, a, b, c in _ATTR.findall(m[4])}
            if name == "source":
                if out and out[-1]["kind"] in _MEDIA.values() and out[-1]["digest"] is None:
                    out[-1]["digest"] = digest_of(attrs)
                continue
            item = {"kind": _MEDIA[name], "text": None, "digest": digest_of(attrs), "caption": attrs.get("alt", "")}
            out.append(item)
            if figure is not None:
                figure.append(item)
    text.append((page or "")[at:])
    end_figure()
    return [{"pos": i} | x for i, x in enumerate(out)]


def interleave(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """A row per page: id, items (ordered structs of pos, kind, text, digest, caption)."""
    kind = pa.list_(pa.struct([("pos", pa.int32()), *((k, pa.string()) for k in ("kind", "text", "digest", "caption"))]))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([parse_items(x) for x in b.column(1).to_pylist()], kind)], names=["id", "items"])

    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, f"id long, items {ITEM}")


FACTS = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_facts(media: DataFrame) -> DataFrame:
    """What the stored bytes say, a row per digest: FACTS. The payload is decoded from the stored form; `feature` has the
    image's size and the sum of samples of each channel."""

    def run(batches):
        for b in batches:
            rows = {}
            for key, stored in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if key in rows:
                    continue
                raw = stored.as_py()
                width, height, samples = decode_image(raw)
                sums = np.frombuffer(samples, np.uint8).reshape(-1, 3).sum(0, dtype=np.int64)
                rows[key] = (key, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(raw), hashlib.sha256(raw).hexdigest(), f"{width}x{height}:" + ":".join(map(str, sums)))
            types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            cols = list(zip(*rows.values(), strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[x.split()[0] for x in FACTS.split(", ")])

    return media.where("digest is not null").select("digest", "media").mapInArrow(run, FACTS).dropDuplicates(["digest"])


def resolve(items: DataFrame, facts: DataFrame) -> DataFrame:
    """`items` (id, items) with each media item's stored facts: a row per item in (id, pos), text items too. Only media
    items take part in the digest join."""
    each = items.select("id", F.monotonically_increasing_id().alias("copy"), F.explode("items").alias("x")).select("id", "copy", "x.*")
    return each.join(facts, "digest", "left").select("id", "copy", "pos", "kind", "text", "digest", "caption", *[c.split()[0] for c in FACTS.split(", ")[1:]])


def store_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every text as a padded payload in the media table, and a page that shows it; written: id, html, digest, media."""

    def run(batches):
        for b in batches:
            ids, pages, keys, media, seen = b.column(0), [], [], [], set()
            for doc, text in zip(ids.to_pylist(), b.column(1), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                payload = padded(raw)
                key = hashlib.sha256(payload).hexdigest()
                pages.append(f'<html><body><p>Document {doc}</p><figure><img src="sha256:{key}" alt=""><figcaption>{len(raw)} bytes</figcaption></figure></body></html>')
                keys.append(None if key in seen else key)  # a payload that this batch has stored already
                media.append(None if key in seen else encode_image(payload))
                seen.add(key)
            yield pa.RecordBatch.from_arrays([ids, pa.array(pages), pa.array(keys, pa.string()), pa.array(media, pa.binary())], names=["id", "html", "digest", "media"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(run, "id long, html string, digest string, media binary"), "media", "uncompressed")
