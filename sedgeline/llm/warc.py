"""WARC archives with a globally ordered capture index, made by an external merge of sorted runs.

Writing: each task writes gzip members, one per record, to archives of bounded size in a shared folder, and gives out its
captures as runs, each sorted by URL key and timestamp. A capture whose payload another capture holds (equal payload, of
these the largest id) becomes a revisit record, which carries the HTTP head with the payload's length but not the payload.

Merging: the index is cut into ranges, one partition each, by a range exchange on the whole key; within a range every run's
slice is a sorted stream, and a loser tree merges them k ways. Ranges in order are the global order: capture histories by
URL. A task holds one range, in columns; that is a bounded number of captures, because cuts fall on (key, timestamp, id,
place in an archive) and a URL with very many captures is cut too. No key comes to the driver but the exchange's sample,
which the engine bounds.

Archives are written under the task's attempt, and only those named in the written index are read, so that a task that
runs again leaves no double. Reading goes by the merged index: archive by archive, in order of offset, record by record.

Defined results: a null payload is empty; a null URL has the empty key and comes first; null timestamps come first;
repeated rows of one id and payload are a response each; a null id takes part, below all others; empty tables give no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import islice
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, written

ARCHIVE = 32 << 20
RUN = 20_000
RANGE = 200_000
NONE = -(1 << 63)
INDEX = "run long, urlkey string, ts long, page_id long, record_type string, digest string, archive string, start long, size long"


def url_key(url: str | None) -> str:
    """Sort-friendly form: host labels turned round, no scheme, port, fragment or leading www; path and query in lower case."""
    if not url:
        return ""
    try:
        u = urlsplit(url if "://" in url else f"//{url}")
        host = re.sub(r"^www\d*\.", "", u.hostname or "")
    except ValueError:
        return url.lower()
    return ",".join(reversed(host.split("."))) + ")" + (u.path or "/").lower() + (f"?{u.query.lower()}" if u.query else "")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class LoserTree:
    """K-way merge: inner nodes hold the losers of matches between runs, so that each step replays one path."""

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        k = max(len(runs), 1)
        self.k = 1 << (k - 1).bit_length()
        self.heads = [next(r, None) for r in runs] + [None] * (self.k - len(runs))
        self.losers = [0] * self.k
        self.winner = self._play(1)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        win, lose = (a, b) if self._before(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def __iter__(self):
        while self.heads[self.winner] is not None:
            w = self.winner
            yield self.heads[w]
            self.heads[w] = next(self.runs[w], None)
            node = (w + self.k) >> 1
            while node:
                if self._before(self.losers[node], w):
                    w, self.losers[node] = self.losers[node], w
                node >>= 1
            self.winner = w


def record(url: str, ts: int, page_id: int, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC record of an HTTP response, or of a revisit of the same payload of page `refers_to`."""
    date = "%04d-%02d-%02dT%02d:%02d:%02dZ" % _utc(ts)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = head if refers_to is not None else head + payload
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def _line(x: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", x)


def _utc(ts: int) -> tuple:
    import datetime

    t = datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=min(max(ts, -(10**10)), 10**11))
    return t.year, t.month, t.day, t.hour, t.minute, t.second


def parse(data: bytes) -> dict:
    """One record: its header fields, the payload's length and digest (of a revisit: as its heads say), and the payload."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = lambda x: int(re.fullmatch(r"<urn:page:(-?\d+)>", x)[1])
    out = {"page_id": page(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"], "url": fields["WARC-Target-URI"], "refers_to": None}
    if fields["WARC-Type"] == "revisit":
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        return out | {"refers_to": page(fields["WARC-Refers-To"]), "payload_bytes": size, "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "payload": None}
    return out | {"payload_bytes": len(payload), "payload_digest": digest(payload), "payload": payload}


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _write(batches, folder: str):
    """Archives of at most about ARCHIVE bytes; index rows in sorted runs."""
    from pyspark import TaskContext

    fs, root = _fs(folder)
    ctx = TaskContext.get()
    stem, made, buffer, rows, runs = f"{ctx.partitionId():07d}-{ctx.taskAttemptId()}", 0, io.BytesIO(), [], 0

    def flush():
        nonlocal made, buffer
        if buffer.tell():
            with fs.open_output_stream(f"{root}/{stem}-{made:05d}.warc.gz", compression=None) as f:
                f.write(buffer.getbuffer())
            made, buffer = made + 1, io.BytesIO()

    def run():
        nonlocal rows, runs
        rows.sort(key=lambda r: r[:3])
        run_id = (ctx.partitionId() << 32) + runs
        runs, out, rows = runs + 1, rows, []
        return pa.RecordBatch.from_arrays([pa.array([run_id] * len(out), pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True))], names=[x.split()[0] for x in INDEX.split(", ")])

    for b in batches:
        for page_id, url, ts, html, refers_to in zip(*(c if i == 3 else c.to_pylist() for i, c in enumerate(b.columns)), strict=True):
            payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
            page_id = NONE if page_id is None else page_id
            data = gzip.compress(record(url or "", ts or 0, page_id, payload, refers_to), 1, mtime=0)
            rows.append((url_key(url), NONE if ts is None else ts, page_id, "response" if refers_to is None else "revisit", digest(payload), f"{stem}-{made:05d}.warc.gz", buffer.tell(), len(data)))
            buffer.write(data)
            if buffer.tell() >= ARCHIVE:
                flush()
            if len(rows) >= RUN:
                yield run()
    flush()
    if rows:
        yield run()


def write_archives(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", ts_col: str | None = None, html_col: str = "html") -> DataFrame:
    """Writes every page to WARC archives in `folder`; returns the index in sorted runs (INDEX), itself written.
    Without a timestamp column a page's time is its id in seconds."""
    ts = F.col(ts_col).cast("long") if ts_col else F.col(id_col).cast("long")
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), ts.alias("ts"), F.col(html_col).alias("html"))
    key = [F.sha1(html.cast("binary")).alias("sha"), F.octet_length(html).alias("len")]
    # Only payloads that occur under more than one id have revisits; most pages join nothing.
    held = pages.select(F.col(id_col).cast("long").alias("p"), *key).groupBy("sha", "len").agg(F.max("p").alias("holder"), F.count("*").alias("n")).where("n > 1 and holder is not null")
    marked = pages.select(F.col(id_col).cast("long").alias("p"), *key).join(held, ["sha", "len"]).where("p is null or p < holder").select("p", "sha", "holder").distinct()
    rows = rows.withColumn("sha", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    same = rows["page_id"].eqNullSafe(marked["p"]) & (rows["sha"] == marked["sha"])
    rows = rows.join(marked, same, "left").select("page_id", "url", "ts", "html", F.col("holder").alias("refers_to"))
    return written(rows.mapInArrow(partial(_write, folder=folder), INDEX), "warc-runs")


#: Columns of the index as the merge compares them: the first five tell captures apart, equal ones included.
MERGED = ("urlkey", "ts", "page_id", "archive", "start", "record_type", "digest", "size", "run")


def _stream(pieces: list, step: int = 512) -> Iterator[tuple]:
    """The rows of one run's slice, decoded a few at a time."""
    for b, x, y in pieces:
        for i in range(x, y, step):
            yield from zip(*(c.to_pylist() for c in b.slice(i, min(step, y - i)).columns), strict=True)


def _merge(batches):
    """One range, which comes run by run: its slices stay in columns, and a loser tree merges them as streams."""
    from pyspark import TaskContext

    part, position, slices = TaskContext.get().partitionId(), 0, {}
    for b in batches:
        runs = b.column(len(MERGED) - 1).to_numpy()
        cuts = [0, *(np.flatnonzero(runs[1:] != runs[:-1]) + 1).tolist(), len(runs)]
        for x, y in zip(cuts, cuts[1:], strict=False):
            if x < y:
                slices.setdefault(int(runs[x]), []).append((b, x, y))
    merged = iter(LoserTree([_stream(x) for x in slices.values()]))
    names = [x.split()[0] for x in INDEX.split(", ")]
    while rows := list(islice(merged, 10_000)):
        cols = dict(zip(MERGED, zip(*rows, strict=True), strict=True))
        at = np.arange(position, position + len(rows))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), part)), pa.array(at), *(pa.array(cols[n], _ARROW[n]) for n in names)], names=["part", "position", *names])
        position += len(rows)


_ARROW = {"run": pa.int64(), "urlkey": pa.string(), "ts": pa.int64(), "page_id": pa.int64(), "record_type": pa.string(), "digest": pa.string(), "archive": pa.string(), "start": pa.int64(), "size": pa.int64()}


def merge_index(runs: DataFrame, per_range: int | None = None) -> DataFrame:
    """The runs as one index in global order: (part, position) rank the captures; rows of a URL are its history.
    A range is a partition of about `per_range` captures, by default what keeps all cores busy, but at least a run and at
    most RANGE; how even the engine's sample of keys is affects the size of ranges only."""
    total = runs.count()
    per_range = per_range or max(RUN, min(RANGE, total // runs.sparkSession.sparkContext.defaultParallelism))
    ranged = runs.select(*MERGED).repartitionByRange(max(1, -(-total // per_range)), *MERGED[:5])
    return ranged.sortWithinPartitions("run", *MERGED[:5]).mapInArrow(_merge, f"part long, position long, {INDEX}")


def _read(batches, folder: str, payloads: bool):
    fs, root = _fs(folder)
    name, f = None, None
    cols = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    for b in batches:
        rows = []
        for archive, start, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if archive != name:
                name, f = archive, fs.open_input_file(f"{root}/{archive}")
            rows.append(parse(zlib.decompress(f.read_at(size, start), 31)))
        types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        ids = [None if r["page_id"] == NONE else r["page_id"] for r in rows]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array([r[c] if payloads or c != "payload" else None for r in rows], t) for c, t in zip(cols[1:], types[1:], strict=True))], names=list(cols))


def read_archives(index: DataFrame, folder: str, *, payloads: bool = True) -> DataFrame:
    """Every capture of the index, read from its archive: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload (of responses). Archives are dealt out whole, their records read in order."""
    where = index.select("archive", "start", "size").repartition("archive").sortWithinPartitions("archive", "start")
    return where.mapInArrow(partial(_read, folder=folder, payloads=payloads), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def new_folder(spark) -> str:
    """A folder for archives in the shared one."""
    folder = scratch(spark, "warc")
    fs, root = _fs(folder)
    fs.create_dir(root, recursive=True)
    return folder
