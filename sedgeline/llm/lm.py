"""N-gram language model by deleted interpolation.

Maximum-likelihood estimates of each order are mixed, `P_n = w_b * c(h, t) / c(h) + (1 - w_b) * P_(n-1)`, with a weight for
each bucket `b` of the context's frequency, learnt by expectation-maximisation on counts held out from the training texts
(the deleted tenth); the lowest order is the additive unigram estimate. Final counts take all training texts.

How it runs. Texts are put in blocks of a few megabytes. A block sends, for each order, the sorted hashes of its distinct
n-grams with their training counts to shards by hash range, once each, as packed arrays; a shard sums them over blocks and
sends back to each block the total counts of the n-grams that the block holds. A block then has all it needs to score
its texts. Frequent words and copied texts cost a shard no more than others, shards are as many as the text volume asks
for, and no task or driver sees more than a block, a shard or the weight tables. Mixture weights need a histogram of
ratios by bucket, which is all that the driver gets.

Words are hashed to 64 bits, longer n-grams to 48. Defined results: a null text is an empty text and has its end token
alone; a null id is held out; repeated rows count and are scored each; with no training text every probability is the
uniform one over the unknown word alone; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import written

ORDER = 3
BLOCK = 4 << 20
SHARD = 24 << 20
ADD = 0.1
U = np.uint64
END, BEGIN = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)
STEP = 50  # histogram cells to a factor of ten
BLOCKS = "block long, deleted boolean, ids binary, held binary, sizes binary, bytes long, text binary"
GRAMS = "shard int, block long, n int, deleted boolean, hashes binary, counts binary"
TOTALS = "block long, n int, shard int, total binary, kept binary, distinct long, tokens long, kept_distinct long, kept_tokens long"


def _zip(x: np.ndarray) -> bytes:
    """Planes of bytes, compressed: small numbers and gaps of sorted hashes leave the high planes empty."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unzip(b: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def fold(doc_id) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def _blocks(batches):
    """Texts into blocks; those of the deleted tenth into blocks of their own."""
    from pyspark import TaskContext

    part, made = TaskContext.get().partitionId(), 0
    open_: dict[bool, list] = {False: [], True: []}

    def close(deleted):
        nonlocal made
        rows = open_[deleted]
        open_[deleted] = []
        text = b"".join(t for _, _, t in rows)
        out = [(part << 32) + made, deleted, np.array([i if i is not None else 0 for i, _, _ in rows], np.int64).tobytes(), np.array([(h == 0) + 2 * (i is None) for i, h, _ in rows], np.uint8).tobytes(), np.array([len(t) for _, _, t in rows], np.int64).tobytes(), len(text), zstandard.ZstdCompressor(level=3).compress(text)]
        made += 1
        return pa.RecordBatch.from_pydict({k: [v] for k, v in zip(("block", "deleted", "ids", "held", "sizes", "bytes", "text"), out, strict=True)})

    full = {False: 0, True: 0}
    for b in batches:
        for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            k = fold(doc)
            deleted = k % 10 != 0 and k // 10 % 10 == 0
            raw = (text.as_py() or "").encode()
            if open_[deleted] and full[deleted] + len(raw) > BLOCK:
                yield close(deleted)
                full[deleted] = 0
            open_[deleted].append((doc, k % 10, raw))
            full[deleted] += len(raw)
    for deleted in (False, True):
        if open_[deleted]:
            yield close(deleted)


_LOWER_MAP = W._MAP[W.LOWER]


def _tokens(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of a block's texts, an end after each, and the number of tokens of each text."""
    sizes = np.frombuffer(row["sizes"], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"]), np.uint8) if row["bytes"] else np.zeros(0, np.uint8)
    hashes, counts = [], []
    for a, b in W.chunks(offsets):
        part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, n = W.split(part, off)
        out = np.full(len(starts) + len(n), END)
        out[np.arange(len(starts)) + np.repeat(np.arange(len(n)), n)] = W.hashed(part, starts, ends, _LOWER_MAP)
        hashes.append(out)
        counts.append(n + 1)
    return np.concatenate(hashes), np.concatenate(counts)


def _grams(tokens: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n-gram that ends at each token; before a text stand begin marks."""
    if n == 1:
        return tokens
    at = np.arange(len(tokens)) - np.repeat(np.cumsum(counts) - counts, counts)
    with np.errstate(over="ignore"):
        h = tokens.copy()
        for back in range(1, n):
            prev = np.full(len(tokens), BEGIN)
            prev[back:] = tokens[:-back]
            prev[at < back] = BEGIN
            h = h * U(0xD1342543DE82EF95) + W.mix(prev + U(back))
        return W.mix(h + U(n)) >> U(16)


def _shard(hashes: np.ndarray, n: int, shards: int) -> np.ndarray:
    """Shards are ranges, so that a block's sorted hashes lie shard by shard."""
    top = hashes >> U(32) if n == 1 else hashes >> U(16)
    return (top * U(shards)) >> U(32)


def _send(batches, order: int, shards: int):
    for b in batches:
        for row in b.to_pylist():
            tokens, counts = _tokens(row)
            train = np.repeat(np.frombuffer(row["held"], np.uint8) == 0, counts)
            for n in range(1, order + 1):
                uniq, inverse = np.unique(_grams(tokens, counts, n), return_inverse=True)
                c = np.bincount(inverse, train, len(uniq)).astype(np.uint32)
                edges = np.searchsorted(_shard(uniq, n, shards), np.arange(shards + 1, dtype=U))
                cols: dict[str, list] = {k: [] for k in ("shard", "block", "n", "deleted", "hashes", "counts")}
                for s in range(shards):
                    x, y = edges[s], edges[s + 1]
                    if x < y:
                        gaps = np.diff(uniq[x:y], prepend=U(0))
                        for k, v in zip(cols, (s, row["block"], n, row["deleted"], _zip(gaps), _zip(c[x:y])), strict=True):
                            cols[k].append(v)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols.values(), (pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()), strict=True)], names=list(cols))


def _sum(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    out = []
    for n in sorted({r["n"] for r in rows}):
        own = [r for r in rows if r["n"] == n]
        hashes = [np.cumsum(_unzip(r["hashes"], U), dtype=U) for r in own]
        counts = [_unzip(r["counts"], np.uint32) for r in own]
        ends = np.cumsum([len(h) for h in hashes])
        uniq, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(inverse, np.concatenate(counts), len(uniq)).astype(np.uint32)
        kept = np.bincount(inverse, np.concatenate([c * (not r["deleted"]) for r, c in zip(own, counts, strict=True)]), len(uniq)).astype(np.uint32)
        shard = own[0]["shard"]
        for r, end, h in zip(own, ends, hashes, strict=True):
            at = inverse[end - len(h) : end]
            out.append((r["block"], n, shard, _zip(total[at]), _zip(kept[at]) if r["deleted"] else None, 0, 0, 0, 0))
        if n == 1:
            out.append((-1, 0, shard, None, None, int((total > 0).sum()), int(total.sum()), int((kept > 0).sum()), int(kept.sum())))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4), strict=True)], names=[x.split()[0] for x in TOTALS.split(", ")])


def _looked_up(block: pa.Table, totals: pa.Table, order: int, column: str):
    """Counts of each token's n-grams by order, and the tokens of each text."""
    row = block.to_pylist()[0]
    tokens, counts = _tokens(row)
    got = sorted((r for r in totals.select(["n", "shard", column]).to_pylist()), key=lambda r: (r["n"], r["shard"]))
    found = []
    for n in range(1, order + 1):
        _, inverse = np.unique(_grams(tokens, counts, n), return_inverse=True)
        found.append(np.concatenate([_unzip(r[column], np.uint32) for r in got if r["n"] == n])[inverse].astype(float))
    return row, counts, found


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(context, 1)).astype(int), 47)


def _estimates(found: list, counts: np.ndarray, size: tuple, weights: list, upto: int):
    """P of order `upto`, and the plain estimate and context count of the order above (or None)."""
    tokens, distinct, docs = size
    p = (found[0] + ADD) / (tokens + ADD * (distinct + 1))
    first = np.cumsum(counts) - counts
    plain = context = None
    for n in range(2, min(len(found), upto + 1) + 1):
        context = np.empty(len(p))
        context[1:] = found[n - 2][:-1]
        context[first] = docs
        plain = np.divide(found[n - 1], context, out=np.zeros(len(p)), where=context > 0)
        if n <= upto:
            w = np.where(context > 0, weights[n - 2][_bucket(context)], 0.0)
            p = w * plain + (1 - w) * p
    return p, plain, context


def _ratios(key, block: pa.Table, totals: pa.Table, order: int, size: tuple, weights: list) -> pa.Table:
    """Histogram of (bucket, plain / lower estimate) over the tokens of the deleted texts."""
    n = len(weights) + 2
    if not block.num_rows or not totals.num_rows:
        b = q = c = np.zeros(0, np.int64)
    else:
        _, counts, found = _looked_up(block, totals, order, "kept")
        p, plain, context = _estimates(found, counts, size, weights, n - 1)
        seen = context > 0
        r = plain[seen] / p[seen]
        cell = np.where(r > 0, np.round(STEP * np.log10(np.maximum(r, 1e-300))), -32768).astype(np.int64)
        pairs, c = np.unique(_bucket(context[seen]) * 65536 + cell + 32768, return_counts=True)
        b, q = pairs >> 16, (pairs & 65535) - 32768
    return pa.table({"b": pa.array(b, pa.int64()), "q": pa.array(q, pa.int64()), "c": pa.array(c, pa.int64())})


def learn_weights(cells: list[tuple[int, int, int]], rounds: int = 200) -> np.ndarray:
    """Expectation-maximisation for each bucket's weight; buckets without tokens take the next lower one's."""
    out, last = np.zeros(48), 0.0
    for b in range(48):
        own = [(q, c) for x, q, c in cells if x == b]
        if own:
            r = np.array([0.0 if q == -32768 else 10 ** (q / STEP) for q, _ in own])
            c, w = np.array([c for _, c in own], float), 0.5
            for _ in range(rounds):
                w = float((c * (w * r / (w * r + 1 - w + 1e-300))).sum() / c.sum())
            last = min(w, 1 - 1e-6)
        out[b] = last
    return out


def _scores(key, block: pa.Table, totals: pa.Table, order: int, size: tuple, weights: list) -> pa.Table:
    names = [x.split() for x in SCORES.split(", ")]
    types = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    if not block.num_rows:
        return pa.Table.from_arrays([pa.array([], types[t]) for _, t in names], names=[n for n, _ in names])
    row, counts, found = _looked_up(block, totals, order, "total")
    p, _, _ = _estimates(found, counts, size, weights, order)
    base = np.log10((found[0] + ADD) / (size[0] + ADD * (size[1] + 1)))
    first = np.cumsum(counts) - counts
    flags = np.frombuffer(row["held"], np.uint8)
    ids = pa.array(np.frombuffer(row["ids"], np.int64), pa.int64(), mask=flags & 2 > 0)
    cols = [ids, flags & 1 > 0, counts, np.add.reduceat((found[0] > 0).astype(np.int64), first), np.full(len(counts), size[0], np.int64), np.add.reduceat(base, first), np.add.reduceat(np.log10(p), first)]
    return pa.Table.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(cols, names, strict=True)], names=[n for n, _ in names])


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, order: int = ORDER) -> DataFrame:
    """Scores every text; texts whose crc32(id) mod 10 is 0 are not learnt from. Columns: SCORES."""
    blocks = written(df.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(_blocks, BLOCKS), "lm-blocks", "uncompressed")
    volume, docs, kept_docs = blocks.select("bytes", "deleted", "held").mapInArrow(_volume, "bytes long, docs long, kept long").agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("kept"), F.lit(0))).first()
    shards = int(volume // SHARD) + 1
    grams = blocks.mapInArrow(partial(_send, order=order, shards=shards), GRAMS)
    totals = written(grams.groupBy("shard").applyInArrow(_sum, TOTALS), "lm-totals", "uncompressed")
    distinct, tokens, kept_distinct, kept_tokens = (int(x or 0) for x in totals.where("n = 0").agg(*(F.sum(c) for c in ("distinct", "tokens", "kept_distinct", "kept_tokens"))).first())
    counts = totals.where("n > 0").select("block", "n", "shard", "total")
    some = totals.where("n > 0 and kept is not null").select("block", "n", "shard", "kept")
    weights: list[np.ndarray] = []
    for _ in range(2, order + 1):
        run = partial(_ratios, order=order, size=(kept_tokens, kept_distinct, kept_docs), weights=list(weights))
        cells = blocks.where("deleted").groupBy("block").cogroup(some.groupBy("block")).applyInArrow(_keyed(run), "b long, q long, c long")
        weights.append(learn_weights([tuple(r) for r in cells.groupBy("b", "q").agg(F.sum("c")).collect()]))
    run = partial(_scores, order=order, size=(tokens, distinct, docs), weights=weights)
    return blocks.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(_keyed(run), SCORES)


def _keyed(run):
    return lambda key, left, right: run(key, left, right)


def _volume(batches):
    for b in batches:
        held = [np.frombuffer(x, np.uint8) for x in b.column(2).to_pylist()]
        docs = [int((h == 0).sum()) for h in held]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(docs, pa.int64()), pa.array([d * (not x) for d, x in zip(docs, b.column(1).to_pylist(), strict=True)], pa.int64())], names=["bytes", "docs", "kept"])
