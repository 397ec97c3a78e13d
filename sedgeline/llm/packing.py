"""Sum-of-squares online packing of token streams into fixed windows.

Each task packs its own rows in the order in which it reads them, so that there is no shuffle and no state beyond the
open windows of one task. A document's full windows are cut off its front; the rest, shorter than a window, goes to the
fill level that minimises the sum of squared counts of partially filled windows, which a level array tracks. At the end
of a task the emptiest of the windows still open are emptied, one by one, and their pieces, cut where needed, fill the
fullest ones up; all others stay as they were placed. What then remains, less than one window for each task, goes to
sequences whose lengths are powers of two and need no padding.

Defined results: special tokens inside a text get their ids, as the library does; a null text is an empty text; an empty text is the end token alone; repeated rows are packed once each;
a null id stays null; an empty table gives no rows; columns other than the two named are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 2048
END = 1

# Texts of other characters go to the vocabulary's own library, as the two split rules could differ on them.
_ODD = re.compile("[^\x00-\x1b\x20-\u024f]")


class WordTokenizer:
    """Ids of a byte-level BPE vocabulary file of the `tokenizers` library. Common texts are encoded, to the same ids, by
    `tiktoken` from the file's own table, which takes a third of the CPU time; texts with rare characters or with special
    tokens by `tokenizers`."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        added = sorted(t.content for t in self.lib.get_added_tokens_decoder().values())
        self.odd = re.compile("|".join([_ODD.pattern, *map(re.escape, added)]))
        # The byte-level alphabet: printable bytes stand for themselves, the others follow from code point 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(byte[c] for c in w): i for w, i in self.lib.get_vocab(with_added_tokens=False).items() if all(c in byte for c in w) and not w.startswith("<|")}
        self.fast = tiktoken.Encoding("table", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.odd.search(text):
            return np.array(self.lib.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


class SumOfSquares:
    """Open windows by fill level; `place` names the level that an item goes to."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window + 1)]

    def place(self, size: int) -> int:
        """The level, 0 for a new window, that gives the least sum of squares; of equals the fullest."""
        levels = np.flatnonzero(self.count[: self.window - size + 1])
        up = 2 * self.count + 1
        up[self.window] = 0
        best = up[levels + size] - 2 * self.count[levels] + 1
        if not len(levels) or up[size] < best.min():
            return 0
        return int(levels[np.flatnonzero(best == best.min())[-1]])

    def add(self, piece: tuple, size: int) -> list | None:
        """Puts a piece in its window; returns the window when that is full."""
        level = self.place(size)
        pieces = self.open[level].pop() if level else []
        if level:
            self.count[level] -= 1
        pieces.append(piece)
        if level + size == self.window:
            return pieces
        self.open[level + size].append(pieces)
        self.count[level + size] += 1
        return None

    def rest(self) -> list[tuple[int, list]]:
        """The windows still open with their fill, the fullest first."""
        return [(fill, pieces) for fill in range(self.window - 1, 0, -1) for pieces in self.open[fill]]


def _pieces(docs: Iterator[tuple], window: int) -> Iterator[list]:
    """Closed windows, each a list of (doc, start, ids, doc_tokens)."""
    bins = SumOfSquares(window)
    for doc, ids in docs:
        n, cut = len(ids), len(ids) - len(ids) % window
        for s in range(0, cut, window):
            yield [(doc, s, ids[s : s + window], n)]
        if cut < n and (full := bins.add((doc, cut, ids[cut:], n), n - cut)):
            yield full
    yield from _closed(bins.rest(), window)


def _closed(left: list[tuple[int, list]], window: int) -> Iterator[list]:
    """Open windows, the fullest first, closed: what the emptiest ones hold fills up the others."""
    pool: list = []
    first, last = 0, len(left) - 1

    def take(room: int) -> list:
        """Up to so many tokens from the pool, the last piece cut if need be."""
        out = []
        while room and pool:
            doc, s, ids, n = pool.pop()
            out.append((doc, s, ids[:room], n))
            if len(ids) > room:
                pool.append((doc, s + room, ids[room:], n))
            room -= len(out[-1][2])
        return out

    while first <= last:
        fill, pieces = left[first]
        while fill < window and (pool or first < last):
            if not pool:
                pool += reversed(left[last][1])
                last -= 1
            got = take(window - fill)
            pieces = pieces + got
            fill += sum(len(p[2]) for p in got)
        first += 1
        if fill == window:
            yield pieces
        else:  # the last one, and the pool is empty
            pool += reversed(pieces)
    total = sum(len(p[2]) for p in pool)
    for size in (1 << b for b in range(window.bit_length(), -1, -1) if total >> b & 1):
        yield take(size)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = WINDOW, tokenizer: str | None = None, end_id: int = END, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens; with `with_ids`
    also the token ids. `tokenizer` is the path of a vocabulary file, by default the public byte-level one.
    `sequence_id` is the task's number times 2**33 and a count: the same when a task runs again."""

    def run(batches):
        from pyspark import TaskContext

        import public_tokenizers

        words = WordTokenizer(tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
        end = np.array([end_id], np.uint32)

        def docs():
            for b in batches:
                for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    yield doc, np.concatenate([words.encode(text.as_py() or ""), end])

        first, rows = TaskContext.get().partitionId() << 33, []

        def batch():
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for k, pieces in enumerate(_pieces(docs(), window)):
            at, total = 0, sum(len(p[2]) for p in pieces)
            for doc, start, ids, n in pieces:
                rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, first + k, at, total) + ((ids.tolist(),) if with_ids else ()))
                at += len(ids)
            if len(rows) >= 4096:
                yield batch()
                rows.clear()
        if rows:
            yield batch()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens"]
    schema = pa.schema([(n, pa.int64()) for n in names] + [("ids", pa.list_(pa.int32()))] * with_ids)
    ddl = ", ".join(f"{n} long" for n in names) + ", ids array<int>" * with_ids
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, ddl)
