"""Maximal periodic runs of words, by the Main-Lorentz division of texts.

A run is a stretch of words with smallest period q that is at least `least` words and `times` periods long and that no
neighbouring word extends. Words are interned to numbers; a stretch is halved, the Z-functions of its right half before its
left one and of its mirrored left half before its mirrored right one tell, for every period at once, how far the words on
both sides of the middle agree, which gives all repetitions that cross the middle; both halves are treated alike. A part
that ends at a border of its stretch where it could go on is left to the stretch around it, which holds it whole; of equal
intervals the smallest period stays.

Most texts hold no run, and what holds none is not divided. In a run of period q the same n-gram of words stands q words
earlier, again and again, so that a run lies within a window of n-grams each of which has occurred within the last D words
(q <= D < 2q). These windows are found for all texts of a batch together, for D doubling, by one sort of n-gram hashes.
Unequal n-grams of equal hashes could only make a window longer, never lose one; inside windows words are told apart by their bytes.

Defined results: a null text has no words; a null id stays null; repeated rows are treated each; an empty table gives no
rows; columns other than the two named are ignored, whatever their names. A text is held whole by one task. Words are
parted by blank, tab, line feed, vertical tab, form feed and carriage return.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

LEAST, TIMES = 24, 3
U = np.uint64
RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", _RUN), ("collapsed", pa.string())])


def z_function(s: list[int]) -> list[int]:
    """For each place, how many items from there on agree with those from the start on."""
    n = len(s)
    z = [n] + [0] * (n - 1)
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def runs_of(s: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of a sequence of numbers, by start and period."""
    found: dict[tuple[int, int], int] = {}
    todo = [(0, len(s))]
    while todo:
        a, b = todo.pop()
        if b - a < least:
            continue
        m = (a + b) // 2
        todo += [(a, m), (m, b)]
        left, right = s[a:m], s[m:b]
        nl, nr = len(left), len(right)
        # -1 is no word. One array has how far the right half agrees with itself and with each end of the left half,
        # the other, read backwards, how far the left half does with itself and with each start of the right half.
        fore = np.array(z_function([*right, -1, *left]) + [0])
        left.reverse()
        right.reverse()
        back = np.array(z_function([*left, -1, *right]) + [0])
        # A period whose one repeat is to the left of the middle ...
        p = np.arange(1, nl + 1)
        on, behind = fore[nr + 1 + nl - p], back[p]
        behind[-1] = 0
        whole = on >= p
        ahead = np.where(p < nr, fore[np.minimum(p, nr)], 0)
        start, end = m - p - behind, np.where(whole, m + p + ahead, m + on)
        one = _long(start, end, p, least, times)
        # ... and one whose repeat is to the right of it, and which does not go back by all of a period.
        p = np.arange(1, nr + 1)
        ahead = fore[p]
        ahead[-1] = 0
        behind = back[nl + 1 + nr - p]
        start, end = m - behind, m + p + ahead
        start = np.where(behind >= p, b, start)  # found above
        for x, y, q in one + _long(start, end, p, least, times):
            if (x > 0 and x == a and s[x - 1] == s[x - 1 + q]) or (y < len(s) and y == b and s[y] == s[y - q]):
                continue
            if q < found.get((x, y), len(s)):
                found[x, y] = q
    return sorted((x, y - x, q) for (x, y), q in found.items())


def _long(start: np.ndarray, end: np.ndarray, p: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    on = np.flatnonzero(end - start >= np.maximum(least, times * p))
    return list(zip(start[on].tolist(), end[on].tolist(), p[on].tolist(), strict=True))


def windows(hashes: np.ndarray, counts: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """Disjoint stretches of the words of texts that lie end to end; each run of a text lies within one of them."""
    first = max(least // times, 1)
    shortest = least - first  # of any period up to `first`, so many words at least have one like them a period earlier
    n = max(shortest // 2, 1)
    if not len(hashes) or counts.max(initial=0) < least:
        return []
    text = np.repeat(np.arange(len(counts)), counts)
    with np.errstate(over="ignore"):
        g, size = W.mix(hashes + W.mix(text.astype(U) + U(1))), 1
        while size < n:
            more = min(size, n - size)
            ahead = np.zeros(len(g), U)
            ahead[:-more] = g[more:]
            g, size = W.mix(g * U(0xD1342543DE82EF95) + ahead), size + more
    # An n-gram that reaches into the next text has a hash that mixes both, and recurs in neither.
    order = np.argsort(g, kind="stable")
    same = g[order[1:]] == g[order[:-1]]
    back = np.full(len(g), len(g) + 1)
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    ends = np.cumsum(counts)
    begins = ends - counts
    found = []
    reach = first
    while times * (reach // 2 + 1) <= counts.max() or reach == first:
        streak = max((shortest if reach == first else (times - 1) * (reach // 2 + 1)) - (n - 1), 1)
        on = np.concatenate([[False], back <= reach, [False]])
        turn = np.flatnonzero(on[1:] != on[:-1])
        a, b = turn[::2], turn[1::2]
        held = b - a >= streak
        a, b = a[held], b[held]
        # A streak may hold the ends of several texts.
        found += [(max(x - reach, 0), min(y + n - 1, len(g))) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        reach *= 2
    out: list[list[int]] = []
    for x, y in sorted(found):
        if out and x <= out[-1][1]:
            out[-1][1] = max(out[-1][1], y)
        else:
            out.append([x, y])
    cut = []
    for x, y in out:
        i = int(np.searchsorted(ends, x, "right"))
        while i < len(ends) and begins[i] < y:
            u, v = max(x, int(begins[i])), min(y, int(ends[i]))
            if v - u >= least:
                cut.append((u, v))
            i += 1
    return cut


def _collapsed(ws: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that stand in a run after its first period."""
    drop = np.zeros(len(ws) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return b" ".join([ws[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()])


def _found(batches, least: int, times: int):
    for batch in batches:
        data, offsets = W.bytes_of(batch.column(1))
        raw = data.tobytes()
        for a, b in W.chunks(offsets):
            part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            starts, ends, counts = W.split(part, off)
            at = np.cumsum(counts) - counts
            by: dict[int, list] = {}
            for x, y in windows(W.hashed(part, starts, ends), counts, least, times):
                i = int(np.searchsorted(at + counts, x, "right"))
                by.setdefault(i, []).append((x - int(at[i]), y - int(at[i])))
            rows = []
            for i in range(b - a):
                ws = raw[offsets[a + i] : offsets[a + i + 1]].split()
                runs = []
                for x, y in by.get(i, ()):
                    ids: dict[bytes, int] = {}
                    runs += [(x + s, n, q) for s, n, q in runs_of([ids.setdefault(w, len(ids)) for w in ws[x:y]], least, times)]
                kept = _collapsed(ws, runs) if runs else b" ".join(ws)
                rows.append((len(ws), [{"start": s, "length": n, "period": q} for s, n, q in runs], kept.decode()))
            n_words, runs, kept = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(n_words, pa.int64()), pa.array(runs, _RUN), pa.array(kept, pa.string())], schema=OUT)


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """A row per row of `df`: doc_id, n_words, its runs by start and period, and the text without the repeats (the words that
    stay, joined by one space)."""
    if times < 2 or least < times:
        raise ValueError("a run has two periods or more, and at least as many words")
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(partial(_found, least=least, times=times), RUNS)
