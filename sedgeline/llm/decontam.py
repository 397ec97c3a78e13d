"""Benchmark decontamination by template canonicalisation.

Words are lowered and stripped of punctuation; numbers, names and units become typed placeholders, so that a question
asked again with other values keeps its template. Windows of eight template words of the benchmark and of the documents
meet in a hash join; the windows of a document that lie on one diagonal with an item, a lane, must be consistent: a value
of the item stands for the value that the document has at more than half of its places in the lane, and a window counts if
its slots all do as that says, or if they all have the item's own values. A document holds an item if windows that count
cover at least half of the item. Windows are also met by their plain words, lowered and without placeholders, so that a
copy counts whatever its slots, case and lines; windows of more than half slots are met by those only.

A document's windows are looked up in a bitmap of the benchmark's hashes first, which is 8 MB whatever the benchmark's
size, so that only windows that can join leave the task that reads the text.

Defined results: null texts are empty; items without words match nothing, items of one to four words, whose templates would
be anyone's, match by all their plain words, items of five to seven words match by one window of all their words; windows with fewer than half literal words are evidence with the same words only; repeated documents each get
their rows, once for each id and text; rows with a null id come out with a null id; repeated items count once; empty tables give
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import written

U = np.uint64
WINDOW, TEMPLATES, COVERAGE = 8, 5, 0.5
BITS = 26

# The unit words that a number may carry.
UNITS = """
mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs pound pounds oz ounce ounces
ml cl l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks
month months year years hz khz mhz ghz w kw mw v a ma kb mb gb tb kmh mph percent dollar dollars cent cents euro euros
degree degrees celsius fahrenheit joule joules newton newtons meter meters metre metres kilometer kilometers gram grams
kilogram kilograms
""".split()

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[b for b in range(33, 128) if not chr(b).isalnum()]] = True
_BARE = np.where(_PUNCT, U(0), W._MAP)
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?:;"]] = True
NUMBER, NAME, UNIT = (U(k) for k in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer("".join(UNITS).encode(), np.uint8)
    ends = np.cumsum([len(u) for u in UNITS])
    return np.sort(W.hashed(data, ends - [len(u) for u in UNITS], ends, _BARE))


_UNIT_HASHES = _unit_hashes()


def _within(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    run = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=run[1:])
    return run[ends] - run[starts]


def canonical(lower: np.ndarray, low_off: np.ndarray, data: np.ndarray, offsets: np.ndarray):
    """Of texts that lie end to end (lowered, and as they are): per word the template hash, the value hash, and whether it
    is a slot; and the words of each text. Words of punctuation alone are left out."""
    starts, ends, counts = W.split(lower, low_off)
    # `data` is split alike: lowering changes no white space.
    s0, e0, _ = W.split(data, offsets)
    solid = ~_PUNCT[lower]
    nxt = np.where(solid, np.arange(len(lower)), len(lower))
    nxt = np.minimum.accumulate(nxt[::-1])[::-1] if len(nxt) else nxt
    core = nxt[starts] if len(starts) else starts
    text = np.repeat(np.arange(len(counts)), counts)
    first = np.zeros(len(starts), bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    if len(starts):
        capital = ((data >= 65) & (data <= 90)) | np.append(False, (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E))
        small = ((data >= 97) & (data <= 122)) | np.append(False, (data[:-1] == 0xC3) & (data[1:] >= 0x9F))
        up, down = _within(capital, s0, e0), _within(small, s0, e0)
        head = np.minimum(s0 + 1, len(data) - 1)
        initial = capital[s0] | ((data[s0] == 0xC3) & capital[head])
        after = first.copy()
        after[1:] |= _ENDS[data[e0[:-1] - 1]]
        after[1:] |= _within(data == 10, e0[:-1], s0[1:]) > 0
        named = initial & (up == 1) & (down > 0) & ~after
        digits = _within(_DIGIT[lower], starts, ends)
        number = (digits > 0) & (_within(solid, starts, ends) == digits)
        value = W.hashed(lower, np.minimum(core, ends), ends, _BARE)
    else:
        named = number = np.zeros(0, bool)
        value = np.zeros(0, U)
    keep = core < ends
    named, number, value, text = named[keep], number[keep], value[keep], text[keep]
    same = np.zeros(len(text), bool)
    same[1:] = text[1:] == text[:-1]
    unit = np.zeros(len(text), bool)
    if len(text):
        at = np.minimum(np.searchsorted(_UNIT_HASHES, value), len(_UNIT_HASHES) - 1)
        unit[1:] = number[:-1]
        unit &= same & (_UNIT_HASHES[at] == value)
    template = np.where(number, NUMBER, np.where(unit, UNIT, np.where(named, NAME, value)))
    return template, value, number | unit | named, np.bincount(text, minlength=len(counts))


def _windows(template: np.ndarray, value: np.ndarray, slot: np.ndarray, counts: np.ndarray, n: int):
    """Start words, hashes, texts of the windows of n words inside one text, whether they are plain, and dense. Those with
    enough literal words have a hash of their templates, those with slots one of their plain words too (without slots, both
    are the same); dense ones have more than half slots, and plain words only. Windows of a few words are plain ones all."""
    text = np.repeat(np.arange(len(counts)), counts)
    m = max(len(template) - n + 1, 0)

    def hashes(words: np.ndarray, at: np.ndarray) -> np.ndarray:
        h = np.full(m, U(n))
        with np.errstate(over="ignore"):
            for k in range(n):
                h = h * U(0xD1342543DE82EF95) + words[k : k + m]
        return W.mix(h[at])

    run = np.concatenate([[0], np.cumsum(slot)])
    k = run[n:][:m] - run[:m]
    inside = text[:m] == text[n - 1 :][:m]
    if n < TEMPLATES:
        at = np.flatnonzero(inside)
        return at, hashes(value, at), text[at], np.ones(len(at), bool), np.zeros(len(at), bool)
    few, some = np.flatnonzero(inside & (2 * k <= n)), np.flatnonzero(inside & (k > 0))
    at = np.concatenate([few, some])
    return at, np.concatenate([hashes(template, few), hashes(value, some)]), text[at], np.arange(len(at)) >= len(few), 2 * k[at] > n


def _emit(batches, sizes: list[int], bitmap: np.ndarray | None, whole: bool):
    """(id, key, hash, pos, values, places, n, dense) of windows: of items all, of documents those in the bitmap. Plain windows
    have no values. The places of the values in the window are given for items only, a document's window that meets one has the same. Short items give one window."""
    for b in batches:
        column = b.column(1).cast(pa.large_string()).fill_null("")
        data, offsets = W.bytes_of(column)
        lower, low_off = W.bytes_of(pc.utf8_lower(column))
        for x, y in W.chunks(offsets):
            template, value, slot, counts = canonical(lower[low_off[x] : low_off[y]], low_off[x : y + 1] - low_off[x], data[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x])
            firsts = np.cumsum(counts) - counts
            for n in sizes:
                at, h, text, plain, dense = _windows(template, value, slot, counts, n)
                if whole:
                    fit = counts[text] == n if n < WINDOW else np.ones(len(at), bool)
                else:
                    cell = h >> U(64 - BITS)
                    fit = (bitmap[cell >> U(3)] >> (cell & U(7)).astype(np.uint8)) & 1 > 0
                    if n < TEMPLATES:  # once a text is enough, as such a window is all of its item
                        fit = np.flatnonzero(fit)
                        fit = fit[np.unique(np.stack([text[fit].astype(U), h[fit]]), axis=1, return_index=True)[1]]
                at, h, text, plain, dense = at[fit], h[fit], text[fit], plain[fit], dense[fit]
                places = [[] if z else np.flatnonzero(slot[a : a + n]).tolist() for a, z in zip(at, plain, strict=True)] if whole else [None] * len(at)
                slots = [[] if z else value[a : a + n][slot[a : a + n]].view(np.int64).tolist() for a, z in zip(at, plain, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(x, y - x).take(pa.array(text)), b.column(2).slice(x, y - x).take(pa.array(text)), pa.array(h.view(np.int64)), pa.array(at - firsts[text], pa.int64()), pa.array(slots, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32())), pa.array(np.full(len(at), n), pa.int32()), pa.array(dense)], names=["id", "key", "hash", "pos", "values", "places", "n", "dense"])


ROWS = "id long, key long, hash long, pos long, values array<long>, places array<int>, n int, dense boolean"
JUDGED = "doc_id long, text_key long, item_id long, at array<long>, dense array<long>, slots long, reparameterised boolean"


def _judged(batches):
    """Of each lane: the item's windows that count, dense ones apart, their distinct pairs of values, and whether any pair is unequal."""
    for b in batches:
        out = []
        for r in b.to_pylist():
            pairs = {(w["ipos"] + k, i, d) for w in r["met"] for k, i, d in zip(w["places"], w["iv"], w["dv"], strict=True)}
            votes, total = Counter(p[1:] for p in pairs), Counter(i for _, i, _ in pairs)
            at, used, dense = set(), set(), {w["ipos"] for w in r["met"] if w["dense"]}
            for w in r["met"]:
                own = set(zip(w["iv"], w["dv"], strict=True))
                if w["iv"] == w["dv"] or all(2 * votes[p] > total[p[0]] for p in own):
                    at.add(w["ipos"])
                    used |= own
            if at:
                out.append({"doc_id": r["doc_id"], "text_key": r["text_key"], "item_id": r["item_id"], "at": sorted(at - dense), "dense": sorted(at & dense), "slots": len(used), "reparameterised": any(i != d for i, d in used)})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("item_id", pa.int64()), ("at", pa.list_(pa.int64())), ("dense", pa.list_(pa.int64())), ("slots", pa.int64()), ("reparameterised", pa.bool_())]))


def text_key(text: Column) -> Column:
    """What tells the texts of rows that share an id, or have none, apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", *, coverage: float = COVERAGE) -> DataFrame:
    """A row per document and item that it holds: doc_id, item_id, windows (those of the item that count), item_windows,
    coverage, slots (distinct), reparameterised (some slot has another value)."""
    return leaks(docs, benchmark, id_col, text_col, item_col, item_text, coverage=coverage).drop("text_key")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", *, coverage: float = COVERAGE) -> DataFrame:
    """The same with `text_key` of the document's text, which belongs to the key where ids are null or repeated."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text).alias("text")).where("id is not null").dropDuplicates()
    sizes = list(range(1, WINDOW + 1))
    known = written(items.select("id", "text", F.lit(0).cast("long").alias("key")).mapInArrow(partial(_emit, sizes=sizes, bitmap=None, whole=True), ROWS), "leak-items")
    # The bitmap as words of 64 bits that have any bit, at most 2**BITS / 64 of them.
    top = F.shiftrightunsigned("hash", 64 - BITS)
    cells = known.select(F.shiftright(top, 6).alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITS}) & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    bitmap = np.zeros(1 << (BITS - 6), np.int64)
    bitmap[cells["w"].to_numpy(np.int64)] = cells["b"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(bitmap.view(np.uint8))
    used = sorted(r.n for r in known.select("n").distinct().collect()) or [WINDOW]

    def run(batches):
        yield from _emit(batches, used, shared.value, False)

    found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("key")).mapInArrow(run, ROWS)
    met = found.select(F.col("id").alias("doc_id"), F.col("key").alias("text_key"), "hash", "pos", F.col("values").alias("dv")).join(known.select("hash", F.col("id").alias("item_id"), F.col("pos").alias("ipos"), F.col("values").alias("iv"), "places", "dense"), "hash")
    lanes = met.groupBy("doc_id", "text_key", "item_id", (F.col("pos") - F.col("ipos")).alias("lane")).agg(F.collect_set(F.struct("ipos", "places", "iv", "dv", "dense")).alias("met"))
    lanes = lanes.mapInArrow(_judged, JUDGED)
    n = lambda c: F.size(F.array_distinct(F.flatten(F.collect_set(c)))).cast("long")
    whole = lanes.groupBy("doc_id", "text_key", "item_id").agg(n("at").alias("at"), n("dense").alias("dense"), F.max("slots").alias("slots"), F.max("reparameterised").alias("reparameterised"))
    size = known.groupBy(F.col("id").alias("item_id")).agg(F.countDistinct(F.when(~F.col("dense"), F.col("pos"))).alias("of_at"), F.countDistinct("pos").alias("of_all"))
    # Other values can only be seen outside dense windows, so those do not count against an item without them.
    ways = [F.struct(F.try_divide(F.col("at") + F.col("dense"), F.col("of_all")).alias("c"), (F.col("at") + F.col("dense")).alias("w"), F.col("of_all").alias("of")), F.struct(F.try_divide("at", "of_at").alias("c"), F.col("at").alias("w"), F.col("of_at").alias("of"))]
    out = whole.join(size, "item_id").withColumn("x", F.greatest(*ways)).where(F.col("x.c") >= coverage)
    return out.select("doc_id", "text_key", "item_id", F.col("x.w").alias("windows"), F.col("x.of").alias("item_windows"), F.col("x.c").alias("coverage"), "slots", "reparameterised")
