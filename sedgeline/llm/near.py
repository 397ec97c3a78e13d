"""Near copies by a MinHash LSH forest over five-word shingles, verified exactly (Jaccard of 0.8 or more).

A text's signature gives each tree of the forest a label, a sequence of minima. A tree's trie is kept as its sorted labels:
the texts below a node are a run of labels with a common prefix. A text is first matched by its whole label, then by
prefixes that are shortened a digit at a time: it goes up to the next shorter prefix as long as no other text there stands
for it (one that is almost equal by signature, a leader, goes up in its place), until the chance that a pair at the
threshold meets in some tree reaches the target recall (`depth`). At each node that a text comes to, it is compared by
signature with those that came there too, so that a node of near copies costs about one comparison each, and none emits all
its pairs. Nodes of very many texts are dealt out in salted parts first, whose leaders then meet. What is linked so far, a
candidate group, is verified exactly, all pairs of it, in blocks of chunks with one matrix product each; a block returns
sums per document and a spanning forest.

The bounds for signatures follow from the threshold by the triangle inequality of the Jaccard distance, with two standard
errors of an estimate from 128 minima to spare: a pair at the threshold of which both texts are stood for by others, thrice
over, is still linked in a tree in about 97 of 100 cases, and pairs mostly meet in several trees.

Equal texts are one class before all that, whatever their ids. Defined results: words are what white space separates, case
counts; a text of fewer than five words has one shingle of all its words; a null text is an empty text; texts without
words are linked to their equals only; a null id takes part and stays null; rows that share an id are texts of their own,
and where several groups would go by one id, all but one of them, like groups of null ids alone, go by a negative number
made from a text; of rows with equal ids and texts `keep_one` keeps any one; an empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import shielded, written
from .graph import components

U = np.uint64
N, THRESHOLD = 5, 0.8
TREES, LONGEST, RECALL = 16, 8, 0.998
#: Digits of a label beyond the shortest prefix that are kept, 16 bits each.
TAIL = 3
PART, CHUNK = 4096, 200
RNG = np.random.default_rng(20240229)
MULTIPLIERS = RNG.integers(0, 1 << 63, TREES * LONGEST, dtype=np.uint64) * U(2) + U(1)


def recall(similarity: float, depth: int, trees: int = TREES) -> float:
    """The chance that two texts share a prefix of that depth in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def depth(threshold: float = THRESHOLD, target: float = RECALL, trees: int = TREES, longest: int = LONGEST) -> int:
    """The longest prefix that reaches the target at the threshold."""
    d = longest
    while d > 1 and recall(threshold, d, trees) < target:
        d -= 1
    return d


def bounds(threshold: float = THRESHOLD) -> tuple[float, float]:
    """The signature similarities from which two texts are linked, and from which one stands for the other."""
    absorb = 1 - 0.15 * (1 - threshold)
    spread = math.sqrt(threshold * (1 - threshold) / (TREES * LONGEST))
    return max(threshold - 6 * (1 - absorb) - 2 * spread, 0.02), absorb


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of texts that lie end to end, and how many each has (repeats included)."""
    starts, ends, counts = W.split(data, offsets)
    h = W.hashed(data, starts, ends)
    firsts = np.cumsum(counts) - counts
    left = np.repeat(firsts + counts, counts) - np.arange(len(h))  # words from here to the text's end
    with np.errstate(over="ignore"):
        s = np.zeros(len(h), U)
        for k in range(n):
            nxt = np.zeros(len(h), U)
            if k < len(h):
                nxt[: len(h) - k] = h[k:]
            nxt[left <= k] = 0
            s = s * U(0xD1342543DE82EF95) + nxt
    s = W.mix(s)
    keep = left >= n
    keep[firsts[counts > 0]] = True
    return s[keep], np.where(counts > 0, np.maximum(counts - n + 1, 1), 0)


def _signatures(batches, prefix: int):
    """id, h1, h2, the trees' labels (a hash of the first `prefix` minima, then 16 bits of each of TAIL further ones), a byte of each minimum."""
    for b in batches:
        data, offsets = W.bytes_of(b.column(0))
        for x, y in W.chunks(offsets):
            s, counts = shingles(data[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x])
            some = counts > 0
            at = (np.cumsum(counts) - counts)[some]
            minima = np.zeros((TREES * LONGEST, len(counts)), U)
            labels = np.zeros((len(counts), TREES, 2), U)
            with np.errstate(over="ignore"):
                if len(at):
                    for k, m in enumerate(MULTIPLIERS):
                        minima[k, some] = np.minimum.reduceat(s * m, at)
                for t in range(TREES):
                    h = np.full(len(counts), U(t + 1))
                    for d in range(LONGEST):
                        digit = minima[t * LONGEST + d]
                        if d < prefix:
                            h = W.mix(h + digit)
                        elif d < prefix + TAIL:
                            labels[:, t, 1] = labels[:, t, 1] << U(16) | W.mix(digit) >> U(48)
                    labels[:, t, 0] = h
            low = np.ascontiguousarray((W.mix(minima) & U(255)).astype(np.uint8).T)
            yield pa.RecordBatch.from_arrays([*(c.slice(x, y - x) for c in b.columns[1:]), pa.array([k.tobytes() if z else None for k, z in zip(labels, some, strict=True)], pa.binary()), pa.array([k.tobytes() for k in low], pa.binary())], names=["id", "h1", "h2", "labels", "sig"])


def _label_rows(batches):
    for b in batches:
        reps, labels = b.column(0).to_numpy(), np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(labels[:, 0]), pa.array(labels[:, 1]), pa.array(np.repeat(reps, TREES))], names=["key", "tail", "rep"])


def _runs(batches, n_keys: int):
    """Rows that arrive sorted by the first columns, one list per key."""
    held, key = [], None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns[:n_keys]]
        change = np.zeros(b.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for x, y in zip(cuts, cuts[1:], strict=False):
            k = tuple(c[x] for c in cols)
            if k != key:
                if held:
                    yield key, pa.Table.from_batches(held)
                held, key = [], k
            held.append(b.slice(x, y - x))
    if held:
        yield key, pa.Table.from_batches(held)


def _climb(tails: np.ndarray, sig: np.ndarray, digits: int, link: float, absorb: float, thin: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Of the sorted labels below one node, `digits` longer than its prefix: the least member that each is connected with,
    and which are still leaders when all have come up to the node. Members that are all connected need no comparisons more,
    but where the leaders go on to a second round (`thin`), they are made as few as can be in the end."""
    free, root = np.ones(len(tails), bool), np.arange(len(tails))
    for level in range(digits, -1, -1):  # digits that must agree; shorter prefixes from round to round
        up = np.flatnonzero(free)
        node = tails[up] >> (16 * (digits - level))
        edges = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1], [True]]))
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            here = up[x:y]
            all_of = thin and level == 0
            rows, there = sig[here], np.ones(len(here), bool)
            for i in range(len(here)):
                if not all_of and (root[here] == root[here[0]]).all():
                    break
                if not there[i]:
                    continue
                est = np.count_nonzero(rows == rows[i], axis=1) / rows.shape[1]
                met = np.unique(root[here[est >= link]])
                if len(met) > 1:
                    root[np.isin(root, met)] = met[0]
                there &= est < absorb
                there[i] = True
            free[here[~there]] = False
    return root, free


def _led(batches, digits: int, link: float, absorb: float):
    """Within each (key, part): an edge from every member to the least member that leaders connect it with, and whether it
    leads; as many rows as members."""
    out = []
    for (key, _), t in _runs(batches, 2):
        reps, tails = t["rep"].to_numpy(), t["tail"].to_numpy()
        order = np.lexsort((reps, tails))
        reps = reps[order]
        sig = np.frombuffer(b"".join(t["sig"].combine_chunks().to_pylist()), np.uint8).reshape(len(reps), -1)[order]
        root, lead = _climb(tails[order], sig, digits, link, absorb, t["thin"][0].as_py())
        out.append((np.full(len(reps), key), tails[order], reps, reps[root], lead))
        if sum(len(x[0]) for x in out) > 50_000:
            yield _edges(out)
            out = []
    if out:
        yield _edges(out)


def _edges(out):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["key", "tail", "a", "b", "lead"])


def _verified(batches, threshold: float):
    """A block is the pairs within one chunk, or between two, of a candidate group: sums and a spanning forest."""
    for (_, i, j), t in _runs(batches, 3):
        side = t["side"].to_numpy()
        t = t.take(pa.array(np.argsort(side, kind="stable")))
        side, reps, copies = np.sort(side), t["rep"].to_numpy(), t["copies"].to_numpy()
        sets = [np.frombuffer(x, U) for x in t["shingles"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        first = int((side == 0).sum())
        uniq, inverse, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        col = np.where(seen > 1, np.cumsum(seen > 1) - 1, -1)[inverse]
        row = np.repeat(np.arange(len(sets)), sizes)
        width = int((seen > 1).sum())
        both = np.zeros((len(sets), len(sets)), np.float32)
        for x in range(0, width, 8192):  # in bands, so that the matrix stays small
            inside = (col >= x) & (col < x + 8192)
            m = np.zeros((len(sets), min(8192, width - x)), np.float32)
            m[row[inside], col[inside] - x] = 1
            both += m @ m.T
        linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-4
        np.fill_diagonal(linked, False)
        if i != j:
            linked[:first, :first] = False
            linked[first:, first:] = False
        weight = linked @ copies
        root = np.arange(len(sets))
        for x in range(len(sets)):  # label components of the block
            near = np.flatnonzero(linked[x, :x])
            if len(near):
                labels = np.unique(np.append(root[near], root[x]))
                root[np.isin(root, labels)] = labels[0]
        some = weight > 0
        yield pa.RecordBatch.from_arrays([pa.array(reps[some]), pa.array(reps[root[some]]), pa.array(weight[some].astype(np.int64))], names=["a", "b", "links"])


def _sets(batches):
    for b in batches:
        data, offsets = W.bytes_of(b.column(0))
        out = []
        for x, y in W.chunks(offsets):
            s, counts = shingles(data[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x])
            ends = np.cumsum(counts)
            out += [np.unique(s[e - c : e]).tobytes() for e, c in zip(ends, counts, strict=True)]
        yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(out, pa.binary())], names=[*b.schema.names[1:], "shingles"])


def _keys(df: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """text, id, and the two hashes by which equal texts are known."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [text.alias("text"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = THRESHOLD, target: float = RECALL) -> DataFrame:
    """A row per document: doc_id, class_id (least id of its group of near copies), copy_of (least id of equal texts) and
    n_links (documents at the threshold or above, copies included)."""
    made, found = _classes(df, id_col, text_col, threshold, target)
    return made.select("id", "h1", "h2").join(found, ["h1", "h2"]).select(F.col("id").alias("doc_id"), "class_id", "copy_of", "n_links")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = THRESHOLD, target: float = RECALL) -> DataFrame:
    """`df` with the document of the least id of each group of near copies, all its columns as they are. A text that shares
    its id with another text comes after those that do not."""
    columns = df.columns
    df, names = shielded(df, "_h1", "_h2", "_id", "_none")
    id_col, text_col = names[id_col], names[text_col]
    _, found = _classes(df, id_col, text_col, threshold, target)
    heads = found.where("copy_of = class_id").select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.coalesce("least", F.lit(0)).alias("_id"), F.col("least").isNull().alias("_none"))
    _, id_, h1, h2 = _keys(df, id_col, text_col)
    rows = df.withColumns({"_h1": h1, "_h2": h2, "_id": F.coalesce(id_, F.lit(0)), "_none": id_.isNull()})
    keys = ["_h1", "_h2", "_id", "_none"]
    return rows.join(heads, keys, "left_semi").dropDuplicates(keys).select([F.col(f"`{n}`").alias(c) for c, n in zip(columns, names.values(), strict=True)])


def _classes(df: DataFrame, id_col: str, text_col: str, threshold: float, target: float) -> tuple[DataFrame, DataFrame]:
    """The documents with the hashes of their texts, and of each text: h1, h2, least (id), copy_of, class_id, n_links."""
    docs = df.select(*_keys(df, id_col, text_col))
    least = depth(threshold, target)
    made = written(docs.mapInArrow(partial(_signatures, prefix=least), "id long, h1 long, h2 long, labels binary, sig binary"), "near-signatures")
    # A class of equal texts; the aggregate is partial, so that copies are not gathered. Numbers are given as the table is written.
    reps = made.groupBy("h1", "h2").agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.max("labels").alias("labels"), F.max("sig").alias("sig"))
    reps = written(reps.withColumn("rep", F.monotonically_increasing_id()), "near-classes")
    rows = reps.where("labels is not null").select("rep", "labels").mapInArrow(_label_rows, "key long, tail long, rep long")
    shared = rows.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    rows = rows.join(shared, "key").join(reps.select("rep", "sig"), "rep")
    rows = rows.select("key", F.pmod(F.xxhash64("rep"), F.ceil(F.col("m") / PART)).cast("long").alias("part"), "rep", "tail", "sig", (F.col("m") > PART).alias("thin"))
    link, absorb = bounds(threshold)
    climb = partial(_led, digits=min(LONGEST - least, TAIL), link=link, absorb=absorb)
    lead = "key long, tail long, a long, b long, lead boolean"
    one = written(rows.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(climb, lead), "near-edges")
    # The leaders of a node that was dealt out meet in a second round.
    heads = one.where("lead").join(shared.where(F.col("m") > PART), "key").select("key", F.lit(0).cast("long").alias("part"), F.col("a").alias("rep"), "tail", F.lit(False).alias("thin"))
    two = heads.join(reps.select("rep", "sig"), "rep").select("key", "part", "rep", "tail", "sig", "thin").repartition("key").sortWithinPartitions("key", "part").mapInArrow(climb, lead)
    groups = written(components(one.union(two).select("a", "b")), "near-groups")
    # Candidate groups in chunks, and every pair of chunks of a group as a block.
    size = groups.groupBy("root").agg(F.ceil(F.count("*") / CHUNK).alias("parts"))
    members = groups.join(size, "root").select(F.col("node").alias("rep"), "root", "parts", F.pmod(F.xxhash64("node"), F.col("parts")).cast("long").alias("own"))
    # One document of each class, the least, has the text; those without an id or with one that is shared may be several.
    members = members.join(reps.select("rep", "copies", "h1", "h2", F.coalesce("least", F.lit(0)).alias("id")), "rep")
    texts = docs.select("text", F.coalesce("id", F.lit(0)).alias("id"), "h1", "h2")
    sets = texts.join(members, ["id", "h1", "h2"]).dropDuplicates(["rep"]).select("text", "rep", "root", "parts", "own", "copies").mapInArrow(_sets, "rep long, root long, parts long, own long, copies long, shingles binary")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    blocks = sets.select("*", other.alias("other")).select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "rep", "copies", "shingles")
    checked = blocks.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(partial(_verified, threshold=threshold), "a long, b long, links long")
    checked = written(checked, "near-links")
    links = checked.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("others"))
    roots = components(checked.select("a", "b")).withColumnRenamed("node", "rep")
    # The number that a text goes by: its least id, if no other text goes by that one.
    other_number = -(F.col("h1").bitwiseAND((1 << 62) - 1)) - 2
    owners = reps.where("least is not null").groupBy("least").agg(F.min(F.struct("h1", "h2")).alias("owner"), F.count("*").alias("n")).where("n > 1").drop("n")
    named = reps.select("rep", "copies", "h1", "h2", "least").join(owners, "least", "left")
    owned = F.col("least").isNotNull() & (F.col("owner").isNull() | (F.col("owner") == F.struct("h1", "h2")))
    found = named.withColumn("other", ~owned).withColumn("copy_of", F.when(owned, F.col("least")).otherwise(other_number)).join(links, "rep", "left").join(roots, "rep", "left")
    found = written(found.select("h1", "h2", "least", "other", "copy_of", F.coalesce("root", "rep").alias("root"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "near-found")
    names = found.groupBy("root").agg(F.min(F.struct("other", "copy_of")).alias("class"))
    return made, found.join(names, "root").select("h1", "h2", "least", "copy_of", F.col("class.copy_of").alias("class_id"), "n_links")
