"""Exact top-k search by distributed histogram selection.

Vectors are quantised, `floor(scale * x)` for each component, and scored by the integer inner product. Every query is
scored against every row, in blocks: a task has a block of queries and a block of rows and counts, for each query, the
scores that fall into each cell of the query's current range. Summed over all blocks, a query's histogram tells the cell
that holds its kth value; that cell is the range of the next round, until a cell is one score wide or holds so few rows that
they need no telling apart. The first range is what the vectors' lengths allow. A last round keeps the scores from the
found value on, of a block no more than k a query (what is not among the first k of its block is not among the first k of
all), and orders them, ties by the smaller id.

Nothing of all rows is broadcast or gathered: a query's state is a row of a written table, a task holds one block of each
side, and the driver sees counts alone. A vector that a third of all rows share is spread over all blocks, and ties at the
kth value are settled by each block first.

Defined results: vectors that are null or hold null or non-finite components take no part; of two vectors of unlike length
the shorter one ends in zeros; an empty vector scores 0; a row is left out of its own list only, so that another row with
its id stands there; rows with a null id can be found, after all others of their score, and rows whose `is_query` is null
ask nothing; with fewer rows than k all are listed; an empty table gives no rows; other columns are ignored, whatever their
names. Scores that 64 bits might not hold are an error.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

SCALE, K = 64, 20
CELLS = 512
#: A cell with so many rows over k or less is not told apart further.
SLACK = 64
#: Queries of a block, components of a block of rows, and rows scored at a time.
QUERIES, COMPONENTS, STEP = 2048, 4 << 20, 1024
LAST = np.iinfo(np.int64).max


def quantised(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """row (a number of its own), vec_id, v, is_query, for the rows that take part."""
    xs = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    fine = F.forall("xs", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), xs.alias("xs"), F.coalesce(is_query, F.lit(False)).alias("is_query")).where(F.col("xs").isNotNull() & fine)
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.transform("xs", lambda x: F.floor(x * scale).cast("long")).alias("v"), "is_query")


def _matrix(column: pa.ChunkedArray, dim: int, kind: str) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim).astype(kind)
    out = np.zeros((len(sizes), dim), kind)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _scored(left: pa.Table, right: pa.Table, dim: int, kind: str):
    """Scores of all queries against a few rows at a time, with the pairs of a query and its own row."""
    q, own = _matrix(left["v"], dim, kind), left["row"].to_numpy()
    order = np.argsort(own)
    rows = right["row"].to_numpy()
    for a in range(0, right.num_rows, STEP):
        part = right.slice(a, STEP)
        at = order[np.minimum(np.searchsorted(own, rows[a : a + STEP], sorter=order), len(own) - 1)]
        same = np.flatnonzero(own[at] == rows[a : a + STEP])
        yield part, (q @ _matrix(part["v"], dim, kind).T), (at[same], same)


COUNTS = "row long, cell int, n long"
FOUND = "row long, query_id long, vec_id long, other long, score long"


def _cells(key, left: pa.Table, right: pa.Table, dim: int, kind: str, cells: int) -> pa.Table:
    """How many scores of each query are in each cell of its range."""
    n = np.zeros(left.num_rows * cells, np.int64)
    if left.num_rows and right.num_rows:
        low, step, wide = (left[c].to_numpy()[:, None] for c in ("low", "step", "wide"))
        for _, s, own in _scored(left, right, dim, kind):
            s = s.astype(np.int64)
            cell = np.where(s - low < wide, (s - low) // step, -1)
            cell[own] = -1
            i, j = np.nonzero((cell >= 0) & (cell < cells))
            n += np.bincount(i * cells + cell[i, j], minlength=len(n))
    hit = np.flatnonzero(n)
    return pa.table({"row": pa.array(left["row"].to_numpy()[hit // cells], pa.int64()), "cell": pa.array(hit % cells, pa.int32()), "n": pa.array(n[hit], pa.int64())})


def _first(i: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's first k, by score, id and row."""
    order = np.lexsort((row, ids, -score, i))
    i = i[order]
    at = np.arange(len(i))
    return order[at - np.searchsorted(i, i) < k]


def _kept(key, left: pa.Table, right: pa.Table, dim: int, kind: str, k: int) -> pa.Table:
    """Each query's first k of the block among the scores from its cut on."""
    held: list = [np.zeros(0, np.int64)] * 4
    if left.num_rows and right.num_rows:
        cut = left["low"].to_numpy()[:, None]
        for part, s, own in _scored(left, right, dim, kind):
            hit = s >= cut
            hit[own] = False
            i, j = np.nonzero(hit)
            new = (i, s[i, j].astype(np.int64), part["vec_id"].fill_null(LAST).to_numpy()[j], part["row"].to_numpy()[j])
            held = [np.concatenate(x) for x in zip(held, new, strict=True)]
            held = [x[at] for at in [_first(*held, k)] for x in held]
    i, score, ids, row = held
    take = lambda name: left[name].combine_chunks().take(pa.array(i))
    # A null id stands as the last number; only rows without one have no id of their own to be mistaken for it.
    nulls = np.isin(row, right["row"].to_numpy()[right["vec_id"].is_null().to_numpy()])
    cols = [take("row"), take("vec_id"), pa.array(ids, pa.int64(), mask=nulls), pa.array(row, pa.int64()), pa.array(score, pa.int64())]
    return pa.Table.from_arrays(cols, names=[x.split()[0] for x in FOUND.split(", ")])


def _narrowed(state: DataFrame, counts: DataFrame, k: int, cells: int, slack: int) -> DataFrame:
    """The state of the open queries after a round: the cell that holds the kth value, or all scores if there are fewer. Cells
    may reach beyond the range they divide; `wide` ends it, as scores from there on are in `above` already."""
    down = Window.partitionBy("row").orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = counts.groupBy("row", "cell").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(down))
    both = state.join(sums, "row").where("above + upto >= {k} AND above + upto - n < {k}".format(k=k))
    found = both.select("row", (F.col("low") + F.col("cell") * F.col("step")).alias("low"), "step", (F.col("above") + F.col("upto") - F.col("n")).alias("above"), F.col("n"))
    closed = (F.col("step") == 1) | (F.col("above") + F.col("n") <= k + slack)
    found = found.select("row", "low", F.when(closed, F.lit(0)).otherwise(F.expr(f"(step + {cells - 1}) div {cells}")).cast("long").alias("step"), "above", F.col("step").alias("wide"))
    return state.select("row", F.col("low").alias("least")).join(found, "row", "left").select("row", F.coalesce("low", "least").alias("low"), F.coalesce("step", F.lit(0)).cast("long").alias("step"), F.coalesce("above", F.lit(0)).cast("long").alias("above"), F.coalesce("wide", F.lit(0)).cast("long").alias("wide"))


def top_k(df: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", *, scale: int = SCALE, cells: int = CELLS, slack: int = SLACK, block: int = QUERIES, components: int = COMPONENTS) -> DataFrame:
    """Each query's k rows of the highest scores: query_id, rank (from 1), vec_id, score."""
    vecs = written(quantised(df, is_query, id_col, vec_col, scale), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, nq, dim, longest, largest = vecs.agg(
        F.count("*"), F.coalesce(F.sum(F.col("is_query").cast("long")), F.lit(0)), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(square), F.lit(0.0)), F.coalesce(F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))), F.lit(0.0))
    ).first()
    most = dim * largest * largest
    if most >= 2.0**62 or largest * scale >= 2.0**62:
        raise ValueError("the scores of these vectors may not fit in 64 bits")
    kind = "float32" if most < 2**24 else "float64" if most < 2**53 else "int64"
    qblocks, cblocks = -(-nq // block) or 1, -(-n * max(dim, 1) // components) or 1
    dealt = lambda blocks, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(blocks)).cast("int")
    each = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    queries = written(vecs.where("is_query").select("row", "vec_id", "v"), "query-vectors")
    asked = vecs.select("row", "vec_id", "v", dealt(cblocks, 2).alias("cblock"), each(qblocks).alias("qblock")).groupBy("qblock", "cblock")

    def met(state: DataFrame, run, schema: str) -> DataFrame:
        left = queries.join(state, "row").select("*", dealt(qblocks, 1).alias("qblock"), each(cblocks).alias("cblock")).groupBy("qblock", "cblock")
        return left.cogroup(asked).applyInArrow(lambda key, a, b: run(key, a, b), schema)

    # No score is beyond the product of the two lengths; 2 more for what doubles round.
    bound = F.ceil(F.sqrt(square) * F.lit(float(longest) ** 0.5) * (1 + 1e-9) + 2).cast("long")
    open_ = queries.select("row", (-bound).alias("low"), F.ceil((2 * bound + 1) / cells).cast("long").alias("step"), F.lit(0).cast("long").alias("above"), (2 * bound + 1).alias("wide"))
    open_ = written(open_, "top-k-state")
    done = []
    while True:
        state = written(_narrowed(open_, met(open_, partial(_cells, dim=dim, kind=kind, cells=cells), COUNTS), k, cells, slack), "top-k-state")
        discard(open_)
        done.append(state.where("step = 0"))
        open_ = state.where("step > 0")
        if not open_.take(1):
            break
        open_ = written(open_, "top-k-state")
    cuts = done[0]
    for more in done[1:]:
        cuts = cuts.union(more)
    found = met(cuts.select("row", "low"), partial(_kept, dim=dim, kind=kind, k=k), FOUND)
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "other")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
