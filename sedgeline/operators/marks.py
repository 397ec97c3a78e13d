"""Sets of a few names for each of many nodes, as bits of whole numbers.

A node's names are one row of fixed width, so that they are put together before the exchange, where the node's triples stand
side by side, and after it without an order; what comes out is one row for each set that occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: Names that are held as bits; a set of more names is a matter of joins.
MOST = 1024


def coded(names: DataFrame) -> DataFrame:
    """Few rows, numbered from 0 in `code`."""
    return names.withColumn("code", F.row_number().over(Window.orderBy(*names.columns)) - 1)


def words(code: Column, n: int) -> list[Column]:
    """The bit of a code below `n` in as many numbers as `n` needs; null has no bit."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(code, F.lit(64)).cast("int"))
    return [F.when(F.floor(code / 64) == i, bit).otherwise(F.lit(0).cast("long")) for i in range(-(-n // 64))]


def codes(marks: list[str]) -> Column:
    """The codes whose bits are set in the columns `marks`."""
    of = lambda i, c: F.transform(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.expr(f"`{c}`").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), b)) != 0), lambda b: b + 64 * i)
    return F.concat(*[of(i, c) for i, c in enumerate(marks)])


def counted(t: DataFrame, name: str, node: str, most: int = MOST) -> DataFrame:
    """(name, n, nodes): the rows of each name, and the distinct nodes among them; up to `most` names as bits of a node."""
    counts = written(t.groupBy(name).agg(F.count("*").alias("n")), "names")
    names = written(coded(counts.select(name).where(F.col(name).isNotNull())), "name-codes")
    k = names.count()
    if not 0 < k <= most or counts.where(F.col(name).isNull()).take(1):
        return t.groupBy(name).agg(F.count("*").alias("n"), F.countDistinct(node).alias("nodes"))
    cols = [f"m{i}" for i in range(-(-k // 64))]
    marked = t.select(F.col(name), F.col(node).alias("node")).where("node is not null").join(F.broadcast(names), name)
    sets = marked.groupBy("node").agg(*[F.bit_or(x).alias(c) for x, c in zip(words(F.col("code"), k), cols, strict=True)]).groupBy(*cols).agg(F.count("*").alias("nodes"))
    sums = sets.select(F.explode(codes(cols)).alias("code"), "nodes").groupBy("code").agg(F.sum("nodes").alias("nodes"))
    found = counts.join(F.broadcast(names), name).join(F.broadcast(sums), "code", "left")
    return found.select(name, "n", F.coalesce("nodes", F.lit(0).cast("long")).alias("nodes"))
