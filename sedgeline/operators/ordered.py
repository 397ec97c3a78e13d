"""Order within large groups: running sums and numbers without a task that holds a whole group.

Rows go to ranges of (group, order) by a range exchange and are written there; sums within a range are local, the ranges'
totals are a row for each group and range, and a row's result is the total of the ranges before its own plus what comes
before it in its range. A group of any size thus spreads over as many tasks as it has ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written


def running(df: DataFrame, group: list[str], order: list[str | Column], value: Column, name: str) -> DataFrame:
    """`df` with `name`: the sum of `value` (whole numbers, null is 0) over the rows of the same group that come before. Ties in
    `order` are in no certain order; null groups are a group."""
    keys = [F.col(c) for c in group]
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = df.withColumn("_value", F.coalesce(value.cast("long"), F.lit(0))).repartitionByRange(*keys, *order)
    placed = written(placed.withColumn("_range", F.spark_partition_id()), "ranges")
    upto = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = placed.withColumn("_here", F.coalesce(F.sum("_value").over(upto), F.lit(0)))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_range", *group).agg(F.sum("_value").alias("_total"))
    totals = totals.select(F.col("_range").alias("_of"), *[F.col(c).alias(f"_of_{c}") for c in group], F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    same = F.col("_range") == F.col("_of")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return here.join(totals, same).select(*df.columns, (F.col("_before") + F.col("_here")).alias(name))


def numbered(df: DataFrame, group: list[str], order: list[str | Column], name: str = "number", start: int = 0) -> DataFrame:
    """`df` with `name`: a row's place in its group, from `start` on."""
    return running(df, group, order, F.lit(1), name).withColumn(name, F.col(name) + start)
