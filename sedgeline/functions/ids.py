"""Identifiers: hashes, sequences and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import ordered

PREFIX = 1_000_000_000_000


def hash_id(dtmi: Column, prefix: int = PREFIX) -> Column:
    """`prefix` plus the first 64 bits of the SHA-256 of the identifier (no scheme, no version) modulo 10**12, as text."""
    bare = F.regexp_replace(F.substring_index(dtmi, ";", 1), "^dtmi:", "")
    high = F.conv(F.substring(F.sha2(bare, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (high % 1_000_000_000_000 + prefix).cast("decimal(20,0)").cast("string")


def member_id(owner: Column, name: Column) -> Column:
    """The owner's id and four digits of the MD5 of the member's name."""
    low = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long") % 10000
    return F.concat(owner, F.lpad(low.cast("string"), 4, "0"))


def numbered(df: DataFrame, *order: str, partition: tuple[str, ...] = (), prefix: int = PREFIX, first: int = 1, name: str = "id") -> DataFrame:
    """Ids in the given order from `prefix + first`, one sequence for each `partition` (a document), by ranges of the order: a
    document of any size is numbered by many tasks."""
    found = ordered.numbered(df, list(partition), list(order), "_place", prefix + first)
    return found.withColumn(name, F.col("_place").cast("string")).drop("_place")


def reserve(df: DataFrame, sizes: str, *order: str, partition: tuple[str, ...] = (), prefix: int = PREFIX) -> DataFrame:
    """Ranges of ids: `range_start` for each row that asks for `sizes` ids."""
    found = ordered.running(df, list(partition), list(order), F.col(sizes), "range_start")
    return found.withColumn("range_start", F.col("range_start") + prefix)


def id_statistics(df: DataFrame, namespace: str, prefix: int = PREFIX) -> DataFrame:
    """Ids generated in each namespace."""
    return df.groupBy(namespace).agg(F.count("*").alias("generated"))


def is_id(x: Column) -> Column:
    """Thirteen digits."""
    return F.coalesce(x.rlike("^[0-9]{13}$"), F.lit(False))
