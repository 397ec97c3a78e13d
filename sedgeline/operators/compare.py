"""Comparison, merging and round trips of ontologies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names, values
from ..plans.lens import OWL, RDF

KINDS = {"Class": "class", "DatatypeProperty": "data property", "ObjectProperty": "object property"}


def declared_names(t: DataFrame) -> DataFrame:
    """(kind, name): local names of declared classes and properties, blank ones included."""
    rows = t.where((F.col("p") == RDF + "type") & F.col("o").isin(*[OWL + k for k in KINDS]))
    return rows.select(names.local_name(F.col("o")).alias("kind"), names.local_name(F.col("s")).alias("name")).distinct()


def only_in_first(a: DataFrame, b: DataFrame) -> DataFrame:
    return declared_names(a).exceptAll(declared_names(b))


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """(kind, name, side) of what only one has."""
    one, two = declared_names(a).withColumn("in_a", F.lit(True)), declared_names(b).withColumn("in_b", F.lit(True))
    rows = one.join(two, ["kind", "name"], "full").where("in_a is null or in_b is null")
    return rows.select("kind", "name", F.when(F.col("in_a").isNotNull(), "first").otherwise("second").alias("side"))


def summary(a: DataFrame, b: DataFrame) -> DataFrame:
    """(kind, first, second, only_first, only_second, equal), a row for each kind, and `all`."""
    one, two = declared_names(a).withColumn("in_a", F.lit(1)), declared_names(b).withColumn("in_b", F.lit(1))
    kinds = a.sparkSession.createDataFrame([(k,) for k in KINDS], "kind string")
    rows = kinds.join(one.join(two, ["kind", "name"], "full"), "kind", "left").rollup("kind").agg(
        F.count("in_a").alias("first"), F.count("in_b").alias("second"), F.count_if(F.col("in_a").isNotNull() & F.col("in_b").isNull()).alias("only_first"), F.count_if(F.col("in_b").isNotNull() & F.col("in_a").isNull()).alias("only_second")
    )
    return rows.withColumn("kind", F.coalesce("kind", F.lit("all"))).withColumn("equal", (F.col("only_first") == 0) & (F.col("only_second") == 0))


def merged(results: list[DataFrame]) -> DataFrame:
    """Relations of several conversions as one."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), results)


def last_wins(chunks: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows of a key over several chunks, that of the last chunk."""
    other = [c for c in chunks.columns if c != key]
    return chunks.groupBy(key).agg(F.max_by(F.struct(*other), order).alias("x")).select(key, "x.*")


def conversion_summary(entities: DataFrame, relationships: DataFrame, skipped: DataFrame) -> DataFrame:
    """(file, entities, relationships, skipped, success_rate)."""
    count = lambda df, name: df.groupBy("file").agg(F.count("*").alias(name))
    rows = count(entities, "entities").join(count(relationships, "relationships"), "file", "full").join(count(skipped, "skipped"), "file", "full").fillna(0)
    return rows.withColumn("success_rate", values.success_rate(F.col("entities") + F.col("relationships"), F.col("skipped")))


def skipped_by_type(skipped: DataFrame) -> DataFrame:
    return skipped.groupBy("file", "item_type").agg(F.count("*").alias("n"))
