"""The corpus pipeline: quality, repeated lines, near copies, benchmark leaks, packing.

Each stage takes the documents that the one before it has left, with the columns of `documents`, and its decisions take
effect in what it returns; the last returns pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedgeline.llm import decontam, lines, near, packing, quality
from sedgeline.llm.common import scratch, table


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the rule ensemble rejects (a score under 0.3)."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(model, F.col("text")) >= 0.3)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines out that match an earlier one; documents of which nothing is left go. `n_chars` follows the text."""
    out = lines.remove_lines(docs, drop_emptied=True)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least id of each group of near copies."""
    return near.keep_one(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold an item of the benchmark."""
    leaks = decontam.leaks(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_leak"), F.col("text_key").alias("_key")).distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["_leak"]) & (decontam.text_key(docs["text"]) == leaks["_key"]), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [("quality", by_quality), ("lines", without_repeated_lines), ("near copies", one_of_each), ("leaks", without_leaks), ("packing", packed)]
#: No SQL: the stages learn a model and tokenise.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, each on the Parquet that the one before it has written."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
