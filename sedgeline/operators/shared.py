"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """`df` as a Parquet table in `spark.checkpoint.dir` (a temporary folder where that is unset on one machine): its lineage
    ends there, a lost executor loses nothing, and later rounds read it instead of computing it again."""
    spark = df.sparkSession
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir names no folder that the executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="sedgeline-")
        spark.conf.set("spark.checkpoint.dir", shared)
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
