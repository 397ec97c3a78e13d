"""What the corpus operators share: the shared folder, written intermediate tables and table readers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: `spark.checkpoint.dir`; where that is unset on one machine, as in tests, a temporary one."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir names no folder that the executors share")
        found = "file://" + tempfile.mkdtemp(prefix="sedgeline-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """`df`, written to the shared folder and read again: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `written` has made and nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shielded(df: DataFrame, *helpers: str) -> tuple[DataFrame, dict[str, str]]:
    """`df` with those of its columns renamed that have the name of one of an operator's helper columns, and the names they
    have now; the others keep theirs."""
    taken = {h.lower() for h in helpers}
    names, used = {}, {c.lower() for c in df.columns} | taken
    for c in df.columns:
        new = c
        while new.lower() in taken or new != c and new.lower() in used:
            new = f"own_{new}"
        names[c] = new
        used.add(new.lower())
    return df.select([F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
