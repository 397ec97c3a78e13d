"""Documents as a stream: new files are parsed, counted and converted in micro-batches, with what is there now as one run.

`trigger(availableNow=True)` takes a folder in chunks of so many files and ends; a plain trigger goes on. Counts are kept by
the engine between micro-batches; conversions, which need whole documents only, are done batch by batch.
"""

from __future__ import annotations

import signal
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.guards import STREAM_MB, should_stream
from ..operators import cdm, dtdl, rdf
from ..operators.rdf import Converted
from ..operators.shared import written
from ..plans.lens import OWL, RDF
from ..sources import cdm as cdm_source
from ..sources import dtdl as dtdl_source
from ..sources import rdf as rdf_source
from .progress import Cancelled, Progress, Token

CHUNK = 100
__all__ = ["Cancelled", "Progress", "Token", "cancel_on_interrupt", "converted", "counted", "documents", "folder_mb", "model_kinds", "pipeline", "rdf_kinds", "run", "streams"]


def documents(spark: SparkSession, folder: str, *, files: int = CHUNK) -> DataFrame:
    """A stream of whole documents (file, text, bytes)."""
    raw = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files).load(folder)
    return raw.select(F.col("path").alias("file"), rdf_source._decoded(F.col("content")).alias("text"), F.col("length").alias("bytes"))


def rdf_kinds(triples: DataFrame) -> DataFrame:
    """(kind, n): declared classes and properties."""
    kinds = [OWL + "Class", OWL + "DatatypeProperty", OWL + "ObjectProperty"]
    rows = triples.where((F.col("p") == RDF + "type") & F.col("o").isin(*kinds))
    return rows.groupBy(F.substring_index("o", "#", -1).alias("kind")).agg(F.count("*").alias("n"))


def model_kinds(docs: DataFrame) -> DataFrame:
    """(kind, n): interfaces and contents; only of a plain `@type`."""
    v = F.try_parse_json("text")
    items = F.coalesce(dtdl_source.list_of(v, "$"), dtdl_source.list_of(v, '$["@graph"]'), F.array(v))
    x = docs.where(v.isNotNull()).select(F.explode(items).alias("x")).where(dtdl_source.text_of(F.col("x"), '$["@type"]') == "Interface")
    kinds = F.concat(F.array(F.lit("Interface")), F.filter(F.coalesce(F.transform(dtdl_source.list_of(F.col("x"), "$.contents"), lambda c: dtdl_source.text_of(c, '$["@type"]')), F.array().cast("array<string>")), lambda k: k.isin("Property", "Telemetry", "Relationship", "Component", "Command")))
    return x.select(F.explode(kinds).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


def run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, *, token: Token | None = None, on_progress: Callable[[Progress], None] | None = None, fail_fast: bool = True) -> Progress:
    """All that is there now, micro-batch by micro-batch: `each(batch, id)`. A failed batch ends the run, or is a warning that
    names its first files. Rows, and bytes where the stream has them, are counted in each micro-batch."""
    p = Progress("running")

    def batch(df: DataFrame, k: int) -> None:
        if token is not None:
            token.check()
        began = time.time()
        size = F.coalesce(F.sum("bytes"), F.lit(0)) if "bytes" in df.columns else F.lit(0)
        n, size = df.agg(F.count("*"), size).first()
        try:
            each(df, k)
        except Exception as e:
            if fail_fast:
                raise
            files = [r[0] for r in df.select("file").sort("file").limit(3).collect()] if "file" in df.columns else []
            p.warnings.append(f"batch {k} ({', '.join(files)}): {e}")
        p.add(n, size, time.time() - began)
        if on_progress:
            on_progress(p)

    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        with p.listening(stream.sparkSession, query, rows=False):
            query.awaitTermination()
        p.state = "done"
    except Exception:
        p.state = "cancelled" if token is not None and token.cancelled else "failed"
        if p.state == "failed" and fail_fast:
            raise
    return p


def _chunks(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """What chunks have written to a folder; nothing if there was none."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def counted(spark: SparkSession, folder: str, checkpoint: str, out: str, *, kind: str = "rdf", files: int = CHUNK) -> DataFrame:
    """Counts by kind over all chunks: each micro-batch writes its own counts, and writes them
    over if it is run again; their sums are the merged result."""

    def each(df: DataFrame, k: int) -> None:
        rows = rdf_kinds(rdf_source.documents_to_triples(df)) if kind == "rdf" else model_kinds(df)
        rows.write.mode("overwrite").parquet(f"{out.rstrip('/')}/chunk={k}")

    run(documents(spark, folder, files=files), each, checkpoint)
    return _chunks(spark, out, "kind string, n long, chunk int").groupBy("kind").agg(F.sum("n").alias("n"))


def converted(spark: SparkSession, folder: str, checkpoint: str, out: str, *, kind: str = "rdf", files: int = CHUNK, **how) -> Converted:
    """The documents of a folder converted chunk by chunk. Each micro-batch writes its entities, properties, relationships and
    skipped items, over what an earlier try of it has left; the result reads all chunks."""
    names = ("entities", "properties", "relationships", "skipped")

    def each(df: DataFrame, k: int) -> None:
        if kind == "rdf":
            c = rdf.convert(written(rdf_source.graph(rdf_source.documents_to_triples(df)), "triples"), **how)
        else:
            source, operator = {"dtdl": (dtdl_source, dtdl), "cdm": (cdm_source, cdm)}[kind]
            c = operator.convert(source.parse(df), **how)
        for name in names:
            getattr(c, name).write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}/chunk={k}")

    run(documents(spark, folder, files=files), each, checkpoint)
    try:
        return Converted(*[spark.read.option("mergeSchema", "true").parquet(f"{out.rstrip('/')}/{name}").drop("chunk") for name in names])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    each(spark.createDataFrame([], "file string, text string"), 0)  # no document at all: the same tables, empty
    return Converted(*[spark.read.parquet(f"{out.rstrip('/')}/{name}").drop("chunk") for name in names])


def cancel_on_interrupt(token: Token) -> Callable[[], None]:
    """An interrupt (SIGINT) cancels the token instead of raising; what is returned puts the former handler back."""
    former = signal.signal(signal.SIGINT, lambda *_: token.cancel())
    return lambda: signal.signal(signal.SIGINT, former)


def folder_mb(spark: SparkSession, folder: str) -> float:
    """The size of a file or a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return (files.agg(F.sum("length")).first()[0] or 0) / (1 << 20)


def streams(spark: SparkSession, folder: str, threshold_mb: float = STREAM_MB) -> bool:
    return should_stream(folder_mb(spark, folder), threshold_mb)


def pipeline(read: Callable[[], DataFrame], steps: list[Callable[[DataFrame], DataFrame]], write: Callable[[DataFrame], None] | None = None, *, token: Token | None = None, keep: bool = False) -> DataFrame:
    """Reader, processors and writer as one plan; with `keep` each step's result is written to the shared folder."""
    df = read()
    for k, step in enumerate(steps):
        if token is not None:
            token.check()
        df = step(df)
        df = written(df, f"step-{k}") if keep else df
    if write is not None:
        write(df)
    return df
