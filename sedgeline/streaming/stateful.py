"""Processors whose state outlives micro-batches and restarts, pipelines made of them, and their state read from outside.

A processor is a `StatefulProcessor` of the engine with typed state for each key; the engine keeps the state beside the
query's checkpoint. A pipeline is reader, processor and aggregator: the reader cuts a folder's documents into chunks of so
many items, which go through the processor as micro-batches, and the aggregator reads the state at the end, through the
engine's state source, so that a run that was stopped goes on where it was. Keys that hold very many items are split
into parts of their own state, which the aggregator puts together.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..plans.lens import OWL, RDF
from ..sources import dtdl as dtdl_source
from ..sources import rdf as rdf_source
from ..sources import split
from .control import breaker_step
from .progress import Cancelled, Progress, Token

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHUNK = 10_000
PARTS = 16


class Counter(StatefulProcessor):
    """How many items each key has had."""

    keys, var, state, out = ["key", "part"], "total", "n long", "key string, part int, n long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState(self.var, self.state)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timers: Any) -> Iterator[pd.DataFrame]:
        n = sum(len(f) for f in rows) + (self.total.get()[0] if self.total.exists() else 0)
        self.total.update((n,))
        yield pd.DataFrame([(*key, n)], columns=["key", "part", "n"])

    def close(self) -> None:
        pass


class Latest(StatefulProcessor):
    """Each key's item of the greatest order; of equal ones the greatest item."""

    keys, var, state, out = ["key"], "last", "ord long, item string", "key string, ord long, item string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState(self.var, self.state)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timers: Any) -> Iterator[pd.DataFrame]:
        best = tuple(self.last.get()) if self.last.exists() else None
        for f in rows:
            new = max(zip(f["ord"].tolist(), f["item"].tolist(), strict=True))
            best = new if best is None else max(best, new)
        self.last.update(best)
        yield pd.DataFrame([(*key, *best)], columns=["key", "ord", "item"])

    def close(self) -> None:
        pass


class Listed(StatefulProcessor):
    """All items of each key, with their order."""

    keys, var, state, out = ["key", "part"], "items", "ord long, item string", "key string, part int, n long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.items = handle.getListState(self.var, self.state)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timers: Any) -> Iterator[pd.DataFrame]:
        n = 0
        for f in rows:
            self.items.appendList(list(zip(f["ord"].tolist(), f["item"].tolist(), strict=True)))
            n += len(f)
        yield pd.DataFrame([(*key, n)], columns=["key", "part", "n"])

    def close(self) -> None:
        pass


class Breaker(StatefulProcessor):
    """A circuit breaker for each key: calls in order of time and number, and commands (reset, open) among them."""

    keys, var = ["key"], "breaker"
    state = "state string, fails long, oks long, opened long, calls long, good long, bad long, rejected long, changes long, last_bad long, last_good long"
    out = "key string, id long, state string, outcome string"

    def __init__(self, failures: int = 5, successes: int = 2, timeout: float = 60.0):
        self.how = {"failures": failures, "successes": successes, "timeout": timeout}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState(self.var, self.state)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timers: Any) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in self.state.split(", ")]
        s = dict(zip(names, self.kept.get(), strict=True)) if self.kept.exists() else dict.fromkeys(names, 0) | {"state": "closed", "last_bad": None, "last_good": None}
        out = []
        for r in pd.concat(list(rows)).sort_values(["us", "id"]).itertuples(index=False):
            before = s["state"]
            if r.command in ("reset", "open"):
                s |= {"state": "closed", "fails": 0, "oks": 0} if r.command == "reset" else {"state": "open", "opened": r.us}
                outcome = r.command
            else:
                core, outcome = breaker_step({k: s[k] for k in ("state", "fails", "oks", "opened")}, r.us, bool(r.bad), **self.how)
                s |= core
                called = outcome == "called"
                s["calls"] += called
                s["good"] += called and not r.bad
                s["bad"] += called and bool(r.bad)
                s["rejected"] += not called
                if called:
                    s["last_bad" if r.bad else "last_good"] = r.us
            s["changes"] += s["state"] != before
            out.append((*key, r.id, s["state"], outcome))
        self.kept.update(tuple(s[n] for n in names))
        yield pd.DataFrame(out, columns=["key", "id", "state", "outcome"])

    def close(self) -> None:
        pass


def with_state(stream: DataFrame, processor: StatefulProcessor) -> DataFrame:
    """The processor's rows; its keys are columns of the stream."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return stream.groupBy(*processor.keys).transformWithStateInPandas(statefulProcessor=processor, outputStructType=processor.out, outputMode="Append", timeMode="None")


def state_of(spark: SparkSession, checkpoint: str, processor: StatefulProcessor | type) -> DataFrame:
    """Keys and state of a query, as of its last finished micro-batch; without one the table is empty."""
    fields = ", ".join(dict.fromkeys(x for x in (*(f for f in processor.out.split(", ") if f.split()[0] in processor.keys), *processor.state.split(", "))))
    try:
        found = spark.read.format("statestore").option("stateVarName", processor.var).load(checkpoint)
    except AnalysisException:
        found = None
    except Exception as e:  # a checkpoint that no micro-batch has written to
        if "STDS" not in str(e) and "state" not in str(e).lower():
            raise
        found = None
    if found is None:
        return spark.createDataFrame([], fields)
    value = "list_element" if "list_element" in found.columns else "value"
    return found.select("key.*", f"{value}.*")


# ---- breakers by name

def breakers(calls: DataFrame, key: str, ts: str, tie: str, bad: str, *, command: str | None = None, failures: int = 5, successes: int = 2, timeout_seconds: float = 60.0) -> DataFrame:
    """A stream of calls, with commands in a column if there are any, as (key, id, state, outcome); the states stay with the query."""
    said = F.col(command).cast("string") if command else F.lit(None).cast("string")
    rows = calls.select(F.col(key).cast("string").alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us"), F.col(tie).cast("long").alias("id"), F.coalesce(F.col(bad), F.lit(False)).alias("bad"), said.alias("command"))
    return with_state(rows, Breaker(failures, successes, timeout_seconds))


def registry(spark: SparkSession, checkpoint: str, *, now: Column | None = None, timeout_seconds: float = 60.0) -> DataFrame:
    """All breakers of a running or ended query: name, state, counters, and the seconds for which an open one still rejects at
    `now`; one whose time is over is half open."""
    s = state_of(spark, checkpoint, Breaker)
    left = F.lit(0.0) if now is None else F.greatest(F.lit(0.0), timeout_seconds - (F.unix_micros(now.cast("timestamp")) - F.col("opened")) / 1e6)
    left = F.when(F.col("state") == "open", left).otherwise(0.0)
    state = F.col("state") if now is None else F.when((F.col("state") == "open") & (left <= 0), "half").otherwise(F.col("state"))
    rate = F.when(F.col("calls") == 0, 100.0).otherwise(100.0 * F.col("good") / F.col("calls"))
    return s.select(F.col("key").alias("name"), state.alias("state"), "calls", "good", "bad", "rejected", "changes", F.col("fails").alias("streak"), rate.alias("success_rate"), left.alias("seconds_left"), "last_bad", "last_good")


# ---- pipelines

@dataclass
class Result:
    """How a run ended, what it has done, and its data or where they are."""

    success: bool
    stats: Progress
    data: DataFrame | None = None
    output: str | None = None
    error: str | None = None


def _part(*by: str) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(PARTS)).cast("int").alias("part")


def triples_in_order(spark: SparkSession, path: str) -> DataFrame:
    t = rdf_source.read(spark, path)
    return t.select("file", F.to_json(F.struct("s", "p", "o")).alias("item"), F.when((F.col("p") == RDF + "type") & F.col("o").isin(*(OWL + k for k in ("Class", "DatatypeProperty", "ObjectProperty"))), F.substring_index("o", "#", -1)).alias("kind"), "fault")


def interfaces_in_order(spark: SparkSession, path: str) -> DataFrame:
    name = F.lower(F.col("_metadata.file_path"))
    e = split.array_elements(split.records(spark, path, "json", name.rlike(r"\.(json|dtdl)$")))
    v = F.try_parse_json("element")
    is_model = F.coalesce(dtdl_source.text_of(v, '$["@type"]') == "Interface", F.lit(False))
    return e.where(is_model | F.col("fault").isNotNull()).select("file", F.col("element").alias("item"), F.lit("Interface").alias("kind"), "fault")


READERS = {"rdf": triples_in_order, "ttl": triples_in_order, "turtle": triples_in_order, "dtdl": interfaces_in_order, "json": interfaces_in_order}
AGGREGATES = {"counts": Counter, "latest": Latest, "list": Listed}


class Pipeline:
    """Reader, processor with state, aggregator. `reader(spark, path)` gives (file, item, kind, fault); the processor counts
    kinds, keeps the last item of each file and kind, or lists all items of each file."""

    def __init__(self, reader: Callable[[SparkSession, str], DataFrame], aggregate: str = "list", *, chunk: int = CHUNK, files: int = 1, fail_fast: bool = True):
        self.reader, self.processor = reader, AGGREGATES[aggregate]()
        self.chunk, self.files, self.fail_fast = chunk, files, fail_fast

    def _chunks(self, spark: SparkSession, path: str, folder: str) -> DataFrame:
        """The items in order, in files of a chunk each; a run that goes on takes those of the run before."""
        place = spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
        if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            rows = self.reader(spark, path)
            order = ["file", "kind", "item"]
            rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("ord", F.monotonically_increasing_id())
            rows.write.option("maxRecordsPerFile", self.chunk).mode("overwrite").parquet(folder)
        schema = spark.read.parquet(folder).schema
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", self.files).parquet(folder)

    def _keyed(self, stream: DataFrame) -> DataFrame:
        fine = stream.where("fault is null and item is not null")
        if isinstance(self.processor, Counter):
            return fine.where("kind is not null").select(F.col("kind").alias("key"), _part("ord"))
        key = F.concat_ws("/", "file", "kind") if isinstance(self.processor, Latest) else F.col("file")
        return fine.select(key.alias("key"), _part("ord"), "ord", "item")

    def aggregated(self, spark: SparkSession, checkpoint: str) -> DataFrame:
        """What the state of a query says, without running it."""
        s = state_of(spark, checkpoint, self.processor)
        if isinstance(self.processor, Counter):
            return s.groupBy(F.col("key").alias("kind")).agg(F.sum("n").alias("n"))
        return s.select("key", "ord", "item")

    def execute(self, spark: SparkSession, path: str, checkpoint: str, output: str | None = None, *, token: Token | None = None, on_progress: Callable[[Progress], None] | None = None) -> Result:
        """Runs over all chunks that are left. A run that was stopped or has failed goes on where it was, with the same
        checkpoint. Without `fail_fast` items that cannot be read are warnings."""
        p = Progress("reading")
        try:
            chunks = self._chunks(spark, path, f"{checkpoint.rstrip('/')}/chunks")
            bad = spark.read.parquet(f"{checkpoint.rstrip('/')}/chunks").where("fault is not null").select(F.concat("file", F.lit(": "), "fault"))
            p.warnings += [r[0] for r in bad.limit(1000).collect()]
            if self.fail_fast and p.warnings:
                raise ValueError(p.warnings[0])
            p.state = "processing"

            def batch(df: DataFrame, k: int) -> None:
                if token is not None:
                    token.check()
                began = time.time()
                df.write.mode("overwrite").parquet(f"{checkpoint.rstrip('/')}/changes/batch={k}")
                p.add(0, 0, time.time() - began)
                if on_progress:
                    on_progress(p)

            query = with_state(self._keyed(chunks), self.processor).writeStream.foreachBatch(batch).option("checkpointLocation", f"{checkpoint.rstrip('/')}/query").trigger(availableNow=True).start()
            with p.listening(spark, query):
                query.awaitTermination()
            p.state = "aggregating"
            data = self.aggregated(spark, f"{checkpoint.rstrip('/')}/query")
            if output is not None:
                data.write.mode("overwrite").parquet(output)
            p.state = "done"
            return Result(True, p, None if output else data, output)
        except Exception as e:
            cancelled = isinstance(e, Cancelled) or token is not None and token.cancelled
            p.state = "cancelled" if cancelled else "failed"
            return Result(False, p, error="cancelled" if cancelled else str(e))


def pipeline_for(fmt: str, aggregate: str = "list", **how: Any) -> Pipeline:
    """The pipeline of a format by one of its names."""
    if fmt.lower() not in READERS:
        raise ValueError(f"no streaming pipeline for the format {fmt}")
    return Pipeline(READERS[fmt.lower()], aggregate, **how)
