"""Control over time: token buckets, circuit breakers, sliding limits, as ordered folds per key.

A fold needs its key's events in order, one after the other: a key's task streams through its sorted rows and holds one
state, so that a key with very many events costs time but no memory. On a stream the same steps run per key with state kept
between micro-batches.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import retry_wait

__all__ = ["admission", "admission_statistics", "admission_step", "bucket_step", "breaker_step", "breaker_metrics", "circuit_breaker", "fold", "retry_wait", "sliding_load", "sliding_limit", "token_bucket", "unlimited"]


def bucket_step(state: dict | None, us: int, *, rate: float, per: float, burst: float) -> tuple[dict, bool]:
    """Refill by the time that went by, at most to `burst`; take one token if there is one. A new bucket is full."""
    tokens = burst if state is None else min(burst, state["tokens"] + (us - state["us"]) * rate / (per * 1e6))
    ok = tokens >= 1
    return {"tokens": tokens - 1 if ok else tokens, "us": us}, ok


def breaker_step(state: dict | None, us: int, bad: bool, *, failures: int, successes: int, timeout: float) -> tuple[dict, str]:
    """closed opens after `failures` in a row; open rejects until `timeout`, then is half open; half open closes after
    `successes` and opens at one failure."""
    s = dict(state or {"state": "closed", "fails": 0, "oks": 0, "opened": 0})
    if s["state"] == "open":
        if us - s["opened"] < timeout * 1e6:
            return s, "rejected"
        s |= {"state": "half", "oks": 0}
    if bad:
        s["fails"] += 1
        if s["state"] == "half" or s["fails"] >= failures:
            s |= {"state": "open", "opened": us, "oks": 0, "fails": 0 if s["state"] == "half" else s["fails"]}
        return s, "called"
    if s["state"] == "half":
        s["oks"] += 1
        s["fails"] = 0
        if s["oks"] >= successes:
            s |= {"state": "closed", "oks": 0}
        return s, "called"
    s["fails"] = 0
    return s, "called"


def fold(df: DataFrame, key: str, ts: str, tie: str, more: list[str], ddl: str, step: Callable) -> DataFrame:
    """`step(state, us, *more)` over each key's rows in order of (ts, tie): rows (key, tie, *result). Sorted partitions are
    streamed; the state is that of the key at hand. Of a stream, the rows of each micro-batch are in that order, and the
    state is kept as JSON from one micro-batch to the next."""
    rows = df.select(F.col(key).alias("k"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us"), F.col(tie).alias("tie"), *more)
    out = [x.split()[0] for x in ddl.split(", ")]
    kind = dict(df.dtypes)
    ddl = f"k {kind[key]}, tie {kind[tie]}, {ddl}"

    def run(frames):
        state, last, first = None, None, True
        for f in frames:
            res = []
            for row in f.itertuples(index=False):
                k = None if pd.isna(row[0]) else row[0]
                if first or k != last:
                    state, last, first = None, k, False
                state, r = step(state, int(row[1]), *row[3:])
                res.append((k, row[2], *r))
            yield pd.DataFrame(res, columns=["k", "tie", *out])

    def keep(keys, frames, kept):
        state, res = json.loads(kept.get[0]) if kept.exists else None, []
        for row in pd.concat(list(frames)).sort_values(["us", "tie"]).itertuples(index=False):
            state, r = step(state, int(row[1]), *row[3:])
            res.append((keys[0], row[2], *r))
        kept.update((json.dumps(state),))
        yield pd.DataFrame(res, columns=["k", "tie", *out])

    if df.isStreaming:
        made = rows.groupBy("k").applyInPandasWithState(keep, ddl, "state string", "append", "NoTimeout")
    else:
        made = rows.repartition("k").sortWithinPartitions("k", "us", "tie").mapInPandas(run, ddl)
    return made.withColumnRenamed("k", key).withColumnRenamed("tie", tie)


def token_bucket(df: DataFrame, key: str, ts: str, tie: str, *, rate: float, per_seconds: float, burst: float) -> DataFrame:
    """(key, tie, admitted, tokens)"""

    def step(state, us):
        s, ok = bucket_step(state, us, rate=rate, per=per_seconds, burst=burst)
        return s, (ok, s["tokens"])

    return fold(df, key, ts, tie, [], "admitted boolean, tokens double", step)


def unlimited(df: DataFrame, key: str, tie: str) -> DataFrame:
    """The limiter that admits all."""
    return df.select(key, tie, F.lit(True).alias("admitted"))


def circuit_breaker(df: DataFrame, key: str, ts: str, tie: str, bad: str, *, failures: int, successes: int, timeout_seconds: float) -> DataFrame:
    """(key, tie, state after the call, outcome)"""

    def step(state, us, b):
        s, outcome = breaker_step(state, us, bool(b), failures=failures, successes=successes, timeout=timeout_seconds)
        return s, (s["state"], outcome)

    return fold(df, key, ts, tie, [bad], "state string, outcome string", step)


def breaker_metrics(calls: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """(key, calls, rejected), and with the column `order` of calls in time also last_state."""
    last = [F.max_by("state", order).alias("last_state")] if order else []
    return calls.groupBy(key).agg(F.count("*").alias("calls"), F.count_if(F.col("outcome") == "rejected").alias("rejected"), *last)


def sliding_load(df: DataFrame, key: str, ts: str, *, seconds: int = 60) -> DataFrame:
    """`offered`: the requests of a key within so many seconds up to each row."""
    w = Window.partitionBy(key).orderBy(F.col(ts).cast("timestamp").cast("double")).rangeBetween(-seconds, 0)
    return df.withColumn("offered", F.count("*").over(w))


def sliding_limit(df: DataFrame, key: str, ts: str, tie: str, *, most: int = 30, seconds: float = 60.0) -> DataFrame:
    """(key, tie, admitted): at most so many admitted requests in any window of so many seconds."""

    def step(state, us):
        kept = [x for x in (state or []) if x > us - seconds * 1e6]
        ok = len(kept) < most
        return (kept + [us] if ok else kept), (ok,)

    return fold(df, key, ts, tie, [], "admitted boolean", step)


def admission_step(state: list | None, us: int, size_mb: float, memory: float, took_us: int, *, most: int, seconds: float, most_mb: float, most_memory: float, most_open: int) -> tuple[list, str | None]:
    """The first limit that a request meets, or none: admitted requests within the time before, content size, memory in use, and
    admitted requests that have not ended. State: starts within that time, and ends to come; both are bounded by the limits."""
    starts, ends = state or ([], [])
    starts = [x for x in starts if x > us - seconds * 1e6]
    ends = [x for x in ends if x > us]
    if len(starts) >= most:
        why = "rate"
    elif size_mb > most_mb:
        why = "size"
    elif memory > most_memory:
        why = "memory"
    elif len(ends) >= most_open:
        why = "concurrency"
    else:
        return [starts + [us], ends + [us + took_us]], None
    return [starts, ends], why


def admission(df: DataFrame, key: str, ts: str, tie: str, *, size_mb: str, memory: str, took_seconds: str, most: int = 30, seconds: float = 60.0, most_mb: float = 50.0, most_memory: float = 80.0, most_open: int = 5) -> DataFrame:
    """(key, tie, admitted, limit): each request against all limits, in the order rate, size, memory, concurrency; `limit` is the
    first that it meets. Columns give a request's size, the memory in use in per cent, and how long it runs if admitted; unknown
    ones are 0. Of requests at the same time the lesser `tie` comes first; one that ends at that time is over."""

    def step(state, us, size, used, took):
        zero = lambda x: 0.0 if x is None or pd.isna(x) else float(x)
        s, why = admission_step(state, us, zero(size), zero(used), int(round(zero(took) * 1e6)), most=most, seconds=seconds, most_mb=most_mb, most_memory=most_memory, most_open=most_open)
        return s, (why is None, why)

    return fold(df, key, ts, tie, [size_mb, memory, took_seconds], "admitted boolean, limit string", step)


def admission_statistics(judged: DataFrame, key: str) -> DataFrame:
    """(key, total, rejected_rate, rejected_size, rejected_memory, rejected_concurrency)"""
    of = lambda why: F.count_if(F.col("limit") == why).alias(f"rejected_{why}")
    return judged.groupBy(key).agg(F.count_if("admitted").alias("total"), *map(of, ("rate", "size", "memory", "concurrency")))
