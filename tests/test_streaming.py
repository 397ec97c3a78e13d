"""Chunked documents, control folds and the format registry."""

import datetime as dt
import random

import pytest
from documents import CRANE, HOIST, NTRIPLES, TURTLE

from sedgeline import plugins
from sedgeline.streaming import control, pipeline


def test_counts_over_chunks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(5):
        (tmp_path / "in" / f"d{k}.ttl").write_text(TURTLE)
    got = pipeline.counted(spark, str(tmp_path / "in"), str(tmp_path / "ck"), str(tmp_path / "out"), files=2)
    assert {r.kind: r.n for r in got.collect()} == {"Class": 15, "DatatypeProperty": 10, "ObjectProperty": 5}
    assert not pipeline.streams(spark, str(tmp_path / "in"))


def test_model_kinds_and_failures(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k, text in enumerate((HOIST, CRANE)):
        (tmp_path / "in" / f"d{k}.json").write_text(text)
    got = pipeline.counted(spark, str(tmp_path / "in"), str(tmp_path / "ck"), str(tmp_path / "out"), kind="dtdl")
    assert {r.kind: r.n for r in got.collect()}["Interface"] == 2

    def fail(df, k):
        raise ValueError("no")

    stream = pipeline.documents(spark, str(tmp_path / "in"), files=1)
    p = pipeline.run(stream, fail, str(tmp_path / "ck2"), fail_fast=False)
    assert p.state == "done" and len(p.warnings) == 2
    token = pipeline.Token()
    child = pipeline.Token(parents=[token])
    said = []
    token.callbacks.append(lambda: said.append(1))
    token.cancel()
    token.cancel()
    assert pipeline.run(stream, lambda df, k: None, str(tmp_path / "ck3"), token=child).state == "cancelled" and said == [1]
    with pytest.raises(pipeline.Cancelled):
        pipeline.pipeline(lambda: spark.range(1), [lambda d: d], token=child)
    assert pipeline.pipeline(lambda: spark.range(3), [lambda d: d.where("id > 0")], keep=True).count() == 2


def events(spark, n=200):
    r = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k % 3 if k % 50 else None, t0 + dt.timedelta(seconds=r.randrange(4000)), k, r.random() < 0.4) for k in range(n)]
    return rows, spark.createDataFrame(rows, "k long, ts timestamp, id long, bad boolean").repartition(3)


def test_folds_against_plain(spark):
    rows, df = events(spark)
    state, want, broken, outcome = {}, {}, {}, {}
    for k, ts, i, bad in sorted(rows, key=lambda x: (x[1], x[2])):
        us = int(ts.replace(tzinfo=dt.UTC).timestamp() * 1e6)
        state[k], want[i] = control.bucket_step(state.get(k), us, rate=1, per=60, burst=2)
        broken[k], outcome[i] = control.breaker_step(broken.get(k), us, bad, failures=2, successes=2, timeout=120)
    got = {r.id: r.admitted for r in control.token_bucket(df, "k", "ts", "id", rate=1, per_seconds=60, burst=2).collect()}
    assert got == want and 0 < sum(want.values()) < len(want)
    calls = control.circuit_breaker(df, "k", "ts", "id", "bad", failures=2, successes=2, timeout_seconds=120)
    assert {r.id: r.outcome for r in calls.collect()} == outcome and "rejected" in outcome.values()
    assert sum(r.calls for r in control.breaker_metrics(calls, "k").collect()) == 200
    limited = control.sliding_limit(df, "k", "ts", "id", most=2, seconds=60).collect()
    at = {i: (k, ts) for k, ts, i, _ in rows}
    for r in limited:
        if r.admitted:
            k, ts = at[r.id]
            inside = [x for x in limited if x.admitted and at[x.id][0] == k and ts - dt.timedelta(seconds=60) < at[x.id][1] <= ts]
            assert len(inside) <= 2
    assert control.unlimited(df, "k", "id").where("admitted").count() == 200


def test_folds_on_a_stream(spark, tmp_path):
    """The same results as of a batch, with the state kept between three micro-batches and over a restart."""
    rows, df = events(spark, 90)
    batch = {r.id: (r.admitted, round(r.tokens, 6)) for r in control.token_bucket(df, "k", "ts", "id", rate=1, per_seconds=60, burst=2).collect()}
    calls = control.circuit_breaker(df, "k", "ts", "id", "bad", failures=2, successes=2, timeout_seconds=120)
    outcome = {r.id: (r.state, r.outcome) for r in calls.collect()}
    rows.sort(key=lambda r: (r[1], r[2]))
    put = lambda n: spark.createDataFrame(rows[30 * n : 30 * n + 30], df.schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def go(name, made):
        made.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/{name}-ck").trigger(availableNow=True).start(f"{tmp_path}/{name}").awaitTermination()
        return spark.read.parquet(f"{tmp_path}/{name}").collect()

    for n in range(3):
        put(n)
        stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
        admitted = go("bucket", control.token_bucket(stream, "k", "ts", "id", rate=1, per_seconds=60, burst=2))
        called = go("breaker", control.circuit_breaker(stream, "k", "ts", "id", "bad", failures=2, successes=2, timeout_seconds=120))
    assert {r.id: (r.admitted, round(r.tokens, 6)) for r in admitted} == batch
    assert {r.id: (r.state, r.outcome) for r in called} == outcome
    last = {r.k: r.last_state for r in control.breaker_metrics(calls.join(df.select("id", "ts"), "id"), "k", "ts").collect()}
    assert set(last.values()) <= {"closed", "open", "half"} and len(last) == 4


def test_counts_of_a_batch_that_runs_twice(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.ttl").write_text(TURTLE)
    at = [str(tmp_path / x) for x in ("in", "ck", "out")]
    once = {r.kind: r.n for r in pipeline.counted(spark, *at).collect()}
    # The first micro-batch again, as after a failure before its commit.
    again = {r.kind: r.n for r in pipeline.counted(spark, at[0], str(tmp_path / "ck2"), at[2]).collect()}
    assert once == again and once["Class"] == 3


def test_conversion_in_chunks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"d{k}.ttl").write_text(TURTLE.replace("Zoo of 9", f"Zoo {k}"))
    c = pipeline.converted(spark, str(tmp_path / "in"), str(tmp_path / "ck"), str(tmp_path / "out"), files=2)
    assert c.entities.count() == 9 and c.entities.select("file").distinct().count() == 3
    assert {r.name for r in c.relationships.collect()} == {"feeds"} and c.properties.count() == 6 and c.skipped.count() == 0


def test_interrupt_cancels():
    import signal

    token, former = pipeline.Token(), signal.getsignal(signal.SIGINT)
    back = pipeline.cancel_on_interrupt(token)
    try:
        signal.raise_signal(signal.SIGINT)
    finally:
        back()
    assert token.cancelled and signal.getsignal(signal.SIGINT) is former


def test_progress_and_thresholds():
    from sedgeline.functions import guards

    assert pipeline.Progress(rows=10, seconds=4.0).rows_per_second == 2.5 and pipeline.Progress().rows_per_second == 0
    assert guards.streams_for_memory(65 << 20, 256) and not guards.streams_for_memory(64 << 20, 256)


def test_breaker_states():
    step = lambda s, us, bad: control.breaker_step(s, us * 10**6, bad, failures=2, successes=2, timeout=10)
    s, seen = None, []
    for us, bad in [(0, True), (1, True), (2, False), (12, False), (13, True), (14, False), (24, False), (25, False), (26, True)]:
        s, out = step(s, us, bad)
        seen.append((s["state"], out))
    assert seen == [("closed", "called"), ("open", "called"), ("open", "rejected"), ("half", "called"), ("open", "called"), ("open", "rejected"), ("half", "called"), ("closed", "called"), ("closed", "called")]


def test_formats(spark, tmp_path):
    f = plugins.default_formats()
    assert f.names() == ["cdm", "dtdl", "rdf"] and f.of_file("A/x.manifest.cdm.json").name == "cdm" and f.of_file("x.TTL").name == "rdf" and f.of_file("x.pdf") is None
    heard = []
    f.on("convert_complete", lambda fmt, out: heard.append(fmt.name))
    docs = spark.createDataFrame([("a.nt", NTRIPLES)], "file string, text string")
    c = f.convert("rdf", f.require("rdf").parse(docs))
    assert c.entities.count() == 3 and heard == ["rdf"] and f.check("rdf", f.require("rdf").parse(docs)).count() == 0
    with pytest.raises(ValueError):
        f.register(next(iter(plugins.builtin())))
    with pytest.raises(KeyError):
        f.require("no")
    with pytest.raises(ImportError):
        f.register(plugins.Format("x", (".x",), lambda d: d, needs=("no_such_module",)))
    with pytest.raises(ValueError):
        f.register(plugins.Format("x", (".x",), lambda d: d, min_version=(9,)))
    (tmp_path / "own.py").write_text("from sedgeline.plugins import Format\ndef formats():\n    return [Format('own', ('.own',), lambda d: d)]\n")
    assert f.load_folder(str(tmp_path)) == ["own"] and f.unregister("own") and not f.unregister("own") and f.of_file("x.own") is None
