"""State across micro-batches and restarts, the registry of breakers, admission, and sums over many chunks."""

import datetime as dt
import json
import random
from collections import Counter

import pytest
from documents import TURTLE
from pyspark.sql import functions as F

from sedgeline.streaming import control, pipeline, stateful


def models(tmp_path, n=90):
    (tmp_path / "in").mkdir()
    items = [{"@type": "Interface", "@id": f"dtmi:t:m{k};1"} for k in range(n)] + [{"@type": "Other"}, 5]
    (tmp_path / "in" / "all.json").write_text(json.dumps(items))
    (tmp_path / "in" / "one.dtdl").write_text(json.dumps({"@type": "Interface", "@id": "dtmi:t:one;1"}))


def test_a_restart_in_the_middle_counts_all_once(spark, tmp_path):
    models(tmp_path)
    made = stateful.pipeline_for("dtdl", "counts", chunk=31)
    token = stateful.Token()
    stop = lambda p: token.cancel() if p.batches == 1 else None
    first = made.execute(spark, f"{tmp_path}/in", f"{tmp_path}/ck", token=token, on_progress=stop)
    assert not first.success and first.stats.state == "cancelled" and 1 <= first.stats.batches < 3
    half = made.aggregated(spark, f"{tmp_path}/ck/query").collect()
    assert 0 < half[0].n < 91
    second = made.execute(spark, f"{tmp_path}/in", f"{tmp_path}/ck", f"{tmp_path}/out")
    assert second.success and second.stats.state == "done" and second.stats.batches >= 1
    assert [tuple(r) for r in spark.read.parquet(second.output).collect()] == [("Interface", 91)]


def test_lists_and_last_items(spark, tmp_path):
    (tmp_path / "d.ttl").write_text(TURTLE)
    listed = stateful.pipeline_for("TTL", chunk=12).execute(spark, f"{tmp_path}/d.ttl", f"{tmp_path}/a")
    from sedgeline.sources import rdf

    assert listed.data.count() == rdf.read(spark, f"{tmp_path}/d.ttl").count() and listed.stats.rows >= listed.data.count()
    with pytest.raises(ValueError, match="no streaming pipeline"):
        stateful.pipeline_for("cdm")


def test_faults_stop_a_run_or_are_warnings(spark, tmp_path):
    (tmp_path / "bad.ttl").write_text("x:a x:b .")
    failed = stateful.pipeline_for("rdf").execute(spark, f"{tmp_path}/bad.ttl", f"{tmp_path}/a")
    assert not failed.success and "bad.ttl" in failed.error
    warned = stateful.pipeline_for("rdf", "counts", fail_fast=False).execute(spark, f"{tmp_path}/bad.ttl", f"{tmp_path}/b")
    assert warned.success and len(warned.stats.warnings) == 1 and warned.data.count() == 0


def test_breakers_by_name(spark, tmp_path):
    r = random.Random(6)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, f"s{k % 3}", t0 + dt.timedelta(seconds=10 * k), r.random() < 0.6, None) for k in range(90)] + [(90, "s1", t0 + dt.timedelta(seconds=901), False, "reset"), (91, "s2", t0 + dt.timedelta(seconds=902), False, "open")]
    for a, b in ((0, 40), (40, 92)):
        spark.createDataFrame(rows[a:b], "id long, name string, ts timestamp, bad boolean, command string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        calls = spark.readStream.schema("id long, name string, ts timestamp, bad boolean, command string").parquet(f"{tmp_path}/in")
        out = stateful.breakers(calls, "name", "ts", "id", "bad", command="command", failures=2, successes=2, timeout_seconds=60)
        out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    got = {x.name: x for x in stateful.registry(spark, f"{tmp_path}/ck", now=F.lit(t0 + dt.timedelta(seconds=932)), timeout_seconds=60).collect()}
    want = {}
    for name in ("s0", "s1", "s2"):
        s, n = None, Counter()
        for i, of, ts, bad, command in rows:
            if of == name and command is None:
                s, outcome = control.breaker_step(s, int(ts.replace(tzinfo=dt.UTC).timestamp() * 1e6), bad, failures=2, successes=2, timeout=60)
                n[outcome] += 1
                n["bad"] += bad and outcome == "called"
        want[name] = (s["state"], n["called"], n["bad"], n["rejected"])
    assert {k: (x.calls, x.bad, x.rejected) for k, x in got.items()} == {k: v[1:] for k, v in want.items()}
    assert got["s1"].state == "closed" and got["s2"].state == "open" and abs(got["s2"].seconds_left - 30) < 1e-6
    assert spark.read.parquet(f"{tmp_path}/out").where("outcome in ('called', 'rejected')").count() == 90


def test_admission_against_a_plain_sweep(spark):
    r = random.Random(8)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, k % 2, t0 + dt.timedelta(seconds=r.randrange(900)), r.choice([None, 1.0, 60.0]), r.choice([10.0, 10.0, 90.0]), r.choice([1.0, 5.0, 400.0])) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, k int, ts timestamp, mb double, used double, took double").repartition(3)
    got = {x.id: x.limit for x in control.admission(df, "k", "ts", "id", size_mb="mb", memory="used", took_seconds="took", most=2, most_open=3).collect()}
    want, starts, ends = {}, {0: [], 1: []}, {0: [], 1: []}
    for i, k, ts, mb, used, took in sorted(rows, key=lambda x: (x[2], x[0])):
        rate = sum(1 for s in starts[k] if (ts - s).total_seconds() < 60) >= 2
        busy = sum(1 for e in ends[k] if e > ts) >= 3
        want[i] = "rate" if rate else "size" if (mb or 0) > 50 else "memory" if used > 80 else "concurrency" if busy else None
        if want[i] is None:
            starts[k].append(ts)
            ends[k].append(ts + dt.timedelta(seconds=took))
    assert got == want and set(want.values()) == {"rate", "size", "memory", "concurrency", None}
    judged = control.admission(df, "k", "ts", "id", size_mb="mb", memory="used", took_seconds="took", most=2, most_open=3)
    assert sum(x.total + x.rejected_rate + x.rejected_size + x.rejected_memory + x.rejected_concurrency for x in control.admission_statistics(judged, "k").collect()) == 300


def test_every_chunk_is_counted(spark, tmp_path):
    (tmp_path / "in").mkdir()
    size = 0
    for k in range(105):
        text = f"<http://a> <http://b> 'text {k}' ."
        (tmp_path / "in" / f"d{k}.ttl").write_text(text)
        size += len(text)
    p = pipeline.run(pipeline.documents(spark, f"{tmp_path}/in", files=1), lambda df, k: None, f"{tmp_path}/ck")
    assert (p.batches, p.rows, p.bytes, len(p.chunks)) == (105, 105, size, 105) and p.seconds > 0 and all(r > 0 for r in p.chunk_rates())


def test_an_empty_folder_gives_empty_tables(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert pipeline.counted(spark, f"{tmp_path}/in", f"{tmp_path}/ck", f"{tmp_path}/out").collect() == []
    c = pipeline.converted(spark, f"{tmp_path}/in", f"{tmp_path}/ck2", f"{tmp_path}/out2")
    assert [t.count() for t in (c.entities, c.properties, c.relationships, c.skipped)] == [0, 0, 0, 0]
