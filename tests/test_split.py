"""Large documents cut into parts against the same documents read whole."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sedgeline.operators import ordered
from sedgeline.sources import rdf, split, turtle

HEAD = '@prefix x: <http://t.org/#> .\n@prefix : <http://u.org/> .\n'


def document(rng, n):
    """Statements that hold everything that looks like an end, a bracket or a setting and is none."""
    out = [HEAD]
    for k in range(n):
        out.append(
            rng.choice(
                [
                    f"x:a{k} x:p x:b.c , 1.5, .5, 1e3 ; :q true .",
                    f'x:a{k} x:p "dots . and [ brackets" ; # a comment . with "quotes\n  x:q \'it is\'@en .',
                    f'x:a{k} x:says """long . text\n@prefix x: <http://wrong/> .\n with "quotes" and ] and \\""" in it\n""" .',
                    f"x:a{k} x:says '''other [ (\n \"\"\" . \n''' .",
                    f"x:a{k} x:list ( x:b [ x:c ( 1 2 ) ; x:d [] ]\n x:e ) .",
                    f"[ x:p{k} _:same ] x:q _:same, _:o{k} .",
                    f"@prefix x: <http://t.org/{k % 3}#> .",
                    f"PREFIX y: <http://y{k % 2}.org/>\ny:a x:b y:c.",
                    f"<http://i.org/#{k}.x> a x:T{k % 4}.",
                    f"x:a{k} x:p x:end. x:two x:p 3 .",
                    "",
                ]
            )
        )
    return "\n".join(out) + "\n"


def whole(spark, docs, **how):
    return sorted((tuple(r) for r in rdf.documents_to_triples(spark.createDataFrame(docs, "file string, text string"), **how).collect()), key=repr)


def cut(spark, docs, blocks, piece, **how):
    """The documents' lines, dealt to parts of so many lines."""
    rows = [(f, 100 * (i // blocks), i, line.encode("latin-1" if "Ä" in t and "bad" in f else "utf-8")) for f, t in docs for i, line in enumerate(t.split("\n"))]
    df = spark.createDataFrame(rows, "file string, block long, i long, value binary").repartition(5, "file", "block").sortWithinPartitions("file", "block", "i").select("file", "block", "value")
    return sorted((tuple(r) for r in split.read_turtle(df, piece=piece, **how).collect()), key=repr)


@pytest.mark.parametrize(("blocks", "piece"), [(3, 40), (7, 1), (10_000, 1 << 20)])
def test_turtle_in_parts_as_whole(spark, blocks, piece):
    rng = random.Random(blocks)
    docs = [(f"d{k}", document(rng, 40)) for k in range(3)] + [("fault", HEAD + "x:a x:b x:c .\nx:a x:b .\nx:d x:e x:f ."), ("open", HEAD + "x:a x:b x:c .\nx:d x:e"), ("comments", "# one . two\n\n# three")]
    want = whole(spark, docs)
    got = cut(spark, docs, blocks, piece)
    assert [r for r in got if r[0] not in ("fault", "open")] == [r for r in want if r[0] not in ("fault", "open")]
    assert [(r[0], r[9] is not None) for r in got if r[0] in ("fault", "open")] == [("fault", True), ("open", True)]


def test_graphs_and_other_bytes(spark):
    from pyspark.sql import functions as F

    trig = HEAD + "x:g1 { x:a x:b x:c . x:d x:e [ x:f 1 ] }\n:g2 {\n x:a x:b 'x } . ' }\nx:s x:t _:u .\n" * 5
    assert cut(spark, [("t", trig)], 2, 1, fmt=F.lit("trig")) == whole(spark, [("t", trig)], fmt=F.lit("trig"))
    latin = HEAD + 'x:a x:b "Ärger" .\n' * 3
    assert cut(spark, [("bad", latin)], 2, 1) == whole(spark, [("bad", latin)])


def test_a_file_in_many_tasks(spark, tmp_path):
    text = document(random.Random(5), 400)
    (tmp_path / "one.ttl").write_text(text)
    (tmp_path / "small.ttl").write_text(HEAD + "x:a x:b x:c .")
    (tmp_path / "lines.nt").write_text('<http://a> <http://b> "c\\nd" .\n_:x <http://b> <http://c> .\n')
    (tmp_path / "wrong.nt").write_text("<http://a> <http://b> <http://c> .\nno triple\n")
    (tmp_path / "none.nt").write_text("\n\n")
    plain = sorted((tuple(r) for r in rdf.read(spark, str(tmp_path), whole_mb=1e9).collect()), key=repr)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert split.records(spark, f"{tmp_path}/one.ttl", "turtle").rdd.getNumPartitions() >= 10
        got = sorted((tuple(r) for r in rdf.read(spark, str(tmp_path), whole_mb=len(text) / 2 / (1 << 20)).collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == plain and len(got) > 500
    name = next(r[0] for r in got if r[0].endswith("lines.nt"))
    assert [r[:6] for r in got if r[0] == name] == [(name, None, f"{name}#nx", "bnode", "http://b", "http://c"), (name, None, "http://a", "iri", "http://b", "c\nd")]
    assert {r[0].rpartition("/")[2]: r[9] for r in got if r[9]} == {"wrong.nt": "ValueError: syntax error: no triple", "none.nt": "ValueError: the content is empty"}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(['"', '"""', "'''", "\\", "\n", ".", " ", "[", "]", "x:a", "#", "<http://a#b>", "1."]), max_size=30), st.integers(0, 30))
def test_states_add_up(parts, at):
    text = "".join(parts)
    lines = text.split("\n")
    at = min(at, len(lines))
    one = "\n".join(lines[:at])
    two = text[len(one) :]
    if two and not two.startswith("\n"):
        return
    mode, depth, _ = split.walk_turtle(text, 0, 0)
    m, d, _ = split.walk_turtle(one, 0, 0)
    assert split.walk_turtle(two, m, d)[:2] == (mode, depth)


def test_json_array_in_parts(spark, tmp_path):
    rng = random.Random(2)
    items = [rng.choice([{"@type": "Interface", "k": k, "s": 'a "quoted } ] text\\', "deep": {"x": [{}, [1, {"y": "}"}]]}}, k, "text } with [", [k, [k]], None, {}, True]) for k in range(300)]
    for name, text in (("flat", json.dumps(items)), ("tall", json.dumps(items, indent=1)), ("object", json.dumps({"a": {"b": [{"c": 1}]}, "d": [{}]})), ("none", "[]"), ("nested", json.dumps([items[:20], items[20:40]])), ("wrong", '[{"a": 1}, {"b": nothing}, {"c": 2}]'), ("short", '[{"a": 1}, {"b": 2}'), ("blank", " ")):
        (tmp_path / f"{name}.json").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = split.array_elements(split.records(spark, str(tmp_path), "json"), piece=100).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    by = {}
    for r in sorted(rows, key=lambda r: r.number):
        by.setdefault(r.file.rpartition("/")[2][:-5], []).append(r)
    read = lambda name: [json.loads(r.element) for r in by[name]]
    assert read("flat") == items and read("tall") == items and [r.number for r in by["flat"]] == list(range(300))
    assert read("object") == [{"a": {"b": [{"c": 1}]}, "d": [{}]}] and "none" not in by and read("nested") == [items[:20], items[20:40]]
    assert [(r.element, r.fault) for r in by["short"]] == [('{"a": 1}', None), ('{"b": 2}', None), (None, "ValueError: the array does not end")] and "blank" not in by
    assert by["wrong"][0].element == '{"a": 1}' and sum(r.fault is not None for r in by["wrong"]) == 1


def test_chunks_of_one_document(spark, tmp_path):
    (tmp_path / "in.json").write_text(json.dumps([{"n": k} for k in range(95)]))
    elements = split.array_elements(split.records(spark, f"{tmp_path}/in.json", "json"))
    stream = split.chunked(elements, f"{tmp_path}/chunks", ["file", "number"], 20)
    sizes = []
    stream.writeStream.foreachBatch(lambda df, k: sizes.append(df.count())).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
    assert sum(sizes) == 95 and max(sizes) <= 20


def test_running_sums_and_numbers(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = random.Random(3)
        rows = [(rng.choice(["one", "one", "one", "two", None]), k, rng.choice([None, 1, 5, -2])) for k in range(2000)]
        df = spark.createDataFrame(rows, "g string, i long, v long").repartition(7)
        got = ordered.numbered(ordered.running(df, ["g"], ["i"], df["v"], "before"), ["g"], ["i"], start=1).collect()
        sums, counts = {}, {}
        want = []
        for g, i, v in rows:
            want.append((g, i, v, sums.get(g, 0), counts.get(g, 0) + 1))
            sums[g], counts[g] = sums.get(g, 0) + (v or 0), counts.get(g, 0) + 1
        assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_settings_are_told_from_text():
    text = 'x:prefix x:base "@prefix x: <http://no> ." .\n@prefix y: <http://y> .\nPREFIX z: <z>\nbase <http://b>\nx:a x:b x:c.@base <c> .'
    assert [s for _, s in split.settings_of(text)] == ["@prefix y: <http://y> .", "PREFIX z: <z>", "base <http://b>", "@base <c> ."]
    assert list(turtle.read("@prefix y: <http://y> . y:a y:b y:c ."))


def test_one_document_is_read_by_many_tasks(spark, monkeypatch):
    """Its settings and the states of its parts go to the pieces, not the pieces to one task of the file; the join by file
    gives the same."""
    kept = {}

    def written(df, name="step"):
        kept[name] = from_shared(df, name)
        return kept[name]

    from_shared = split.written
    monkeypatch.setattr(split, "written", written)
    docs = [("one", document(random.Random(8), 60)), ("wrong", HEAD + "x:a x:b .")]
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables whose size is not known to be small
    try:
        got = cut(spark, docs, 5, 1)
        tasks = {n: kept[n].where("file = 'one'").select("_metadata.file_path").distinct().count() for n in ("fragments", "quads")}
        monkeypatch.setattr(split, "MOST", 0, raising=False)
        assert cut(spark, docs, 5, 1) == got
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert min(tasks.values()) > 1, tasks
    assert [r for r in got if r[0] == "one"] == [r for r in whole(spark, docs) if r[0] == "one"]
