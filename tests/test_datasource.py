"""A format of another package: found by its entry point, read, streamed and converted."""

import sys

import pytest

from sedgeline import datasource, plugins

FOREIGN = '''
from sedgeline.plugins import Format


def rows(documents):
    for file, text in documents:
        for k, line in enumerate(text.splitlines()):
            name, _, kind = line.partition("=")
            if not kind:
                raise ValueError(f"{file}: no kind in line {k}")
            yield file.rpartition("/")[2], k, name.strip(), kind.strip()


def parse(docs):
    from pyspark.sql import functions as F

    lines = docs.select("file", F.explode(F.split("text", "\\n")).alias("line")).where("line <> ''")
    return lines.select("file", F.substring_index("line", "=", 1).alias("name"), F.substring_index("line", "=", -1).alias("kind"))


def formats():
    yield Format("pairs", (".pairs",), parse, convert=lambda p: p.groupBy("kind").count(), rows=rows, schema="file string, line int, name string, kind string")


def broken():
    raise RuntimeError("not today")
'''


@pytest.fixture
def foreign(spark, tmp_path):
    home = tmp_path / "site"
    (home / "pairs_format-1.0.dist-info").mkdir(parents=True)
    (home / "pairs_format.py").write_text(FOREIGN)
    (home / "pairs_format-1.0.dist-info" / "METADATA").write_text("Metadata-Version: 2.1\nName: pairs-format\nVersion: 1.0\n")
    (home / "pairs_format-1.0.dist-info" / "entry_points.txt").write_text(f"[{datasource.GROUP}]\nbroken = pairs_format:broken\npairs = pairs_format:formats\n")
    sys.path.insert(0, str(home))
    yield
    sys.path.remove(str(home))


def test_a_foreign_format(spark, tmp_path, foreign):
    known = plugins.default_formats()
    new, wrong = datasource.load_entry_points(known)
    assert new == ["pairs"] and wrong == {"broken": "RuntimeError: not today"}
    assert datasource.register_sources(spark, known) == ["pairs"] and known.require("pairs").info()["source"]
    (tmp_path / "in").mkdir()
    for k in range(5):
        (tmp_path / "in" / f"d{k}.pairs").write_text(f"a{k}=x\nb{k} = y\n")
    (tmp_path / "in" / "other.txt").write_text("none")
    read = spark.read.format("pairs").option("files", 2).load(f"{tmp_path}/in")
    want = sorted(row for k in range(5) for row in ((f"d{k}.pairs", 0, f"a{k}", "x"), (f"d{k}.pairs", 1, f"b{k}", "y")))
    assert sorted(map(tuple, read.collect())) == want and read.rdd.getNumPartitions() == 3

    def streamed():
        stream = spark.readStream.format("pairs").option("maxFilesPerTrigger", 2).load(f"{tmp_path}/in")
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()))

    first = streamed()
    assert first and set(first) <= set(want)
    for _ in range(6):  # a run takes at least one more micro-batch
        if len(streamed()) == len(want):
            break
    (tmp_path / "in" / "later.pairs").write_text("c=z\n")
    assert streamed() == sorted([*want, ("later.pairs", 0, "c", "z")])
    docs = spark.createDataFrame([("f", "a=x\nb=x\nc=y\n")], "file string, text string")
    assert {r.kind: r["count"] for r in known.convert("pairs", known.require("pairs").parse(docs)).collect()} == {"x": 2, "y": 1}
    with pytest.raises(Exception, match="no kind in line 0"):
        (tmp_path / "bad.pairs").write_text("nothing")
        spark.read.format("pairs").load(f"{tmp_path}/bad.pairs").collect()


def test_rows_of_documents_and_one_registry():
    assert list(datasource.json_lines(iter([("f", '{"b": 1, "a": 2}\n\n3')]))) == [("f", 0, '{"a": 2, "b": 1}'), ("f", 2, "3")]
    assert plugins.shared_formats() is plugins.shared_formats() and "rdf" in plugins.shared_formats().names()
    with pytest.raises(ValueError, match="no rows"):
        datasource.source_of(plugins.Format("x", (".x",), lambda d: d))
