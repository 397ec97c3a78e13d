"""Whole tasks on documents."""

import json

import pytest
from documents import CRANE, GAUGES, HOIST, NTRIPLES, QUARRY, TURTLE

from sedgeline.operators import checks, report
from sedgeline.plans import documents as D


def test_folder(spark, tmp_path):
    for name, text in (("a.ttl", TURTLE), ("b.nt", NTRIPLES), ("t.json", HOIST), ("r.dtdl", CRANE), ("Gauges.cdm.json", GAUGES), ("model.json", QUARRY), ("x.txt", "?")):
        (tmp_path / name).write_text(text)
    (tmp_path / "l.ttl").write_bytes(TURTLE.replace("Zoo of 9", "Zoo é").encode("latin-1"))
    docs = D.read_folder(spark, str(tmp_path))
    assert {f: d.count() for f, d in docs.items()} == {"rdf": 3, "dtdl": 2, "cdm": 2}
    c = D.converted(docs["rdf"], "rdf")
    assert c.entities.count() == 9
    parts = D.definition(c, D.titled(docs["rdf"]))
    rows = {r.file.rsplit("/")[-1]: json.loads(r.json) for r in D.definition_json(parts).collect()}
    assert set(rows) == {"a.ttl", "b.nt", "l.ttl"} and [p["path"] for p in rows["a.ttl"]["definition"]["parts"]][:2] == [".platform", "definition.json"]
    text = D.exported(spark, json.dumps(rows["a.ttl"]))
    assert "Keeper" in text and "feeds" in text
    found = D.validated(docs["cdm"], "cdm", strict=True)
    assert found.where("severity = 'warning'").isEmpty() and not found.isEmpty()


def test_errors_raise(spark):
    docs = spark.createDataFrame([("t.json", CRANE)], "file string, text string")
    with pytest.raises(D.NotValid, match="dangling"):
        D.definition(D.converted(docs, "dtdl"), D.titled(docs))
    assert D.definition(D.converted(docs, "dtdl"), D.titled(docs), skip_validation=True).count() == 4


def test_round_trip_and_compare(spark):
    got = D.round_trip(spark, TURTLE)
    assert got["success"] and got["comparison"]["Class"]["first"] == 3
    assert not D.round_trip(spark, "broken <")["success"]
    rows = D.compared(spark, TURTLE, TURTLE.replace(":Bird", ":Fish"))
    assert not rows["all"]["equal"] and [(r["name"], r["side"]) for r in rows["differences"]] == [("Bird", "first"), ("Fish", "second")]


def test_reports(spark):
    docs = spark.createDataFrame([("a.ttl", TURTLE + ":w a owl:ObjectProperty ."), ("b.ttl", "broken <")], "file string, text string")
    found = D.validated(docs, "rdf")
    js = report.issues_json(found)
    assert {r.file for r in js.collect()} == {"a.ttl", "b.ttl"} and report.issues_of_json(js).count() == found.count()
    assert any("| missing_signature |" in r.text for r in report.issues_markdown(found).collect())
    assert report.filtered(found, severity="error").count() == 1 and report.merged([found, found]).count() == 2 * found.count()
    assert report.statistics(found).where("source is null and category is null").first().n == found.count()
    c = D.converted(docs, "rdf")
    text = report.conversion_text(c.entities, c.relationships, c.skipped, found).first().text
    assert text.startswith("3 entities, 1 relationships, 1 skipped, 80.0 % done") and "skipped relationship w" in text
    assert checks.by_severity_category(found).where("severity is null and category is null").first().n == found.count()
