"""Digital-twin models and business-data documents: parsing, conversion, checks."""

import hashlib

import pytest
from documents import CRANE, CRANE_ID, GAUGES, HOIST, HOIST_ID, QUARRY, TIDES

from sedgeline.operators import cdm, checks, dtdl, keys
from sedgeline.sources import cdm as cdm_source
from sedgeline.sources import dtdl as dtdl_source


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), "file string, text string")


def models(spark):
    return dtdl_source.parse(docs(spark, ("f", HOIST), ("f", CRANE), ("g", "{bad")))


def entity_id(identifier):
    """The prefix plus the first 64 bits of the SHA-256 of the bare identifier modulo 10**12."""
    bare = identifier.removeprefix("dtmi:").split(";")[0]
    return str(10**12 + int.from_bytes(hashlib.sha256(bare.encode()).digest()[:8], "big") % 10**12)


def member_id(owner, name):
    return f"{owner}{int.from_bytes(hashlib.md5(name.encode()).digest()[:4], 'big') % 10_000:04d}"


H, C = entity_id(HOIST_ID), entity_id(CRANE_ID)


def test_model_ids_and_types(spark):
    c = dtdl.convert(models(spark))
    e = {r.name: r for r in c.entities.collect()}
    assert e["Hoist"].id == H and e["Crane"].id == C and e["Crane"].baseEntityTypeId == H
    p = {(r.entity_id, r.name): r for r in c.properties.collect()}
    load, wind = p[H, "load"], p[C, "wind"]
    assert (load.id, load.valueType, load.is_timeseries) == (member_id(H, "load"), "Double", False)
    assert wind.id == member_id(C, "ts_wind") and wind.is_timeseries and p[C, "sway"].valueType == "Double"
    assert e["Hoist"].entityIdParts == [p[H, "grade"].id] and p[H, "grade"].valueType == "BigInt"
    assert p[C, "label"].id == member_id(C, "label") and (C, "load_string") in p
    assert [(x.id, x.target_id) for x in c.relationships.collect()] == [(member_id(C, "rel_lifts"), H)]
    assert [(x.name, x.reason) for x in c.skipped.collect()] == [("hangsFrom", "no target")]


def test_model_modes(spark):
    m = models(spark)
    flat = {(r.entity_id, r.name) for r in dtdl.convert(m, components="flatten", commands="property", decimals="structured").properties.collect()}
    assert {(C, "reserve_load"), (C, "reserve_plate"), (C, "command_slew"), (C, "mass_scale"), (C, "mass_value")} <= flat
    c = dtdl.convert(m, components="separate", commands="entity")
    names = {r.name for r in c.entities.collect()}
    assert names == {"Hoist", "Crane", "cab_Cab", "Command_slew"}
    rel = {r.name: r for r in c.relationships.collect()}
    assert rel["has_reserve"].id == member_id(C, "comp_reserve") and rel["supports_slew"].target_id == next(r.id for r in c.entities.collect() if r.name == "Command_slew")
    assert {r.name for r in c.properties.collect()} >= {"componentId", "commandName"}
    with pytest.raises(ValueError):
        dtdl.convert(m, components="odd")


def test_model_checks(spark):
    m = models(spark)
    got = {(r.severity, r.code) for r in dtdl.issues(m).collect()}
    assert got == {("error", "parse"), ("warning", "component")}
    a = '{"@id":"dtmi:a;1","@type":"Interface","extends":"dtmi:b;1","contents":[{"@type":"Property","name":"x","schema":"odd"},{"@type":"Property","name":"x","schema":"long"},{"@type":"Property","name":"_y"},{"@type":"Relationship","name":"r","target":"dtmi:q;1","maxMultiplicity":0}]}'
    b = '{"@context":"dtmi:dtdl:context;2","@id":"dtmi:b;1","@type":"Interface","extends":["dtmi:a;1","dtmi:z;1"]}'
    bad = dtdl_source.parse(docs(spark, ("f", a), ("f", b), ("f", b)))
    got = {(r.severity, r.code) for r in dtdl.issues(bad, external_allowed=False).collect()}
    assert got == {("error", "duplicate"), ("warning", "version"), ("error", "parent"), ("error", "cycle"), ("error", "name_twice"), ("error", "name"), ("error", "multiplicity"), ("warning", "schema"), ("error", "target")}
    assert dtdl.kinds(m).count() == 6 and checks.feature_report(dtdl.features(m), checks.MODEL_SUPPORT).first().partial > 0
    assert dict(dtdl.id_mapping(m).first().mapping)[CRANE_ID] == C
    fields = {(r.name, r.valueType) for r in dtdl.flattened_fields(m.contents).collect()}
    assert fields == {("spot_bay", "BigInt"), ("spot_level", "Double"), ("spot_open", "Boolean")}


def test_checks_inside_contents(spark):
    a = '{"@context":"dtmi:dtdl:context;3","@id":"dtmi:a;1","@type":"Interface","schemas":[{"@type":"Enum"},{"@id":"dtmi:s;1","@type":"Enum"},{"@id":"s","@type":"Map"}],"contents":[{"@type":"Relationship","name":"r","properties":[{"name":"p"},{"name":"q"},{"name":"p"},{"name":null}]},{"@type":"Command","name":"go","request":{"name":"x","schema":"odd"},"response":{"name":"y","schema":"dtmi:s;1"}},{"@type":"Command","name":"stop","request":{"name":"x","schema":{"@type":"Enum","valueSchema":"integer"}}}]}'
    m = dtdl_source.parse(docs(spark, ("f", a), ("g", a.replace('"schemas"', '"other"').replace('"name":"q"},{"name":"p"}', '"name":"q"}').replace("odd", "long"))))
    got = [(r.file, r.severity, r.code) for r in dtdl.issues(m).collect()]
    assert sorted(got) == [("f", "error", "property_twice"), ("f", "error", "shared_dtmi"), ("f", "error", "shared_id"), ("f", "warning", "command_schema")]


def test_model_depth_and_compliance(spark):
    chain = [('{"@context":"dtmi:dtdl:context;2","@id":"dtmi:c%d;1","@type":"Interface"%s}' % (k, f',"extends":"dtmi:c{k - 1};1"' if k else "")) for k in range(15)]
    m = dtdl_source.parse(docs(spark, *[("f", x) for x in chain]))
    assert {r.uri for r in dtdl.issues(m).where("code = 'depth'").collect()} == {"dtmi:c13;1", "dtmi:c14;1"}
    assert {r.uri for r in dtdl.compliance(m).where("code = 'DTDL021'").collect()} == {f"dtmi:c{k};1" for k in range(10, 15)}
    # Each also extends the next but one: the longest way counts, not the shortest.
    twice = [('{"@context":"dtmi:dtdl:context;4","@id":"dtmi:c%d;1","@type":"Interface","extends":[%s]}' % (k, ",".join(f'"dtmi:c{j};1"' for j in (k - 2, k - 1) if j >= 0))) for k in range(15)]
    ring = [('{"@context":"dtmi:dtdl:context;2","@id":"dtmi:r%d;1","@type":"Interface","extends":"dtmi:r%d;1"}' % (k, (k + 1) % n)) for n in (12,) for k in range(n)] + ['{"@context":"dtmi:dtdl:context;2","@id":"dtmi:tail;1","@type":"Interface","extends":"dtmi:r0;1"}']
    m = dtdl_source.parse(docs(spark, *[("f", x) for x in twice], *[("ring", x) for x in ring], *[("small", x.replace("r0;1", "tail;1")) for x in ring[-1:]]))
    found = dtdl.issues(m).collect()
    assert {r.uri for r in found if r.code == "depth"} == {"dtmi:c13;1", "dtmi:c14;1"}
    assert {r.file for r in found if r.code == "cycle"} == {"ring", "small"} and sum(r.code == "cycle" for r in found) == 14
    found = dtdl.compliance(m).where("code = 'DTDL021'").collect()
    assert {r.uri for r in found if r.file == "f"} == {"dtmi:c12;1", "dtmi:c13;1", "dtmi:c14;1"}
    assert sum(r.file == "ring" for r in found) == 13 and not any(r.file == "small" for r in found)


def test_compliance_codes(spark):
    one = lambda dtmi, more="", v=2: '{"@context":"dtmi:dtdl:context;%d","@id":"%s","@type":"Interface"%s}' % (v, dtmi, more)
    named = ',"contents":[{"@type":"%s","name":"%s","schema":"long"}]'
    rows = [
        ("a", '{"@context":"dtmi:dtdl:context;2","@type":"Interface"}', ["DTDL001"]), ("b", one("urn:x;1"), ["DTDL002"]), ("c", one("dtmi:" + "a" * 130 + ";1", v=3), ["DTDL003"]), ("d", one("dtmi:_x:_y:z;1"), ["DTDL004", "DTDL004"]),
        ("e", one("dtmi:" + "n" * 65 + ";1"), ["DTDL010"]), ("f", one("dtmi:m;1", ',"extends":["dtmi:p;1","dtmi:q;1","dtmi:r;1"]'), ["DTDL020"] + ["DTDL022"] * 3), ("g", one("dtmi:m;1", named % ("Property", "p" * 65)), ["DTDL030"]),
        ("h", one("dtmi:m;1", named % ("Telemetry", "9a")), ["DTDL031"]), ("i", one("dtmi:m;1", named % ("Component", "9" * 70)), []), ("j", one("dtmi:m;1", named % ("Property", "p" * 65), 9), []), ("k", one("dtmi:dtdl:m;1", named % ("Property", "a_")), []),
    ]
    found = dtdl.compliance(dtdl_source.parse(docs(spark, *[r[:2] for r in rows]))).collect()
    assert {f: sorted(r.code for r in found if r.file == f) for f, _, _ in rows} == {f: codes for f, _, codes in rows}
    assert {r.severity for r in found if r.code == "DTDL022"} == {"warning"}


def test_business_documents(spark):
    m = cdm_source.parse(docs(spark, ("x/tides.manifest.cdm.json", TIDES), ("x/Gauges.cdm.json", GAUGES), ("y/model.json", QUARRY), ("z.cdm.json", "{")))
    assert {r.kind for r in m.documents.collect()} == {"manifest", "schema", "model"} and m.faults.count() == 1
    c = cdm.convert(m)
    at = lambda df, f: [r for r in df.collect() if r.file == f]
    e = {r.name: r for r in at(c.entities, "x/Gauges.cdm.json")}
    # Numbers run through entities and their properties: 1 + 3, then 1 + 4 (two of its own, of which one is the base's too).
    assert [e[n].id for n in ("Device", "Sensor", "Gauge")] == [str(10**12 + k) for k in (0, 4, 9)]
    p = sorted((r for r in at(c.properties, "x/Gauges.cdm.json") if r.entity_id == e["Gauge"].id), key=lambda r: int(r.id))
    assert [(r.name, r.valueType) for r in p] == [("serial", "String"), ("maker", "String"), ("since", "DateTime"), ("weight", "BigInt"), ("title", "String"), ("mark", "String"), ("depth", "Decimal"), ("mood", "String")]
    of = {r.name: r.id for r in p}
    assert e["Gauge"].entityIdParts == [of["mark"]] and e["Gauge"].displayNamePropertyId == of["title"] and e["Gauge"].baseEntityTypeId is None
    assert m.attributes.where("name = 'title' and file like '%Gauges%'").first().max_length == 12
    e = {r.name for r in at(c.entities, "x/tides.manifest.cdm.json")}
    r = {r.name: r for r in at(c.relationships, "x/tides.manifest.cdm.json")}
    assert e == {"Gauge", "Sensor", "Harbour"} and set(r) == {"watchedBy", "Gauge_to_Pier"}
    assert [(x.name, x.id) for x in at(c.relationships, "y/model.json")] == [("Pit_to_Crew", str(10**12 + 7))]
    assert {x.code for x in checks.dangling(c.relationships, c.entities).collect()} == {"dangling"}
    codes = {(x.severity, x.code) for x in cdm.issues(m).collect()}
    assert {("error", "parse"), ("warning", "type"), ("warning", "end"), ("info", "bare")} <= codes
    assert not cdm.convert(m, flatten=False).entities.where("name = 'Sensor' and baseEntityTypeId = '1000000000000'").isEmpty()


def test_business_sniffing(spark):
    from pyspark.sql import functions as F

    got = docs(spark, ("a", QUARRY), ("b", HOIST), ("c", "{"), ("d", QUARRY + " " * 5000)).select(cdm_source.looks_like(F.col("text"))).collect()
    assert [r[0] for r in got] == [True, False, False, False]


def test_keys(spark):
    p = spark.createDataFrame([("f", "e", 0, "1", "valid", "BigInt", False), ("f", "e", 1, "2", "myid", "Double", False), ("f", "e", 2, "3", "the_name", "String", False), ("f", "e", 3, "4", "guid", "String", False), ("f", "g", 0, "9", "x", "Double", False)], "file string, entity_id string, pos int, id string, name string, valueType string, is_timeseries boolean")
    e = spark.createDataFrame([("f", "e", "E", []), ("f", "g", "G", ["9"])], "file string, id string, name string, entityIdParts array<string>")
    last = keys.last_key(p).first()
    assert (last.entityIdParts, last.displayNamePropertyId) == (["4"], "3")
    one = lambda **kw: {r.id: r.inferred for r in keys.infer(p, e, **kw).collect()}
    assert one() == {"e": ["1"], "g": []} and one(strategy="none") == {"e": [], "g": []} and one(strategy="explicit", explicit={"E": ["guid", "valid"]})["e"] == ["4", "1"]
    assert one(patterns=["guid"])["e"] == ["4"]
    got = {r.id: (r.entityIdParts, r.changed) for r in keys.infer_all(p, e).collect()}
    assert got == {"e": (["1"], True), "g": (["9"], False)}
    assert {r.id: r.displayNamePropertyId for r in keys.display_names(p, e).collect()} == {"e": "3", "g": None}


def test_files_of_a_folder_that_count(spark):
    files = ["a/z.manifest.cdm.json", "a/b.manifest.cdm.json", "a/model.json", "a/X.cdm.json", "b/model.json", "b/Y.cdm.json", "c/U.cdm.json", "c/V.cdm.json", "c/note.txt", "model.json"]
    got = cdm_source.preferred(docs(spark, *[(f, "{}") for f in files]))
    assert {r.file for r in got.collect()} == {"a/b.manifest.cdm.json", "a/X.cdm.json", "b/model.json", "c/U.cdm.json", "c/V.cdm.json", "model.json"}


def test_target_limits_and_combined_report(spark, tmp_path):
    import json

    from sedgeline.operators import report

    many = ",".join('{"@type":"Property","name":"p%d","schema":"long"}' % k for k in range(120))
    m = dtdl_source.parse(docs(spark, ("f", '{"@context":"dtmi:dtdl:context;3","@id":"dtmi:o:Wide;1","@type":"Interface","contents":[%s]}' % many)))
    found = dtdl.target_compliance(m)
    assert {(r.code, r.severity) for r in found.collect()} >= {("properties", "error"), ("TGT003", "warning")}
    rows = {(r.report, r.severity): r.n for r in report.combined({"models": found, "source": dtdl.issues(m)}).where("source is null and category is null").collect()}
    assert rows[None, None] == rows["models", None] == found.count() and rows["models", "error"] >= 1
    report.import_log(found, str(tmp_path / "log"), title="orchard")
    line = json.loads(spark.read.text(str(tmp_path / "log")).first().value)
    assert line["title"] == "orchard" and line["report"]["errors"] == rows["models", "error"]
