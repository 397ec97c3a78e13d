"""Syntaxes, conversion, checks, export and comparison of graphs."""

import pytest
from documents import JSONLD, NTRIPLES, PREFIXES, TURTLE, XML
from pyspark.sql import functions as F

from sedgeline.operators import checks, closure, compare, export, rdf, serialize
from sedgeline.sources import rdf as source


def triples(spark, *docs):
    d = spark.createDataFrame([(f"d{i}.{e}", t) for i, (e, t) in enumerate(docs)], "file string, text string")
    return source.graph(source.documents_to_triples(d)).cache()


def as_set(quads):
    return {(s[0], p, o) for _, s, p, o in quads}


@pytest.mark.parametrize(("fmt", "text"), [("nt", NTRIPLES), ("xml", XML), ("json-ld", JSONLD), ("n3", TURTLE), ("trig", TURTLE), ("trig", PREFIXES + "GRAPH :g {" + TURTLE.split("xsd: <http://www.w3.org/2001/XMLSchema#> .")[1].strip().rstrip(".") + "}")])
def test_same_graph_in_all_syntaxes(fmt, text):
    want = as_set(source.parse(TURTLE, "turtle"))
    assert len(want) == 16 and as_set(source.parse(text, fmt)) == want


def test_lines_in_functions_and_python_agree(spark):
    more = '_:b <http://p> "a\\"b\\u00e9\\n"^^<http://t> <http://g> .\n<http://s> <http://p> _:c .\n<http://s> <http://p> "" .\nbroken line\n'
    text = NTRIPLES + more
    lines = spark.createDataFrame([("f", x) for x in text.splitlines()], "file string, line string")
    got = {(r.s, r.p, (r.o, r.o_kind, r.o_datatype, r.o_lang)) for r in source.lines_to_triples(lines).collect()}
    assert got == as_set(source.parse(text.replace("broken line\n", ""), "nquads"))
    assert [r.fault for r in source.line_faults(lines).collect()] == ["syntax error: broken line"]


def test_other_syntaxes():
    trix = '<TriX xmlns="http://www.w3.org/2004/03/trix/trix-1/"><graph><uri>http://g</uri><triple><uri>http://s</uri><uri>http://p</uri><plainLiteral xml:lang="en">x</plainLiteral></triple></graph></TriX>'
    assert source.parse(trix, "trix") == [("http://g", ("http://s", "iri", None, None), "http://p", ("x", "literal", None, "en"))]
    hext = '["http://s", "http://p", "5", "http://www.w3.org/2001/XMLSchema#integer", "", ""]\n["_:a", "http://p", "http://o", "globalId", "", "http://g"]'
    assert [q[3][0] for q in source.parse(hext, "hext")] == ["5", "http://o"]
    page = '<div vocab="http://schema.org/" typeof="Person" resource="#me"><span property="name">Ann &amp; Bo</span><a property="url" href="http://x/">x</a></div>'
    assert {(p, o[0]) for _, _, p, o in source.parse(page, "rdfa")} == {("http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "http://schema.org/Person"), ("http://schema.org/name", "Ann & Bo"), ("http://schema.org/url", "http://x/")}
    micro = '<div itemscope itemtype="http://schema.org/Thing"><b itemprop="name">N</b><link itemprop="sameAs" href="http://y/"></div>'
    assert {(p, o[0]) for _, _, p, o in source.parse(micro, "microdata")} == {("http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "http://schema.org/Thing"), ("http://schema.org/name", "N"), ("http://schema.org/sameAs", "http://y/")}


def test_turtle_details():
    got = source.parse('@prefix : <http://e/> . :s :p 1, 1.5, 1e3, true, "a"@en-GB, """x "y" z""", [ :q (1 :o) ] . :t.u :v :w.', "turtle")
    values = [o[0] for _, s, p, o in got if s[0] == "http://e/s"]
    assert values[:6] == ["1", "1.5", "1e3", "true", "a", 'x "y" z'] and ("http://e/t.u", "http://e/v", ("http://e/w", "iri", None, None)) in as_set(got)
    for bad in (":s :p :o .", '<a> <b> "x', "<a> <b> .", "<a> <b> <c>"):
        with pytest.raises(ValueError):
            source.parse(bad, "turtle")


def test_faults_stay_with_their_document(spark):
    d = spark.createDataFrame([("a.ttl", "broken <"), ("b.nt", NTRIPLES), ("c.ttl", "")], "file string, text string")
    t = source.documents_to_triples(d)
    assert {r.file for r in checks.faults(t).collect()} == {"a.ttl", "c.ttl"} and source.graph(t).select("file").distinct().count() == 1


def test_formats(spark):
    assert source.resolve_format("OWL ") == "xml" and source.resolve_format(None, "x.jsonld") == "json-ld" and source.resolve_format(None, "x") == "turtle"
    with pytest.raises(ValueError):
        source.resolve_format("pdf")
    df = spark.createDataFrame([("ttl", "a.nt"), (None, "a.nq"), (None, "b"), ("", "c.rdf")], "f string, p string")
    assert [r[0] for r in df.select(source.resolved(F.col("f"), F.col("p"))).collect()] == ["turtle", "nquads", "turtle", "xml"]


def test_conversion(spark):
    t = triples(spark, ("ttl", TURTLE), ("nt", NTRIPLES))
    c = rdf.convert(t)
    for file in ("d0.ttl", "d1.nt"):
        e = {r.name: r for r in c.entities.where(F.col("file") == file).collect()}
        assert sorted(e) == ["Animal", "Bird", "Keeper"] and [e[k].id for k in sorted(e)] == ["1000000000001", "1000000000002", "1000000000003"]
        assert e["Bird"].baseEntityTypeId == e["Animal"].id and e["Keeper"].displayNamePropertyId == "1000000000005" and e["Animal"].entityIdParts == ["1000000000004"]
        r = c.relationships.where(F.col("file") == file).collect()
        assert [(x.name, x.id, x.source_id, x.target_id) for x in r] == [("feeds", "1000000000006", e["Keeper"].id, e["Animal"].id)]
    assert {(r.name, r.valueType) for r in c.properties.collect()} == {("age", "BigInt"), ("fullName", "String")}
    assert {r.ontology for r in rdf.ontology_names(t).collect()} == {"Zoo_of_9"}
    parts = serialize.definition_parts(c.entities, c.properties, c.relationships, rdf.ontology_names(t)).where("file = 'd0.ttl'").orderBy("ord").collect()
    assert [p.path.split("/")[0] for p in parts] == [".platform", "definition.json", "EntityTypes", "EntityTypes", "EntityTypes", "RelationshipTypes"]
    assert [p.path.split("/")[1] for p in parts[2:5]] == ["1000000000001", "1000000000003", "1000000000002"]  # parents first


def test_payloads_and_round_trip(spark):
    import base64
    import json

    t = triples(spark, ("ttl", TURTLE))
    c = rdf.convert(t)
    parts = serialize.definition_parts(c.entities, c.properties, c.relationships, rdf.ontology_names(t)).cache()
    for p in parts.collect():
        raw = base64.b64decode(p.payload).decode()
        assert json.dumps(json.loads(raw), indent=2, ensure_ascii=False) == raw
    e, p, r = serialize.relations_of(parts)
    assert {x.name for x in e.collect()} == {"Animal", "Bird", "Keeper"} and p.count() == 2 and r.count() == 1
    back = export.triples_of(e, p, r, rdf.ontology_names(t))
    text = export.turtle(back).first().text
    again = triples(spark, ("ttl", text))
    assert compare.differences(t, again).count() == 0 and all(x.equal for x in compare.summary(t, again).collect())
    lines = "\n".join(x.line for x in export.ntriples(back).collect())
    assert as_set(source.parse(lines, "nt")) == as_set(source.parse(text, "turtle"))
    severities = {(x.severity, x.code) for x in checks.payload_issues(parts).collect()}
    assert severities == {("warning", "parent")}


def test_checks(spark):
    text = PREFIXES + """
:A a owl:Class ; rdfs:subClassOf [ a owl:Restriction ; owl:onProperty :p ; owl:minCardinality 1 ] .
:p a owl:DatatypeProperty . :q a owl:ObjectProperty, owl:TransitiveProperty ; rdfs:domain :A ; rdfs:range :B .
:r a owl:DatatypeProperty ; rdfs:domain :A ; rdfs:range xsd:hexBinary . <http://o> owl:imports <http://x> .
:i a owl:NamedIndividual . :A owl:disjointWith :B ; owl:equivalentClass [ owl:complementOf :B ] .
"""
    t = triples(spark, ("ttl", text))
    got = {(r.severity, r.category, r.code) for r in checks.preflight(t).collect()}
    assert got == {("warning", "property_restriction", "restriction"), ("warning", "missing_signature", "missing_signature"), ("warning", "missing_signature", "undeclared_end"), ("info", "property_characteristic", "characteristic"), ("info", "unsupported_datatype", "datatype"), ("warning", "external_import", "imports"), ("info", "individual", "count"), ("info", "unsupported_construct", "class_axiom"), ("warning", "unsupported_construct", "class_expression")}
    r = checks.report(checks.preflight(t)).first()
    assert r.errors == 0 and not r.seamless and checks.report(checks.strict(checks.preflight(t))).first().errors == r.warnings
    assert {x.code for x in checks.owl_compliance(t).collect()} >= {"OWL001", "OWL010", "OWL020", "OWL021", "OWL022", "OWL030", "OWL031", "OWL040"}
    rep = checks.feature_report(checks.features(t)).first()
    assert rep.none >= 5 and rep.full >= 5
    assert "restriction on p" in checks.readable(checks.preflight(t)).first().text


def test_class_expressions_and_lists(spark):
    text = PREFIXES + """
:A a owl:Class . :B a owl:Class . :C a owl:Class .
:p a owl:DatatypeProperty ; rdfs:range xsd:string ; rdfs:domain [ a owl:Class ; owl:unionOf ( :A [ owl:intersectionOf ( :B :C ) ] :A ) ] .
:u a owl:DatatypeProperty ; rdfs:domain :A ; rdfs:range [ owl:unionOf ( xsd:string xsd:integer ) ] .
"""
    t = triples(spark, ("ttl", text))
    from sedgeline.plans.lens import OWL, RDF

    got = closure.class_members(t, RDF, OWL).collect()
    by = {}
    for r in sorted(got, key=lambda r: r.i):
        by.setdefault(r.expression, []).append(r["class"].rsplit("#")[-1])
    assert sorted(by.values(), key=len) == [["B", "C"], ["string", "integer"], ["A", "B", "C", "A"]] or sorted(map(tuple, by.values())) == sorted([("B", "C"), ("string", "integer"), ("A", "B", "C", "A")])
    on = rdf.attached(t, rdf.data_properties(t)).collect()
    assert {(r["class"].rsplit("#")[-1], r.prop.rsplit("#")[-1], r.valueType) for r in on} == {("A", "p", "String"), ("B", "p", "String"), ("C", "p", "String"), ("A", "u", "BigInt")}


def test_cycles_and_orders(spark):
    e = spark.createDataFrame([("f", "a", "b"), ("f", "b", "c"), ("f", "x", "y"), ("f", "y", "x"), ("f", "z", "x"), ("f", "d", "b"), ("f", "d", "c")], "file string, child string, parent string")
    nodes = spark.createDataFrame([("f", n) for n in "abcdxyz"], "file string, node string")
    up = closure.ancestors(e)
    assert {r.node for r in closure.on_cycle(up).collect()} == {"x", "y"} and {r.node for r in closure.reaches_cycle(up).collect()} == {"x", "y", "z"}
    assert {r.node: r.depth for r in closure.depths(nodes, e).collect()} == {"c": 0, "b": 1, "a": 2, "d": 2, "x": None, "y": None, "z": None}
    assert [r.node for r in closure.topological(nodes, e).orderBy("ord").collect()] == list("cbadxyz")
    assert {r.child: r.parent for r in closure.chosen_parent(e, nodes).collect()} == {"a": "b", "b": "c", "d": "b"}


def test_long_list(spark):
    from sedgeline.plans.lens import RDF

    cells = [(f"c{i}", RDF + "rest", f"c{i + 1}" if i < 149 else RDF + "nil") for i in range(150)] + [(f"c{i}", RDF + "first", f"m{i}") for i in range(150)]
    t = spark.createDataFrame([("f", s, "bnode", p, o, "iri") for s, p, o in cells], "file string, s string, s_kind string, p string, o string, o_kind string")
    got = closure.list_members(t, RDF, spark.createDataFrame([("f", "c0")], "file string, list string")).orderBy("i").collect()
    assert [r.member for r in got] == [f"m{i}" for i in range(150)]


def test_definition_checks_and_limits(spark):
    e = spark.createDataFrame([("f", "1", "A" * 30, "9", ["7"], "8"), ("f", "2", "B", None, ["p2"], "p2"), ("f", "3", "C", "3", [], None)], "file string, id string, name string, baseEntityTypeId string, entityIdParts array<string>, displayNamePropertyId string").withColumns({"namespace": F.lit("n"), "namespaceType": F.lit("Custom"), "visibility": F.lit("Visible")})
    p = spark.createDataFrame([("f", "2", 0, "p2", "x", "Double", False)], "file string, entity_id string, pos int, id string, name string, valueType string, is_timeseries boolean")
    r = spark.createDataFrame([("f", "r", "rel", "1", "77"), ("f", "q", "own", "2", "2")], "file string, id string, name string, source_id string, target_id string").withColumns({"namespace": F.lit("n"), "namespaceType": F.lit("Custom")})
    got = sorted((x.severity, x.code) for x in checks.definition_issues(e, p, r).collect())
    assert got == [("error", "dangling"), ("error", "display"), ("error", "key"), ("error", "own_parent"), ("error", "parent"), ("warning", "display_type"), ("warning", "key_type"), ("warning", "self")]
    assert [(x.severity, x.code) for x in checks.limit_issues(e, p, r).collect()] == [("error", "entity_name")]
    assert {x.code for x in checks.converted_compliance(e, p, r).collect()} == {"TGT020"}


def test_a_chain_and_a_cycle_of_150(spark):
    chain = [("f", f"c{i:03}", f"c{i + 1:03}") for i in range(149)] + [("f", "c000", "c140"), ("f", "top", "gone")]
    ring = [("g", f"r{i:03}", f"r{(i + 1) % 150:03}") for i in range(150)]
    e = spark.createDataFrame(chain + ring, "file string, child string, parent string")
    nodes = spark.createDataFrame([("f", f"c{i:03}") for i in range(150)] + [("f", "top")] + [("g", f"r{i:03}") for i in range(150)], "file string, node string")
    level = {(r.node, r.ancestor): r.level for r in closure.ancestors(e).collect()}
    # From c000 the short cut leads to c140 at once.
    want = {(f"c{i:03}", f"c{j:03}"): j - i if i or j < 140 else min(j, j - 139) for i in range(150) for j in range(i + 1, 150)} | {("top", "gone"): 1}
    want |= {(f"r{i:03}", f"r{j:03}"): (j - i) % 150 or 150 for i in range(150) for j in range(150)}
    assert level == want
    got = {r.node: r.depth for r in closure.depths(nodes, e).collect()}
    assert got == {f"c{i:03}": 149 - i for i in range(150)} | {"top": 0} | {f"r{i:03}": None for i in range(150)}
    assert {r.child for r in closure.chosen_parent(e, nodes).collect()} == {f"c{i:03}" for i in range(149)}
