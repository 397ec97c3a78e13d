"""Registered queries of single operators: documents are made from rows of the test tables, in SQL functions, and go
through the readers, converters and checks; the SQL says what must come out for each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, types, values
from ..operators import cdm, checks, closure, dtdl, export, keys, serialize
from ..sources import cdm as cdm_source
from ..sources import dtdl as dtdl_source
from ..sources import rdf as rdf_source
from . import queries as lens_queries
from .lens import OWL, RDF, RDFS, XSD
from .queries import _HASH, CLS, LOCAL, S, _columns, _sanitized, _t, _values

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _said(column: Column) -> Column:
    return column.cast("string")


# ---- names, types and values

@query(f"""SELECT page_id, {_sanitized(LOCAL.format('url'), empty='Unknown')} AS uri_name, {_sanitized('url', 'O_', 100, 'ImportedOntology')} AS ontology_name, {_sanitized('url', 'C_', 100000, 'UnnamedClass')} AS export_name,
{_sanitized('reverse(url)', 'p_', 100000, 'property')} AS decimal_name, regexp_extract(url, '([^/]*)$', 1) AS tail FROM pages""")
def q_other_names(spark, sf_dir):
    u = F.col("url")
    return _t(spark, sf_dir, "pages").select("page_id", names.uri_name(u).alias("uri_name"), names.ontology_name(u).alias("ontology_name"), names.export_name(u).alias("export_name"), names.decimal_name(F.reverse(u)).alias("decimal_name"), names.path_tail(u).alias("tail"))


@query("""WITH x AS (SELECT p_partkey, p_name, p_brand, CASE p_partkey % 6 WHEN 0 THEN 'dtmi:trade:p' || p_partkey || ';1' WHEN 1 THEN 'dtmi:trade:_p' || p_partkey || ';1' WHEN 2 THEN 'dtmi:dtdl:p' || p_partkey || ';1'
  WHEN 3 THEN 'dtmi:trade:' || repeat('a', 130) || ';2' WHEN 4 THEN 'dtmi:trade:p:q' || p_partkey ELSE 'dtmi:standard:x' || p_partkey || ';1.2' END AS d FROM part)
SELECT p_partkey, list_extract(string_split(split_part(d, ';', 1), ':'), -1) AS name, CASE p_partkey % 6 WHEN 1 THEN 'syntax' WHEN 2 THEN 'reserved' WHEN 3 THEN 'length' WHEN 5 THEN 'reserved' END AS fault,
  CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN p_brand ELSE list_extract(string_split(split_part(d, ';', 1), ':'), -1) END AS shown FROM x""")
def q_model_identifiers(spark, sf_dir):
    k = F.col("p_partkey")
    at = lambda *parts: F.concat(*[_said(p) if isinstance(p, Column) else F.lit(p) for p in parts])
    d = F.when(k % 6 == 0, at("dtmi:trade:p", k, ";1")).when(k % 6 == 1, at("dtmi:trade:_p", k, ";1")).when(k % 6 == 2, at("dtmi:dtdl:p", k, ";1")).when(k % 6 == 3, at("dtmi:trade:" + "a" * 130 + ";2")).when(k % 6 == 4, at("dtmi:trade:p:q", k)).otherwise(at("dtmi:standard:x", k, ";1.2"))
    shown = F.when(k % 5 == 0, F.create_map(F.lit("de"), F.lit("anders"), F.lit("en"), F.col("p_name"))).when(k % 5 == 1, F.create_map(F.lit("fr"), F.col("p_brand")))
    return _t(spark, sf_dir, "part").select("p_partkey", names.dtmi_name(d).alias("name"), names.dtmi_faults(d).alias("fault"), names.display_name(shown, d).alias("shown"))


_DTDL = sorted(s for ss in types.DTDL_TYPES.values() for s in ss)
_ARRAY = ", ".join(f"'{s}'" for s in _DTDL)


@query(f"""WITH m(k, v) AS (VALUES {_values(types.DTDL_TYPES)}), x AS (SELECT event_id, [{_ARRAY}, 'unheard'][event_id % {len(_DTDL) + 1} + 1] AS sch, ['primitive', 'Object', 'Enum', 'Array', 'scaledDecimal'][event_id % 5 + 1] AS kind FROM events)
SELECT event_id, CASE kind WHEN 'primitive' THEN CASE WHEN sch = 'scaledDecimal' THEN 'String' ELSE coalesce(v, 'String') END WHEN 'Enum' THEN coalesce(v, 'String') ELSE 'String' END AS target,
  CASE kind WHEN 'primitive' THEN CASE WHEN sch = 'scaledDecimal' THEN 'Double' ELSE coalesce(v, 'String') END WHEN 'Enum' THEN CASE WHEN sch = 'scaledDecimal' THEN 'Double' ELSE coalesce(v, 'String') END WHEN 'scaledDecimal' THEN 'Double' ELSE CASE WHEN sch = 'scaledDecimal' THEN 'Double' ELSE 'String' END END AS calculated,
  kind IN ('Object', 'Array') AS is_complex, kind = 'Array' AS is_array, CASE WHEN kind <> 'primitive' THEN sch END AS json_schema FROM x LEFT JOIN m ON k = sch""")
def q_model_value_types(spark, sf_dir):
    e = F.col("event_id")
    sch = F.element_at(F.array(*[F.lit(s) for s in [*_DTDL, "unheard"]]), (e % (len(_DTDL) + 1) + 1).cast("int"))
    kind = F.element_at(F.array(*[F.lit(s) for s in ("primitive", "Object", "Enum", "Array", "scaledDecimal")]), (e % 5 + 1).cast("int"))
    x = _t(spark, sf_dir, "events").select("event_id", sch.alias("sch"), kind.alias("kind"))
    rich = dtdl.rich_type(F.col("sch"), F.col("kind"), F.col("sch"), F.array().cast("array<string>"), F.lit(None).cast("string"))
    x = x.withColumn("r", rich)
    return x.select("event_id", F.col("r.type").alias("target"), dtdl.value_type(F.col("sch"), F.col("kind"), F.col("sch"), decimals="calculated").alias("calculated"), "r.is_complex", "r.is_array", "r.json_schema")


@query(f"""WITH k(n) AS (VALUES {", ".join(f"('{s}')" for ss in [*types.CDM_PRIMITIVES.values(), *types.CDM_SEMANTIC.values()] for s in ss)}), w(n) AS (VALUES {", ".join(f"('{XSD}{s}')" for ss in types.XSD_TYPES.values() for s in ss)}),
x AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'dateTime' WHEN 1 THEN 'Money' WHEN 2 THEN event_type END AS n, '{XSD}' || CASE event_id % 3 WHEN 0 THEN 'integer' WHEN 1 THEN 'hexWord' ELSE 'date' END AS u, ['String', 'BigInt', 'Decimal', 'Other'][event_id % 4 + 1] AS t FROM events)
SELECT event_id, n IS NOT NULL AND lower(n) IN (SELECT lower(n) FROM k) AS known_cdm, u IN (SELECT n FROM w) AS known_xsd, '{XSD}' || CASE t WHEN 'BigInt' THEN 'integer' WHEN 'Decimal' THEN 'decimal' ELSE 'string' END AS out_type FROM x""")
def q_known_types(spark, sf_dir):
    e = F.col("event_id")
    n = F.when(e % 4 == 0, "dateTime").when(e % 4 == 1, "Money").when(e % 4 == 2, F.col("event_type"))
    u = F.concat(F.lit(XSD), F.when(e % 3 == 0, "integer").when(e % 3 == 1, "hexWord").otherwise("date"))
    t = F.element_at(F.array(*[F.lit(s) for s in ("String", "BigInt", "Decimal", "Other")]), (e % 4 + 1).cast("int"))
    return _t(spark, sf_dir, "events").select("event_id", types.is_cdm_type(n).alias("known_cdm"), types.is_known_xsd(u).alias("known_xsd"), types.target_xsd(t).alias("out_type"))


_SOURCES = [*(XSD + s for ss in types.XSD_TYPES.values() for s in ss), *(s for ss in types.DTDL_TYPES.values() for s in ss), *(s for ss in types.CDM_PRIMITIVES.values() for s in ss), "unheard"]


@query(f"""WITH r AS (SELECT 'rdf' AS format, k AS source, v AS target, k LIKE '%decimal' AS precision_loss FROM (VALUES {_values(types.XSD_TYPES, XSD)}) r(k, v) UNION ALL
SELECT 'dtdl', k, v, k LIKE '%decimal' FROM (VALUES {_values(types.DTDL_TYPES)}) d(k, v) UNION ALL SELECT 'cdm', k, v, false FROM (VALUES {_values(types.CDM_PRIMITIVES)}) c(k, v)),
x AS (SELECT event_id, ['rdf', 'dtdl', 'cdm'][event_id % 3 + 1] AS format, [{", ".join(f"'{s}'" for s in _SOURCES)}][event_id // 3 % {len(_SOURCES)} + 1] AS source FROM events)
SELECT event_id, format, source, target, precision_loss FROM x LEFT JOIN r USING (format, source)""")
def q_type_registry(spark, sf_dir):
    """Types of values by format, looked up in the registry; a type of another format is not known."""
    e = F.col("event_id")
    x = _t(spark, sf_dir, "events").select("event_id", F.element_at(F.array(*[F.lit(f) for f in ("rdf", "dtdl", "cdm")]), (e % 3 + 1).cast("int")).alias("format"), F.element_at(F.array(*[F.lit(s) for s in _SOURCES]), (F.floor(e / 3) % len(_SOURCES) + 1).cast("int")).alias("source"))
    return x.join(F.broadcast(types.default_registry().table(spark)), ["format", "source"], "left").select("event_id", "format", "source", "target", "precision_loss")


@query("""SELECT l_orderkey, l_linenumber, '{"scale":' || (l_linenumber % 4) || ',"value":"' || l_quantity::BIGINT || '"}' AS as_json, l_linenumber % 4 AS scale, l_quantity::BIGINT::VARCHAR AS value, round(l_quantity::BIGINT * power(10.0, (l_linenumber % 4)::DOUBLE), 6) AS calculated FROM lineitem""")
def q_scaled_modes(spark, sf_dir):
    v, s = F.col("l_quantity").cast("long"), F.col("l_linenumber").cast("long") % 4
    one = values.scaled_text(v, s, "structured")
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", values.scaled_text(v, s, "json_string").alias("as_json"), one["scale"].alias("scale"), one["value"].alias("value"), F.round(values.scaled_text(v.cast("string"), s, "calculated").cast("double"), 6).alias("calculated"))


@query("""WITH x AS (SELECT event_id, ['means.identity.entityId', 'means.identity.name', 'is.dataFormat.integer', 'is.constrained.length', 'other.trait'][event_id % 5 + 1] AS ref, ['identifiedBy', 'namedBy', 'hasA'][event_id % 3 + 1] AS purpose FROM events)
SELECT event_id, ref = 'means.identity.entityId' OR purpose = 'identifiedBy' AS is_key, ref = 'means.identity.name' OR purpose = 'namedBy' AS is_display,
  CASE WHEN ref LIKE 'is.dataFormat%' THEN 'format' WHEN ref LIKE 'means.%' THEN 'meaning' WHEN ref LIKE 'is.constrained%' THEN 'constraint' END AS trait_class FROM x""")
def q_business_markers(spark, sf_dir):
    e = F.col("event_id")
    pick = lambda n, *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (e % n + 1).cast("int"))
    ref = pick(5, "means.identity.entityId", "means.identity.name", "is.dataFormat.integer", "is.constrained.length", "other.trait")
    x = _t(spark, sf_dir, "events").select("event_id", F.array(F.struct(ref.alias("ref"))).alias("traits"), pick(3, "identifiedBy", "namedBy", "hasA").alias("purpose"))
    return x.select("event_id", cdm.is_key().alias("is_key"), cdm.is_display().alias("is_display"), cdm.trait_class(F.col("traits")[0]["ref"]).alias("trait_class"))


@query("""SELECT page_id, url LIKE '%://%' AS is_url, CASE page_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'private' WHEN 2 THEN 'domain' WHEN 3 THEN 'scheme' ELSE 'port' END AS private_fault, page_id % 5 = 1 AS private FROM pages""")
def q_source_addresses(spark, sf_dir):
    """Addresses of sources: what keeps them from being fetched."""
    k = F.col("page_id") % 5
    u = F.when(k == 0, "https://www.example.org/a").when(k == 1, "https://10.1.2.3/a").when(k == 2, "https://www.example.com/a").when(k == 3, "ftp://www.example.org/a").otherwise("https://www.example.org:9999/a")
    fault = F.when(k == 1, values.url_fault(u)).otherwise(values.url_fault(u, hosts=("example.org",)))
    return _t(spark, sf_dir, "pages").select("page_id", values.is_url(F.col("url")).alias("is_url"), fault.alias("private_fault"), values.is_private_host(values.host_of(u)).alias("private"))


# ---- readers

EX = "http://ex.org/n#"
#: The same three triples of one nation in each syntax; {k} is its key and {r} its region's.
SYNTAXES = {
    "turtle": '@prefix x: <http://ex.org/n#> . x:n{k} a x:Nation ; x:in x:r{r} ; x:called "nation {k}"@en .',
    "n3": '@prefix x: <http://ex.org/n#> . x:n{k} a x:Nation . x:n{k} x:in x:r{r} . x:n{k} x:called "nation {k}"@en .',
    "trig": '@prefix x: <http://ex.org/n#> . x:g {{ x:n{k} a x:Nation ; x:in x:r{r} . }} x:n{k} x:called "nation {k}"@en .',
    "nt": '<http://ex.org/n#n{k}> <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <http://ex.org/n#Nation> .\n<http://ex.org/n#n{k}> <http://ex.org/n#in> <http://ex.org/n#r{r}> .\n# end\n<http://ex.org/n#n{k}> <http://ex.org/n#called> "nation {k}"@en .',
    "nquads": '<http://ex.org/n#n{k}> <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <http://ex.org/n#Nation> <http://ex.org/n#g> .\n<http://ex.org/n#n{k}> <http://ex.org/n#in> <http://ex.org/n#r{r}> .\n<http://ex.org/n#n{k}> <http://ex.org/n#called> "nation {k}"@en .',
    "xml": '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:x="http://ex.org/n#"><x:Nation rdf:about="http://ex.org/n#n{k}"><x:in rdf:resource="http://ex.org/n#r{r}"/><x:called xml:lang="en">nation {k}</x:called></x:Nation></rdf:RDF>',
    "json-ld": '{{"@context": {{"x": "http://ex.org/n#"}}, "@id": "x:n{k}", "@type": "x:Nation", "x:in": {{"@id": "x:r{r}"}}, "x:called": {{"@value": "nation {k}", "@language": "en"}}}}',
    "trix": '<TriX xmlns="http://www.w3.org/2004/03/trix/trix-1/"><graph><triple><uri>http://ex.org/n#n{k}</uri><uri>http://www.w3.org/1999/02/22-rdf-syntax-ns#type</uri><uri>http://ex.org/n#Nation</uri></triple><triple><uri>http://ex.org/n#n{k}</uri><uri>http://ex.org/n#in</uri><uri>http://ex.org/n#r{r}</uri></triple><triple><uri>http://ex.org/n#n{k}</uri><uri>http://ex.org/n#called</uri><plainLiteral xml:lang="en">nation {k}</plainLiteral></triple></graph></TriX>',
    "hext": '["http://ex.org/n#n{k}", "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "http://ex.org/n#Nation", "globalId", "", ""]\n["http://ex.org/n#n{k}", "http://ex.org/n#in", "http://ex.org/n#r{r}", "globalId", "", ""]\n["http://ex.org/n#n{k}", "http://ex.org/n#called", "nation {k}", "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString", "en", ""]',
}


def _syntax_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _t(spark, sf_dir, "nation").select(_said(F.col("n_nationkey")).alias("k"), _said(F.col("n_regionkey")).alias("r"))
    fill = lambda text: F.replace(F.replace(F.lit(text.replace("{{", "{").replace("}}", "}")), F.lit("{k}"), F.col("k")), F.lit("{r}"), F.col("r"))
    forms = F.explode(F.array(*[F.struct(F.lit(f).alias("fmt"), fill(t).alias("text")) for f, t in SYNTAXES.items()]))
    return n.select("k", forms.alias("x")).select(F.concat("x.fmt", F.lit("/"), "k").alias("file"), "x.fmt", "x.text")


@query(f"""WITH f(fmt) AS (VALUES {", ".join(f"('{f}')" for f in SYNTAXES)}) SELECT fmt || '/' || n_nationkey AS file, '{EX}n' || n_nationkey AS s, p, CASE i WHEN 0 THEN '{EX}Nation' WHEN 1 THEN '{EX}r' || n_regionkey ELSE 'nation ' || n_nationkey END AS o, CASE WHEN i = 2 THEN 'literal' ELSE 'iri' END AS o_kind, CASE WHEN i = 2 THEN 'en' END AS o_lang
FROM nation, f, (VALUES (0, '{RDF}type'), (1, '{EX}in'), (2, '{EX}called')) x(i, p)""")
def q_syntaxes(spark, sf_dir):
    """The same graph in nine syntaxes, read to the same triples."""
    t = rdf_source.documents_to_triples(_syntax_documents(spark, sf_dir), fmt=F.col("fmt"))
    return rdf_source.graph(t).select("file", "s", "p", "o", "o_kind", "o_lang")


@query("""SELECT 'f' || (s_suppkey % 7) AS file, 'syntax error: no triple ' || s_suppkey AS fault FROM supplier WHERE s_suppkey % 3 = 0""")
def q_line_faults(spark, sf_dir):
    k = F.col("s_suppkey")
    line = F.when(k % 3 == 0, F.concat(F.lit("no triple "), _said(k))).when(k % 3 == 1, F.lit("# a comment")).otherwise(F.concat(F.lit("<http://ex.org/a"), _said(k), F.lit('> <http://ex.org/p> "v" .')))
    return rdf_source.line_faults(_t(spark, sf_dir, "supplier").select(F.concat(F.lit("f"), _said(k % 7)).alias("file"), line.alias("line")))


# ---- digital-twin models

def _per_nation(spark: SparkSession, sf_dir: str, text: str, suffix: str = "") -> DataFrame:
    """A document for each nation: {k} stands for its key."""
    k = _said(F.col("n_nationkey"))
    return _t(spark, sf_dir, "nation").select(F.concat(F.lit("n"), k, F.lit(suffix)).alias("file"), F.replace(F.lit(text), F.lit("{k}"), k).alias("text"), F.col("n_nationkey").alias("key"))


FLEET = """[{"@context": "dtmi:dtdl:context;3", "@id": "dtmi:fleet:quay{k};1", "@type": "Interface", "contents": [{"@type": "Property", "name": "depth", "schema": "double"}]},
{"@context": "dtmi:dtdl:context;3", "@id": "dtmi:fleet:ship{k};1", "@type": "Interface", "contents": [
{"@type": "Component", "name": "home", "schema": "dtmi:fleet:quay{k};1"}, {"@type": "Command", "name": "sail", "request": {"name": "until", "schema": "integer"}},
{"@type": "Property", "name": "cargo", "schema": "scaledDecimal"}, {"@type": "Telemetry", "name": "speed", "schema": "float"}, {"@type": "Relationship", "name": "visits", "target": "dtmi:fleet:quay{k};1"}]}]"""
_QUAY, _SHIP = _HASH.format("'fleet:quay' || n_nationkey"), _HASH.format("'fleet:ship' || n_nationkey")


def _fleet(spark, sf_dir):
    return dtdl_source.parse(_per_nation(spark, sf_dir, FLEET))


@query("""SELECT 'n' || n_nationkey AS file, e || n_nationkey AS entity, p AS name, t AS "valueType" FROM nation, (VALUES ('quay', 'depth', 'Double'), ('ship', 'home_depth', 'Double'), ('ship', 'cargo', 'String'), ('ship', 'cargo_scale', 'BigInt'), ('ship', 'cargo_value', 'String'), ('ship', 'command_sail', 'String'), ('ship', 'speed', 'Double')) x(e, p, t)""")
def q_model_flattened(spark, sf_dir):
    """Components flattened, commands as properties, scaled decimals with two properties more."""
    c = dtdl.convert(_fleet(spark, sf_dir), components="flatten", commands="property", decimals="structured")
    return c.properties.join(c.entities.select("file", F.col("id").alias("entity_id"), F.col("name").alias("entity")), ["file", "entity_id"]).select("file", "entity", "name", "valueType")


@query(f"""WITH x AS (SELECT 'n' || n_nationkey AS file, {_SHIP} AS ship, {_QUAY} AS quay, {_HASH.format("'fleet:ship' || n_nationkey || ':cmd:sail'")} AS sail FROM nation)
SELECT file, 'visits' AS name, ship AS source, quay AS target FROM x UNION ALL SELECT file, 'has_home', ship, quay FROM x UNION ALL SELECT file, 'supports_sail', ship, sail FROM x""")
def q_model_separate(spark, sf_dir):
    """Components and commands as relationships to entities of their own."""
    c = dtdl.convert(_fleet(spark, sf_dir), components="separate", commands="entity")
    return c.relationships.select("file", "name", F.col("source_id").alias("source"), F.col("target_id").alias("target"))


@query(f"""SELECT 'n' || n_nationkey AS file, 'dtmi:fleet:' || w || n_nationkey || ';1' AS dtmi, CASE w WHEN 'ship' THEN {_SHIP} ELSE {_QUAY} END AS id FROM nation, (VALUES ('ship'), ('quay')) x(w)""")
def q_model_mapping(spark, sf_dir):
    return dtdl.id_mapping(_fleet(spark, sf_dir)).select("file", F.explode("mapping").alias("dtmi", "id"))


@query("""WITH x AS (SELECT p_partkey % 40 AS owner, p_size % 5 AS prop, 'T' || (p_partkey % 3) AS vt, p_partkey FROM part), o AS (SELECT DISTINCT ON (owner, prop) * FROM x ORDER BY owner, prop, p_partkey),
f AS (SELECT *, first_value(vt) OVER (PARTITION BY prop ORDER BY owner) AS ft FROM o),
u AS (SELECT f.*, (SELECT g.vt FROM o g WHERE g.prop = f.prop AND g.owner = f.owner // 2 AND f.owner >= 2) AS pt, (SELECT g.vt FROM o g WHERE g.prop = f.prop AND g.owner = f.owner // 4 AND f.owner >= 4) AS gt FROM f)
SELECT 'd' || owner AS dtmi, 'p' || prop AS plain, CASE WHEN coalesce(gt, pt, vt) <> vt OR ft <> vt THEN 'p' || prop || '_' || lower(vt) ELSE 'p' || prop END AS shown FROM u""")
def q_name_conflicts(spark, sf_dir):
    """Properties of owners whose parent is half their number and whose grandparent a quarter of it."""
    x = _t(spark, sf_dir, "part").select((F.col("p_partkey") % 40).alias("owner"), (F.col("p_size") % 5).alias("prop"), F.col("p_partkey"), F.concat(F.lit("T"), _said(F.col("p_partkey") % 3)).alias("valueType"))
    x = x.groupBy("owner", "prop").agg(F.min_by("valueType", "p_partkey").alias("valueType"))
    d = lambda c: F.concat(F.lit("d"), _said(c.cast("long")))
    props = x.select(F.lit("f").alias("file"), d(F.col("owner")).alias("dtmi"), F.concat(F.lit("p"), _said(F.col("prop"))).alias("name"), "valueType", F.lit(0).alias("phase"), F.col("prop").alias("pos"))
    owners = spark.range(40).select(F.col("id").alias("owner"))
    order = owners.select(F.lit("f").alias("file"), d(F.col("owner")).alias("node"), F.col("owner").alias("ord"))
    up = owners.select(F.lit("f").alias("file"), d(F.col("owner")).alias("node"), F.explode(F.array(F.struct(F.when(F.col("owner") >= 2, F.floor(F.col("owner") / 2)).alias("a"), F.lit(1).alias("level")), F.struct(F.when(F.col("owner") >= 4, F.floor(F.col("owner") / 4)).alias("a"), F.lit(2).alias("level")))).alias("x"))
    up = up.where("x.a is not null").select("file", "node", d(F.col("x.a")).alias("ancestor"), "x.level")
    shown = dtdl.resolved_names(props, up, order)
    return shown.select("dtmi", F.concat(F.lit("p"), _said(F.col("pos"))).alias("plain"), "shown")


#: A fault in each fifth nation's model.
FAULTY = [
    ("", '{"@context": "dtmi:dtdl:context;3", "@id": "dtmi:f:a{k};1", "@type": "Interface", "contents": [{"@type": "Property", "name": "x", "schema": "long"}, {"@type": "Property", "name": "x", "schema": "long"}]}', ("error", "name_twice")),
    ("", '{"@context": "dtmi:dtdl:context;3", "@id": "dtmi:f:a{k};1", "@type": "Interface", "contents": [{"@type": "Property", "name": "_x", "schema": "long"}]}', ("error", "name")),
    ("", '{"@context": "dtmi:dtdl:context;3", "@id": "dtmi:f:a{k};1", "@type": "Interface", "extends": "dtmi:f:b;1"}', ("warning", "parent")),
    ("", '{"@context": "dtmi:dtdl:context;3", "@id": "dtmi:f:a{k};1", "@type": "Interface", "contents": [{"@type": "Property", "name": "x", "schema": "strange"}, {"@type": "Relationship", "name": "r", "target": "dtmi:f:c;1"}]}', ("warning", "schema"), ("warning", "target")),
    ("", '{"@context": "dtmi:dtdl:context;9", "@id": "dtmi:f:a{k};1", "@type": "Interface", "contents": [{"@type": "Relationship", "name": "r", "maxMultiplicity": 0}]}', ("warning", "version"), ("error", "multiplicity")),
]


def _faulty(spark, sf_dir):
    docs = [_per_nation(spark, sf_dir, text).where(F.col("key") % 5 == i) for i, (_, text, *_) in enumerate(FAULTY)]
    all_ = docs[0]
    for d in docs[1:]:
        all_ = all_.unionByName(d)
    return dtdl_source.parse(all_)


@query("SELECT 'n' || n_nationkey AS file, severity, code FROM nation JOIN (VALUES " + ", ".join(f"({i}, '{s}', '{c}')" for i, (_, _, *found) in enumerate(FAULTY) for s, c in found) + ") x(i, severity, code) ON n_nationkey % 5 = i")
def q_model_issues(spark, sf_dir):
    return dtdl.issues(_faulty(spark, sf_dir)).select("file", "severity", "code")


@query("SELECT 'p' || p_partkey AS file, code FROM part JOIN (VALUES (0, 'DTDL001'), (1, 'DTDL002'), (2, 'DTDL003'), (3, 'DTDL004'), (4, 'DTDL010'), (5, 'DTDL020'), (5, 'DTDL022'), (5, 'DTDL022'), (5, 'DTDL022'), (6, 'DTDL030'), (7, 'DTDL031')) x(i, code) ON p_partkey % 9 = i")
def q_model_compliance(spark, sf_dir):
    """A model for each part, with a fault by its number."""
    k = F.col("p_partkey") % 9
    named = lambda name: F.concat(F.lit('"contents": [{"@type": "Property", "name": "'), name, F.lit('", "schema": "long"}]'))
    dtmi = F.when(k == 1, F.concat(F.lit("urn:part:"), _said(F.col("p_partkey")))).when(k == 2, F.concat(F.lit("dtmi:part:"), F.repeat(F.lit("ab:"), 50), F.lit("c;1"))).when(k == 3, "dtmi:part:_own:x;1").when(k == 4, F.concat(F.lit("dtmi:part:"), F.repeat(F.lit("n"), 70), F.lit(";1"))).otherwise(F.concat(F.lit("dtmi:part:p"), _said(F.col("p_partkey")), F.lit(";1")))
    more = F.when(k == 5, F.lit('"extends": ["dtmi:f:a;1", "dtmi:f:b;1", "dtmi:f:c;1"]')).when(k == 6, named(F.repeat(F.lit("a"), 70))).when(k == 7, named(F.concat(F.lit("9"), F.regexp_replace("p_brand", "[^A-Za-z0-9]", "_")))).otherwise(named(F.lit("size")))
    text = F.concat(F.lit('{"@context": "dtmi:dtdl:context;2", '), F.when(k == 0, "").otherwise(F.concat(F.lit('"@id": "'), dtmi, F.lit('", '))), F.lit('"@type": "Interface", '), more, F.lit("}"))
    docs = _t(spark, sf_dir, "part").select(F.concat(F.lit("p"), _said(F.col("p_partkey"))).alias("file"), text.alias("text"))
    return dtdl.compliance(dtdl_source.parse(docs)).select("file", "code")


@query("""WITH RECURSIVE n AS (SELECT DISTINCT p_size % 40 AS k FROM part), w(k, d) AS (SELECT k, 0 FROM n UNION SELECT n.k, w.d + 1 FROM w JOIN n ON n.k - w.k IN (1, 2) WHERE w.d <= 12)
SELECT 'd' || k AS node, 'depth' AS code FROM w GROUP BY k HAVING max(d) > 12 UNION ALL SELECT 'd' || k, 'DTDL021' FROM w GROUP BY k HAVING max(d) >= 10""")
def q_model_depths(spark, sf_dir):
    """Models that extend the one and the two before them, by sizes of parts: the longest way counts."""
    k = _t(spark, sf_dir, "part").select((F.col("p_size") % 40).cast("int").alias("k")).distinct()
    ups = k.select("k").join(k.select(F.col("k").alias("u")), F.col("k").between(F.col("u") + 1, F.col("u") + 2), "left").groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_list("u")), lambda u: F.concat(F.lit('"dtmi:trade:d'), u.cast("string"), F.lit(';1"'))), ", ").alias("ups"))
    text = F.concat(F.lit('{"@context": "dtmi:dtdl:context;3", "@id": "dtmi:trade:d'), _said(F.col("k")), F.lit(';1", "@type": "Interface", "extends": ['), "ups", F.lit("]}"))
    m = dtdl_source.parse(ups.select(F.lit("sizes").alias("file"), text.alias("text")))
    found = dtdl.issues(m).where("code = 'depth'").unionByName(dtdl.compliance(m).where("code = 'DTDL021'"))
    return found.select(names.dtmi_name(F.col("uri")).alias("node"), "code")


@query("SELECT 'n' || n_nationkey AS file, 5::BIGINT AS \"full\", 3::BIGINT AS partial, 1::BIGINT AS none, 0::BIGINT AS unknown FROM nation")
def q_model_support(spark, sf_dir):
    """Constructs of the models by what becomes of them."""
    return checks.feature_report(dtdl.features(_fleet(spark, sf_dir)), checks.MODEL_SUPPORT).select("file", *(F.col(c).cast("long").alias(c) for c in ("full", "partial", "none", "unknown")))


# ---- business data

LEDGER = """{"definitions": [{"entityName": "Account", "hasAttributes": [{"name": "number", "dataType": "int64", "purpose": "identifiedBy"}, {"name": "holder", "dataType": "string", "appliedTraits": ["means.identity.name"]}]},
{"entityName": "Savings{k}", "extendsEntity": "Account", "hasAttributes": [{"name": "rate", "dataType": "double"}, {"name": "holder", "dataType": "guid"}]}]}"""


@query("""SELECT 'n' || n_nationkey || '.cdm.json' AS file, CASE e WHEN 'Account' THEN e ELSE e || n_nationkey END AS entity, p AS name, t AS "valueType", e <> 'Account' AS is_child FROM nation,
(VALUES ('Account', 'number', 'BigInt'), ('Account', 'holder', 'String'), ('Savings', 'number', 'BigInt'), ('Savings', 'rate', 'Double'), ('Savings', 'holder', 'String')) x(e, p, t)""")
def q_business_inheritance(spark, sf_dir):
    """Attributes with those of the base, the nearer one where both have a name."""
    c = cdm.convert(cdm_source.parse(_per_nation(spark, sf_dir, LEDGER, ".cdm.json")))
    e = c.entities.select("file", F.col("id").alias("entity_id"), F.col("name").alias("entity"))
    return c.properties.join(e, ["file", "entity_id"]).select("file", "entity", "name", "valueType", (F.col("entity") != "Account").alias("is_child"))


@query("""SELECT 'n' || n_nationkey || '.cdm.json' AS file, CASE e WHEN 'Account' THEN e ELSE e || n_nationkey END AS entity, k AS key, d AS display FROM nation, (VALUES ('Account', 'number', 'holder'), ('Savings', 'number', NULL)) x(e, k, d)""")
def q_business_keys(spark, sf_dir):
    c = cdm.convert(cdm_source.parse(_per_nation(spark, sf_dir, LEDGER, ".cdm.json")))
    p = c.properties.select("file", F.col("id").alias("pid"), "name")
    of = lambda col, name: p.select("file", F.col("pid").alias(col), F.col("name").alias(name))
    e = c.entities.select("file", F.col("name").alias("entity"), F.get("entityIdParts", F.lit(0)).alias("k"), F.col("displayNamePropertyId").alias("d"))
    return e.join(of("k", "key"), ["file", "k"], "left").join(of("d", "display"), ["file", "d"], "left").select("file", "entity", "key", "display")


@query("""SELECT 'n' || n_nationkey || '.cdm.json' AS file, severity, code FROM nation JOIN (VALUES (0, 'error', 'attribute_twice'), (1, 'warning', 'type'), (1, 'warning', 'blank'), (2, 'warning', 'base'), (2, 'info', 'bare'), (3, 'error', 'cycle'), (3, 'error', 'cycle'), (3, 'info', 'bare'), (3, 'info', 'bare')) x(i, severity, code) ON n_nationkey % 4 = i""")
def q_business_issues(spark, sf_dir):
    one = lambda i, *entities: _per_nation(spark, sf_dir, '{"definitions": [%s]}' % ", ".join(entities), ".cdm.json").where(F.col("key") % 4 == i)
    docs = one(0, '{"entityName": "Bill", "hasAttributes": [{"name": "due", "dataType": "date"}, {"name": "due", "dataType": "date"}]}')
    docs = docs.unionByName(one(1, '{"entityName": "Bill", "hasAttributes": [{"name": "due on", "dataType": "unheardOf"}]}'))
    docs = docs.unionByName(one(2, '{"entityName": "Bill", "extendsEntity": "Paper", "hasAttributes": []}'))
    docs = docs.unionByName(one(3, '{"entityName": "Bill", "extendsEntity": "Note", "hasAttributes": []}', '{"entityName": "Note", "extendsEntity": "Bill", "hasAttributes": []}'))
    return cdm.issues(cdm_source.parse(docs)).select("file", "severity", "code")


# ---- keys, orders, definitions

@query("WITH " + lens_queries.COLS + """, s AS (SELECT entity_id AS id, arg_min(id, pos) AS one, arg_min(id, CASE WHEN contains(lower(name), 'name') THEN 0 ELSE 1000000000::BIGINT END + pos) AS named FROM p WHERE vt = 'String' GROUP BY entity_id),
k AS (SELECT entity_id AS id, arg_min(id, pos) AS key, arg_min(vt, pos) AS kt FROM p WHERE vt IN ('String', 'BigInt') GROUP BY entity_id)
SELECT k.id, k.key, true AS changed, CASE WHEN kt = 'String' THEN key ELSE named END AS display FROM k LEFT JOIN s USING (id)""")
def q_filled_keys(spark, sf_dir):
    """Key parts filled in where there are none, then display properties."""
    p = _columns(spark, sf_dir)
    e = p.select("file", F.col("entity_id").alias("id"), F.col("entity_id").alias("name"), F.array().cast("array<string>").alias("entityIdParts")).distinct()
    filled = keys.infer_all(p, e, strategy="first_valid")
    shown = keys.display_names(p, filled)
    return filled.join(shown, ["file", "id"]).select("id", F.get("entityIdParts", F.lit(0)).alias("key"), "changed", F.col("displayNamePropertyId").alias("display"))


@query("""WITH n AS (SELECT DISTINCT o_orderkey % 64 AS k FROM orders) SELECT k AS node, CASE WHEN k >= 32 AND k % 2 = 1 THEN NULL ELSE floor(log2(k + 1))::INT END AS depth FROM n""")
def q_depths(spark, sf_dir):
    """Depths below a root: a node's parent is half of one less; the odd leaves are their own parents and have none."""
    k = _t(spark, sf_dir, "orders").select((F.col("o_orderkey") % 64).alias("k")).distinct()
    nodes = k.select(F.lit("f").alias("file"), "k")
    edges = nodes.where("k > 0").select("file", F.col("k").alias("child"), F.when((F.col("k") >= 32) & (F.col("k") % 2 == 1), F.col("k")).otherwise(F.floor((F.col("k") - 1) / 2)).alias("parent"))
    every = spark.range(64).select(F.lit("f").alias("file"), F.col("id").alias("k"))
    inner = every.where("k > 0 and k < 32").select("file", F.col("k").alias("child"), F.floor((F.col("k") - 1) / 2).alias("parent"))
    text = lambda df: df.select("file", _said(F.col("child")).alias("child"), _said(F.col("parent")).alias("parent"))
    out = closure.depths(every.select("file", _said(F.col("k")).alias("node")), text(edges.unionByName(inner).distinct()))
    return out.withColumn("node", F.col("node").cast("long")).join(k.withColumnRenamed("k", "node"), "node", "left_semi").select("node", "depth")


@query(f"{S}, {CLS} SELECT {_sanitized(LOCAL.format('uri'), empty='Unknown')} AS name FROM c")
def q_definition_entities(spark, sf_dir):
    """The whole conversion as a definition's encoded parts, and the entities read back from them."""
    e, _, _ = serialize.relations_of(lens_queries.q_definition_parts(spark, sf_dir))
    return e.select("name")


@query(f"{S}, {CLS}, {lens_queries.I}, {lens_queries.USAGE} SELECT {_sanitized(LOCAL.format('a.prop'), empty='Unknown')} AS name FROM ends a JOIN ends b ON a.prop = b.prop WHERE a.side = 'domain' AND b.side = 'range'")
def q_definition_relationships(spark, sf_dir):
    _, _, r = serialize.relations_of(lens_queries.q_definition_parts(spark, sf_dir))
    return r.select("name")


def _definition(spark, sf_dir):
    """Entities of suppliers, with a fault in some: parents, keys, names and ends."""
    k = F.col("s_suppkey")
    s = _t(spark, sf_dir, "supplier").select(F.lit("f").alias("file"), k, _said(k).alias("id"), F.when(k % 5 == 0, F.concat(F.lit("9 "), _said(k))).otherwise(F.concat(F.lit("S"), _said(k))).alias("name"))
    entities = s.select("file", "id", "name", F.lit("user").alias("namespace"), F.lit("Custom").alias("namespaceType"), F.lit("Visible").alias("visibility"), F.when(k % 4 == 0, F.lit("none")).alias("baseEntityTypeId"), F.array(F.concat(F.lit("p"), F.when(k % 3 == 0, F.lit("x")).otherwise(F.col("id")))).alias("entityIdParts"), F.concat(F.lit("p"), "id").alias("displayNamePropertyId"))
    properties = s.select("file", F.col("id").alias("entity_id"), F.lit(0).alias("pos"), F.concat(F.lit("p"), "id").alias("id"), F.lit("label").alias("name"), F.when(k % 7 == 0, "Double").otherwise("String").alias("valueType"), F.lit(False).alias("is_timeseries"))
    rels = s.where(k % 6 == 0).select("file", F.concat(F.lit("r"), "id").alias("id"), F.concat(F.lit("r"), "id").alias("name"), F.lit("user").alias("namespace"), F.lit("Custom").alias("namespaceType"), F.col("id").alias("source_id"), F.when(k % 12 == 0, F.col("id")).otherwise(F.lit("none")).alias("target_id"))
    return entities, properties, rels


@query("""WITH s AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 5 = 0 THEN '9 ' ELSE 'S' END || s_suppkey AS name FROM supplier)
SELECT name, 'error' AS severity, 'parent' AS code FROM s WHERE k % 4 = 0 UNION ALL SELECT name, 'warning', 'display_type' FROM s WHERE k % 7 = 0 UNION ALL SELECT name, 'error', 'key' FROM s WHERE k % 3 = 0
UNION ALL SELECT name, 'warning', 'key_type' FROM s WHERE k % 3 <> 0 AND k % 7 = 0 UNION ALL SELECT 'r' || k, 'error', 'dangling' FROM s WHERE k % 6 = 0 AND k % 12 <> 0 UNION ALL SELECT 'r' || k, 'warning', 'self' FROM s WHERE k % 12 = 0""")
def q_definition_issues(spark, sf_dir):
    return checks.definition_issues(*_definition(spark, sf_dir)).select(F.col("uri").alias("name"), "severity", "code")


@query("""SELECT 'f' AS file, count(*) FILTER (s_suppkey % 4 = 0) + count(*) FILTER (s_suppkey % 3 = 0) + count(*) FILTER (s_suppkey % 6 = 0 AND s_suppkey % 12 <> 0) + count(*) FILTER (s_suppkey % 7 = 0) + count(*) FILTER (s_suppkey % 3 <> 0 AND s_suppkey % 7 = 0) + count(*) FILTER (s_suppkey % 12 = 0) AS errors, 0::BIGINT AS warnings, false AS seamless FROM supplier""")
def q_strict_report(spark, sf_dir):
    """Warnings as errors, counted by document."""
    return checks.report(checks.strict(checks.definition_issues(*_definition(spark, sf_dir)))).select("file", "errors", "warnings", "seamless")


@query("""SELECT '9 ' || s_suppkey AS name, 'TGT001' AS code FROM supplier WHERE s_suppkey % 5 = 0 UNION ALL SELECT 'r' || s_suppkey, 'TGT020' FROM supplier WHERE s_suppkey % 6 = 0 AND s_suppkey % 12 <> 0""")
def q_converted_compliance(spark, sf_dir):
    return checks.converted_compliance(*_definition(spark, sf_dir)).select(F.col("uri").alias("name"), "code")


@query("""SELECT n_name AS name, CASE WHEN n > 1000 THEN 'error' ELSE 'warning' END AS severity, n FROM nation JOIN (SELECT 100 + n_nationkey % 3 * 20 - 15 AS n, n_nationkey FROM nation) USING (n_nationkey) WHERE n > 90 AND n <= 100
UNION ALL SELECT n_name, 'error', 100 + n_nationkey % 3 * 20 - 15 FROM nation WHERE 100 + n_nationkey % 3 * 20 - 15 > 100""")
def q_model_limits(spark, sf_dir):
    """Entities of 85, 105 and 125 properties under the limits of models."""
    n = _t(spark, sf_dir, "nation").select(F.lit("f").alias("file"), _said(F.col("n_nationkey")).alias("id"), F.col("n_name").alias("name"), (F.lit(85) + F.col("n_nationkey") % 3 * 20).alias("n"))
    e = n.select("file", "id", "name", F.lit("user").alias("namespace"), F.lit("Custom").alias("namespaceType"), F.lit("Visible").alias("visibility"), F.lit(None).cast("string").alias("baseEntityTypeId"), F.array().cast("array<string>").alias("entityIdParts"), F.lit(None).cast("string").alias("displayNamePropertyId"))
    p = n.select("file", F.col("id").alias("entity_id"), F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("pos")).select("file", "entity_id", "pos", F.concat("entity_id", F.lit("_"), _said(F.col("pos"))).alias("id"), F.lit("x").alias("name"), F.lit("String").alias("valueType"), F.lit(False).alias("is_timeseries"))
    r = n.limit(0).select("file", "id", "name", F.lit("user").alias("namespace"), F.lit("Custom").alias("namespaceType"), F.col("id").alias("source_id"), F.col("id").alias("target_id"))
    found = checks.limit_issues(e, p, r, profile="model").where("code = 'properties'")
    return found.join(n.select("name", F.col("n").cast("int").alias("n")), found["uri"] == n["name"]).select("name", "severity", "n")


#: What each sixteenth part's document holds, and the finding: subject, predicate and object of its triples (`_:` for blank ones), severity, category, code.
GRAPH_FAULTS = [
    ([("x:doc", OWL + "imports", "x:other")], "warning", "external_import", "imports"),
    ([("x:c", OWL + "intersectionOf", "_:l")], "warning", "unsupported_construct", "class_expression"),
    ([("_:r", RDF + "type", OWL + "Restriction"), ("_:r", OWL + "onProperty", "x:p"), ("_:r", OWL + "someValuesFrom", "x:c")], "warning", "property_restriction", "restriction"),
    ([("x:p", RDF + "type", OWL + "FunctionalProperty")], "info", "property_characteristic", "characteristic"),
    ([("x:p", OWL + "propertyChainAxiom", "_:l")], "warning", "unsupported_construct", "property_axiom"),
    ([("x:p", OWL + "inverseOf", "x:q")], "info", "unsupported_construct", "property_axiom"),
    ([("x:c", OWL + "disjointWith", "x:d")], "info", "unsupported_construct", "class_axiom"),
    ([("_:x", RDF + "type", OWL + "AllDisjointClasses")], "info", "unsupported_construct", "class_axiom"),
    ([("x:p", RDF + "type", OWL + "ObjectProperty")], "warning", "missing_signature", "missing_signature"),
    ([("x:p", RDF + "type", OWL + "ObjectProperty"), ("x:p", RDFS + "domain", "x:nowhere"), ("x:p", RDFS + "range", XSD + "string")], "warning", "missing_signature", "undeclared_end"),
    ([("x:p", RDFS + "range", XSD + "oddType")], "info", "unsupported_datatype", "datatype"),
    ([("x:p", RDFS + "range", "_:u"), ("_:u", OWL + "unionOf", "_:l")], "info", "unsupported_datatype", "datatype_union"),
    ([("x:i", RDF + "type", OWL + "NamedIndividual")], "info", "individual", "count"),
    ([("x:i", OWL + "sameAs", "x:j")], "info", "individual", "count"),
    ([("x:a", RDF + "type", OWL + "AnnotationProperty")], "info", "annotation", "count"),
    ([("_:s", RDF + "type", RDF + "Statement")], "warning", "reification", "count"),
]


@query("SELECT 'p' || p_partkey AS file, severity, category, code FROM part JOIN (VALUES " + ", ".join(f"({i}, '{s}', '{c}', '{k}')" for i, (_, s, c, k) in enumerate(GRAPH_FAULTS)) + f") x(i, severity, category, code) ON p_partkey % {len(GRAPH_FAULTS)} = i")
def q_graph_issues(spark, sf_dir):
    """A graph for each part, with one construct that a check speaks of; all checks run over all graphs."""
    return checks.preflight(_graphs(spark, sf_dir)).select("file", "severity", "category", "code")


def _graphs(spark, sf_dir):
    kind = lambda x: "bnode" if x.startswith("_:") else "iri"
    triple = lambda s, p, o: F.struct(F.lit(s).alias("s"), F.lit(kind(s)).alias("s_kind"), F.lit(p).alias("p"), F.lit(o).alias("o"), F.lit(kind(o)).alias("o_kind"))
    i = F.col("p_partkey") % len(GRAPH_FAULTS)
    held = F.array().cast("array<struct<s:string,s_kind:string,p:string,o:string,o_kind:string>>")
    for k, (rows, *_) in enumerate(GRAPH_FAULTS):
        held = F.when(i == k, F.array(*[triple(*r) for r in rows])).otherwise(held)
    null = F.lit(None).cast("string")
    return _t(spark, sf_dir, "part").select(F.concat(F.lit("p"), _said(F.col("p_partkey"))).alias("file"), F.explode(held).alias("x")).select("file", "x.*", null.alias("o_datatype"), null.alias("o_lang"))


@query("""WITH s AS (SELECT s_suppkey AS k, s_suppkey::VARCHAR AS id, CASE WHEN s_suppkey % 5 = 0 THEN '9 ' ELSE 'S' END || s_suppkey AS name FROM supplier)
SELECT 1 + row_number() OVER (ORDER BY id) AS ord, 'EntityTypes/' || id || '/definition.json' AS path, name, 'user' AS namespace, CASE WHEN k % 4 = 0 THEN 'none' END AS parent, 'p' || CASE WHEN k % 3 = 0 THEN 'x' ELSE id END AS key, 'p' || id AS display, 'label' AS property, CASE WHEN k % 7 = 0 THEN 'Double' ELSE 'String' END AS type, NULL::VARCHAR AS source, NULL::VARCHAR AS target FROM s
UNION ALL SELECT 1 + (SELECT count(*) FROM s) + row_number() OVER (ORDER BY 'r' || id), 'RelationshipTypes/r' || id || '/definition.json', 'r' || id, 'user', NULL, NULL, NULL, NULL, NULL, id, CASE WHEN k % 12 = 0 THEN id ELSE 'none' END FROM s WHERE k % 6 = 0""")
def q_definition_payloads(spark, sf_dir):
    """A definition of suppliers as ordered, encoded parts, and all that is read back from them."""
    e, p, r = _definition(spark, sf_dir)
    parts = serialize.definition_parts(e, p, r, e.select("file").distinct().withColumn("ontology", F.lit("suppliers")))
    entities, properties, rels = serialize.relations_of(parts)
    null = F.lit(None).cast("string")
    of = properties.select("file", F.col("entity_id").alias("id"), F.col("name").alias("property"), F.col("valueType").alias("type"))
    ents = entities.join(of, ["file", "id"], "left").select(F.concat(F.lit("EntityTypes/"), "id", F.lit("/definition.json")).alias("path"), "name", "namespace", F.col("baseEntityTypeId").alias("parent"), F.get("entityIdParts", F.lit(0)).alias("key"), F.col("displayNamePropertyId").alias("display"), "property", "type", null.alias("source"), null.alias("target"))
    links = rels.select(F.concat(F.lit("RelationshipTypes/"), "id", F.lit("/definition.json")).alias("path"), "name", "namespace", *[null.alias(c) for c in ("parent", "key", "display", "property", "type")], F.col("source_id").alias("source"), F.col("target_id").alias("target"))
    return parts.select(F.col("ord").cast("long").alias("ord"), "path").join(ents.unionByName(links), "path").select("ord", "path", "name", "namespace", "parent", "key", "display", "property", "type", "source", "target")


@query(f"""SELECT 'p' || p_partkey AS file, severity, code FROM part JOIN (VALUES (0, 'warning', 'OWL040'), (2, 'warning', 'OWL001'), (4, 'info', 'OWL032'), (6, 'info', 'OWL031'), (8, 'warning', 'OWL020'), (8, 'warning', 'OWL021'), (9, 'warning', 'OWL022'), (12, 'info', 'OWL010')) x(i, severity, code) ON p_partkey % {len(GRAPH_FAULTS)} = i""")
def q_graph_compliance(spark, sf_dir):
    """The coded findings on the same graphs."""
    return checks.owl_compliance(_graphs(spark, sf_dir)).select("file", "severity", "code")


@query("""WITH s AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 5 = 0 THEN '9 ' ELSE 'S' END || s_suppkey AS name FROM supplier)
SELECT name AS uri, 'warning' AS severity, 'parent' AS code FROM s WHERE k % 4 <> 0 AND k % 9 <> 1 UNION ALL SELECT 'r' || k, 'error', 'number' FROM s WHERE k % 6 = 0 UNION ALL SELECT 'r' || k, 'warning', 'dangling' FROM s WHERE k % 6 = 0 AND k % 12 <> 0
UNION ALL SELECT 'EntityTypes/' || k || '/definition.json', 'error', 'payload' FROM s WHERE k % 9 = 1 UNION ALL SELECT 'EntityTypes/' || k || '/definition.json', 'error', 'payload_type' FROM s WHERE k % 9 = 2""")
def q_payload_issues(spark, sf_dir):
    """Checks of the finished definition of suppliers, some of whose parts are damaged; a damaged entity says nothing else."""
    e, p, r = _definition(spark, sf_dir)
    parts = serialize.definition_parts(e, p, r, e.select("file").distinct().withColumn("ontology", F.lit("suppliers")))
    k = F.try_to_number(F.regexp_extract("path", r"^EntityTypes/(\d+)/", 1), F.lit("9" * 18)).cast("long")
    spoilt = parts.withColumn("payload", F.when(k % 9 == 1, "?").otherwise(F.col("payload"))).withColumn("payloadType", F.when(k % 9 == 2, "Plain").otherwise(F.col("payloadType")))
    return checks.payload_issues(spoilt).select("uri", "severity", "code")


@query(f"""WITH s AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 5 = 0 THEN '9 ' ELSE 'S' END || s_suppkey AS name FROM supplier), o(b) AS (VALUES ('{export.BASE}')), u AS (SELECT k, name, '<' || b || {_sanitized('name', 'C_', 100000, 'UnnamedClass')} || '>' AS uri, b FROM s, o),
l AS (SELECT DISTINCT x.line FROM u, LATERAL (SELECT unnest([uri || ' <{RDF}type> <{OWL}Class> .', uri || ' <{RDFS}label> "' || name || '" .', '<' || b || 'label> <{RDFS}domain> ' || uri || ' .', '<' || b || 'label> <{RDFS}range> <{XSD}' || CASE WHEN k % 7 = 0 THEN 'double' ELSE 'string' END || '> .', '<' || b || 'label> <{RDF}type> <{OWL}DatatypeProperty> .', '<' || b || 'label> <{RDFS}label> "label" .']) AS line) x
 UNION SELECT x.line FROM u, LATERAL (SELECT unnest(['<' || b || 'r' || k || '> <{RDF}type> <{OWL}ObjectProperty> .', '<' || b || 'r' || k || '> <{RDFS}label> "r' || k || '" .', '<' || b || 'r' || k || '> <{RDFS}domain> ' || uri || ' .', '<' || b || 'r' || k || '> <{RDFS}range> ' || uri || ' .']) AS line) x WHERE k % 12 = 0
 UNION SELECT unnest(['<' || rtrim(b, '#') || '> <{RDF}type> <{OWL}Ontology> .', '<' || rtrim(b, '#') || '> <{RDFS}label> "suppliers" .']) FROM o)
SELECT line FROM l""")
def q_exported_definition(spark, sf_dir):
    """The definition of suppliers as lines of triples; parents and ends that are not there leave no trace."""
    e, p, r = _definition(spark, sf_dir)
    t = export.triples_of(e, p, r, e.select("file").distinct().withColumn("ontology", F.lit("suppliers")))
    return export.ntriples(t).select("line")
