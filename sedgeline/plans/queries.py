"""Registered queries over the test tables, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, names, types, values
from ..operators import checks, closure, compare, export, keys, marks, rdf, serialize
from ..operators.shared import written
from ..sources import rdf as rdf_source
from ..streaming import control
from . import lens
from .lens import NS, OWL, RDF, RDFS, TYPE, XSD

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lens.schema_triples(spark, sf_dir).withColumn("file", F.lit("lens")).withColumn("o_lang", F.lit(None).cast("string"))


S = f"WITH RECURSIVE t AS ({lens.schema_sql()})"
CLS = f"c AS (SELECT DISTINCT s AS uri FROM t WHERE s_kind = 'iri' AND (p = '{RDFS}subClassOf' OR (p = '{TYPE}' AND o IN ('{OWL}Class', '{RDFS}Class'))))"
EDGES = f"e AS (SELECT DISTINCT s AS child, o AS parent FROM t WHERE p = '{RDFS}subClassOf' AND s_kind = 'iri' AND o_kind = 'iri')"
ANC = "a(node, anc, lvl, path) AS (SELECT child, parent, 1, [child, parent] FROM e UNION ALL SELECT a.node, e.parent, a.lvl + 1, list_append(a.path, e.parent) FROM a JOIN e ON a.anc = e.child WHERE NOT list_contains(a.path[2:], e.parent))"
LOCAL = "CASE WHEN contains({0}, '#') THEN regexp_extract({0}, '([^#]*)$', 1) ELSE regexp_extract({0}, '([^/]*)$', 1) END"


def _sanitized(x: str, prefix: str = "E_", most: int = 128, empty: str = "Entity") -> str:
    clean = f"regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_]', '_', 'g')"
    return f"CASE WHEN coalesce({x}, '') = '' THEN '{empty}' WHEN regexp_matches({clean}, '^\\p{{L}}') THEN substr({clean}, 1, {most}) ELSE substr('{prefix}' || {clean}, 1, {most}) END"


# ---- names and ids

@query(f"SELECT page_id, {LOCAL.format('url')} AS local_name, regexp_extract(url, CASE WHEN contains(url, '#') THEN '^(.*#)' ELSE '^(.*/)' END, 1) AS namespace FROM pages")
def q_uri_names(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", names.local_name(F.col("url")).alias("local_name"), names.namespace(F.col("url")).alias("namespace"))


@query(f"SELECT doc_id, {_sanitized('text')} AS name, {_sanitized('text', most=90)} AS model_name, {_sanitized('text', 'O_', 90, 'Ontology')} AS service_name FROM documents")
def q_sanitized_names(spark, sf_dir):
    x = F.col("text")
    return _t(spark, sf_dir, "documents").select("doc_id", names.sanitize(x).alias("name"), names.model_name(x).alias("model_name"), names.service_name(x).alias("service_name"))


@query("SELECT c_custkey, regexp_matches(c_name, '^\\p{L}[\\p{L}\\p{N}_]*$') AND length(c_name) <= 128 AS valid_name, regexp_matches((1000000000000 + c_custkey)::VARCHAR, '^[0-9]{13}$') AS valid_id FROM customer")
def q_valid_names(spark, sf_dir):
    return _t(spark, sf_dir, "customer").select("c_custkey", names.is_valid_name(F.col("c_name")).alias("valid_name"), ids.is_id((F.col("c_custkey") + ids.PREFIX).cast("string")).alias("valid_id"))


@query("""WITH x AS (SELECT p_partkey, 'dtmi:trade:' || regexp_replace(p_brand, '[^A-Za-z0-9]', '_', 'g') || ':p' || p_partkey || ';1' AS dtmi, p_name FROM part),
y AS (SELECT *, (('0x' || substr(sha256(regexp_replace(split_part(dtmi, ';', 1), '^dtmi:', '')), 1, 16))::UBIGINT % 1000000000000 + 1000000000000)::VARCHAR AS entity_id FROM x)
SELECT p_partkey, entity_id, entity_id || lpad((('0x' || substr(md5(p_name), 1, 8))::UBIGINT % 10000)::VARCHAR, 4, '0') AS member_id FROM y""")
def q_hash_ids(spark, sf_dir):
    dtmi = F.concat(F.lit("dtmi:trade:"), F.regexp_replace("p_brand", "[^A-Za-z0-9]", "_"), F.lit(":p"), F.col("p_partkey").cast("string"), F.lit(";1"))
    x = _t(spark, sf_dir, "part").select("p_partkey", "p_name", ids.hash_id(dtmi).alias("entity_id"))
    return x.select("p_partkey", "entity_id", ids.member_id(F.col("entity_id"), F.col("p_name")).alias("member_id"))


@query("SELECT s_suppkey, (1000000000000 + row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name, s_suppkey))::VARCHAR AS id FROM supplier")
def q_sequential_ids(spark, sf_dir):
    return ids.numbered(_t(spark, sf_dir, "supplier"), "s_name", "s_suppkey", partition=("s_nationkey",)).select("s_suppkey", "id")


@query("SELECT n_nationkey, 1000000000000 + coalesce(sum(n_nationkey + 1) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS range_start FROM nation")
def q_reserved_ranges(spark, sf_dir):
    df = _t(spark, sf_dir, "nation").withColumn("n", F.col("n_nationkey").cast("long") + 1)
    return ids.reserve(df, "n", "n_nationkey", partition=("n_regionkey",)).select("n_nationkey", "range_start")


# ---- types and values

def _values(table: dict, prefix: str = "") -> str:
    return ", ".join(f"('{prefix}{s}', '{t}')" for t, ss in table.items() for s in ss)


@query(f"{S}, m(k, v) AS (VALUES {_values(types.XSD_TYPES, XSD)}) SELECT s AS prop, o AS range, coalesce(v, 'String') AS target FROM t LEFT JOIN m ON k = o WHERE p = '{RDFS}range'")
def q_xsd_types(spark, sf_dir):
    t = _schema(spark, sf_dir).where(F.col("p") == RDFS + "range")
    return t.select(F.col("s").alias("prop"), F.col("o").alias("range"), types.xsd_type(F.col("o")).alias("target"))


@query(f"""WITH m(k, v) AS (VALUES {_values(types.CDM_PRIMITIVES)}), s(k, v) AS (VALUES {_values(types.CDM_SEMANTIC)}),
x AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'dateTime' WHEN 1 THEN 'Price' WHEN 2 THEN event_type ELSE NULL END AS n FROM events)
SELECT event_id, coalesce(m.v, s.v, CASE WHEN event_id % 3 = 0 THEN 'BigInt' END, 'String') AS target,
  CASE WHEN m.v IS NOT NULL THEN 'primitive' WHEN s.v IS NOT NULL THEN 'semantic' WHEN event_id % 3 = 0 THEN 'trait' ELSE 'default' END AS how
FROM x LEFT JOIN m ON m.k = lower(n) LEFT JOIN s ON s.k = lower(n)""")
def q_cdm_types(spark, sf_dir):
    n = F.when(F.col("event_id") % 4 == 0, "dateTime").when(F.col("event_id") % 4 == 1, "Price").when(F.col("event_id") % 4 == 2, F.col("event_type"))
    traits = F.when(F.col("event_id") % 3 == 0, F.array(F.lit("is.custom"), F.lit("is.dataFormat.integer"))).otherwise(F.array().cast("array<string>"))
    x = _t(spark, sf_dir, "events").select("event_id", types.cdm_type(n, traits).alias("x"))
    return x.select("event_id", F.col("x.type").alias("target"), F.col("x.how").alias("how"))


@query("""WITH x AS (SELECT l_orderkey, list(DISTINCT CASE l_linenumber % 4 WHEN 0 THEN 'String' WHEN 1 THEN 'BigInt' WHEN 2 THEN 'Double' ELSE 'DateTime' END) AS ts FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN list_contains(ts, 'BigInt') THEN 'BigInt' WHEN list_contains(ts, 'Double') THEN 'Double' WHEN list_contains(ts, 'DateTime') THEN 'DateTime' ELSE 'String' END AS union_type,
  CASE WHEN len(ts) = 1 THEN ts[1] ELSE 'String' END AS family_type FROM x""")
def q_union_types(spark, sf_dir):
    k = F.col("l_linenumber") % 4
    kind = F.when(k == 0, "String").when(k == 1, "BigInt").when(k == 2, "Double").otherwise("DateTime")
    x = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(kind).alias("ts"))
    return x.select("l_orderkey", types.union_type(F.col("ts")).alias("union_type"), types.family_type(F.col("ts")).alias("family_type"))


@query("SELECT event_id, round(coalesce(TRY_CAST(CASE WHEN event_id % 7 = 0 THEN event_type ELSE (event_id % 1000)::VARCHAR END AS DOUBLE) * power(10.0, (event_id % 5 - 2)::DOUBLE), -1), 6) AS scaled, least(2.0 * power(2.0, (event_id % 8)::DOUBLE), 60.0) AS wait FROM events")
def q_scaled_and_waits(spark, sf_dir):
    e = F.col("event_id")
    text = F.when(e % 7 == 0, F.col("event_type")).otherwise((e % 1000).cast("string"))
    v = values.scaled_value(text, e % 5 - 2)
    return _t(spark, sf_dir, "events").select("event_id", F.round(F.when(F.isnan(v), -1.0).otherwise(v), 6).alias("scaled"), values.retry_wait(e % 8 + 1).alias("wait"))


@query("""WITH x AS (SELECT page_id, url, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) AS sch, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)) AS h FROM pages)
SELECT page_id, CASE WHEN sch <> 'https' THEN 'scheme' WHEN h = '' THEN 'host' WHEN NOT (h LIKE '%.example.org' OR h = 'example.org') THEN 'domain' END AS fault,
  regexp_replace(regexp_replace(url, '[?#].*$', ''), '^([A-Za-z]+://)[^/@]*@', '\\1') AS loggable FROM x""")
def q_url_policy(spark, sf_dir):
    u = F.col("url")
    return _t(spark, sf_dir, "pages").select("page_id", values.url_fault(u, hosts=("example.org",)).alias("fault"), values.loggable_url(u).alias("loggable"))


@query("SELECT page_id, to_base64(encode(url)) AS payload, url AS back FROM pages")
def q_payload_round_trip(spark, sf_dir):
    x = _t(spark, sf_dir, "pages").select("page_id", F.regexp_replace(values.encoded(F.col("url")), "[\r\n]", "").alias("payload"))
    return x.select("page_id", "payload", values.decoded(F.col("payload")).alias("back"))


# ---- triples

@query(f"SELECT p, count(*) AS n, count(DISTINCT s) AS subjects FROM ({lens.triples_sql()}) GROUP BY p")
def q_triples_by_predicate(spark, sf_dir):
    return marks.counted(lens.triples(spark, sf_dir), "p", "s").withColumnRenamed("nodes", "subjects")


@query(f"{S}, {CLS} SELECT uri, {LOCAL.format('uri')} AS name FROM c")
def q_classes(spark, sf_dir):
    return rdf.classes(_schema(spark, sf_dir)).select("uri", names.local_name(F.col("uri")).alias("name"))


@query(f"{S}, {CLS}, {EDGES}, {ANC}, bad AS (SELECT node FROM a WHERE node = anc UNION SELECT node FROM a WHERE anc IN (SELECT node FROM a WHERE node = anc)) SELECT child, min(parent) AS parent FROM e WHERE parent IN (SELECT uri FROM c) AND parent NOT IN (SELECT node FROM bad) GROUP BY child")
def q_parents(spark, sf_dir):
    return rdf.parents(_schema(spark, sf_dir)).select("child", "parent")


@query(f"{S}, {EDGES}, {ANC} SELECT node, anc AS ancestor, min(lvl) AS level FROM a GROUP BY node, anc")
def q_ancestors(spark, sf_dir):
    return closure.ancestors(rdf.subclass_edges(_schema(spark, sf_dir))).select("node", "ancestor", "level")


@query(f"{S}, {EDGES}, {ANC} SELECT DISTINCT node FROM a WHERE node = anc")
def q_cycle_members(spark, sf_dir):
    return closure.on_cycle(closure.ancestors(rdf.subclass_edges(_schema(spark, sf_dir)))).select("node")


@query(f"""{S}, {CLS}, {EDGES}, {ANC}, bad AS (SELECT node FROM a WHERE node = anc UNION SELECT node FROM a WHERE anc IN (SELECT node FROM a WHERE node = anc)),
d AS (SELECT uri AS node, CASE WHEN uri IN (SELECT node FROM bad) THEN NULL ELSE coalesce((SELECT max(lvl) FROM a WHERE a.node = uri), 0) END AS depth FROM c)
SELECT node, depth, row_number() OVER (ORDER BY depth NULLS LAST, node) - 1 AS ord FROM d""")
def q_topological_order(spark, sf_dir):
    t = _schema(spark, sf_dir)
    return closure.topological(rdf.classes(t).withColumnRenamed("uri", "node"), rdf.subclass_edges(t)).select("node", "depth", "ord")


@query(f"""{S}, w(list, cell, i) AS (SELECT o, o, 0 FROM t WHERE p IN ('{OWL}unionOf', '{OWL}intersectionOf') AND o_kind = 'bnode' UNION ALL SELECT list, o, i + 1 FROM w JOIN t ON t.s = w.cell AND t.p = '{RDF}rest' WHERE o <> '{RDF}nil')
SELECT list, i, o AS member FROM w JOIN t ON t.s = w.cell AND t.p = '{RDF}first'""")
def q_list_members(spark, sf_dir):
    t = _schema(spark, sf_dir)
    heads = t.where(F.col("p").isin(OWL + "unionOf", OWL + "intersectionOf") & (F.col("o_kind") == "bnode")).select("file", F.col("o").alias("list"))
    return closure.list_members(t, RDF, heads).select("list", "i", "member")


@query(f"{S} SELECT s AS expression, (row_number() OVER (PARTITION BY s ORDER BY o2) - 1) AS i, o2 AS class FROM (SELECT t.s, f.o AS o2 FROM t JOIN t f ON f.p = '{RDF}first' AND f.s IN ('l1', 'l2') WHERE t.p = '{OWL}unionOf')")
def q_union_domains(spark, sf_dir):
    return closure.class_members(_schema(spark, sf_dir), RDF, OWL).select("expression", "i", "class")


PROPS = f"""dp AS (SELECT DISTINCT s AS prop FROM t WHERE p = '{TYPE}' AND o = '{OWL}DatatypeProperty' UNION
  SELECT s FROM t WHERE p = '{TYPE}' AND o = '{RDF}Property' AND s IN (SELECT s FROM t WHERE p = '{RDFS}range' AND starts_with(o, '{XSD}'))),
rng AS (SELECT s AS prop, min(o) AS r FROM t WHERE p = '{RDFS}range' GROUP BY s), m(k, v) AS (VALUES {_values(types.XSD_TYPES, XSD)}),
dom AS (SELECT s AS prop, o AS class FROM t WHERE p = '{RDFS}domain' AND o_kind = 'iri' UNION SELECT d.s, f.o FROM t d JOIN t u ON u.s = d.o AND u.p = '{OWL}unionOf' JOIN t f ON f.p = '{RDF}first' AND f.s IN ('l1', 'l2') WHERE d.p = '{RDFS}domain' AND d.o_kind = 'bnode')"""


@query(f"{S}, {PROPS} SELECT prop, coalesce(v, 'String') AS valueType, prop IN (SELECT s FROM t WHERE p = '{RDFS}comment' AND contains(lower(o), '(timeseries)')) AS is_timeseries FROM dp LEFT JOIN rng USING (prop) LEFT JOIN m ON k = r")
def q_data_properties(spark, sf_dir):
    return rdf.data_properties(_schema(spark, sf_dir)).select("prop", "valueType", "is_timeseries")


@query(f"{S}, {CLS}, {PROPS} SELECT class, prop, coalesce(v, 'String') AS valueType FROM dp JOIN dom USING (prop) LEFT JOIN rng USING (prop) LEFT JOIN m ON k = r WHERE class IN (SELECT uri FROM c)")
def q_attached_properties(spark, sf_dir):
    t = _schema(spark, sf_dir)
    return rdf.attached(t, rdf.data_properties(t)).select("class", "prop", "valueType")


USED = ("nation", "customer", "supplier", "orders", "region", "lineitem", "part", "events")
I = f"i AS (SELECT * FROM ({lens.instance_sql(USED)}))"
USAGE = f"""op AS (SELECT DISTINCT s AS prop FROM t WHERE p = '{TYPE}' AND o = '{OWL}ObjectProperty'),
u AS (SELECT DISTINCT i.p AS prop, 'domain' AS side, k.o AS class FROM i JOIN i k ON k.s = i.s AND k.p = '{TYPE}' WHERE i.p IN (SELECT prop FROM op)
  UNION SELECT DISTINCT i.p, 'range', k.o FROM i JOIN i k ON k.s = i.o AND k.p = '{TYPE}' WHERE i.p IN (SELECT prop FROM op)),
dec AS (SELECT s AS prop, CASE WHEN p = '{RDFS}domain' THEN 'domain' ELSE 'range' END AS side, o AS class FROM t WHERE p IN ('{RDFS}domain', '{RDFS}range') AND s IN (SELECT prop FROM op) AND o IN (SELECT uri FROM c)),
ends AS (SELECT * FROM dec UNION ALL SELECT prop, side, min(class) FROM u WHERE NOT EXISTS (SELECT 1 FROM dec WHERE dec.prop = u.prop AND dec.side = u.side) GROUP BY prop, side)"""


def _graph(spark, sf_dir):
    t = written(_schema(spark, sf_dir), "schema")
    i = lens.instance_triples(spark, sf_dir, USED, literals=False, apart=True).withColumn("file", F.lit("lens")).withColumn("o_lang", F.lit(None).cast("string"))
    return t, t.unionByName(i)


def _objects(t):
    return rdf.of_type(t, OWL + "ObjectProperty").select("file", F.col("s").alias("prop")).distinct()


@query(f"{S}, {CLS}, {I}, {USAGE} SELECT prop, side, class FROM u WHERE class IN (SELECT uri FROM c)")
def q_usage_inference(spark, sf_dir):
    t, g = _graph(spark, sf_dir)
    return rdf.usage(g, _objects(t), rdf.classes(t)).select("prop", F.col("end").alias("side"), "class")


@query(f"{S}, {CLS}, {I}, {USAGE} SELECT a.prop, a.class AS source, b.class AS target FROM ends a JOIN ends b ON a.prop = b.prop WHERE a.side = 'domain' AND b.side = 'range'")
def q_relationship_pairs(spark, sf_dir):
    t, g = _graph(spark, sf_dir)
    return rdf.relationship_pairs(rdf.property_ends(g, _objects(t), t)).select("prop", "source", "target")


@query(f"{S}, {CLS}, {I}, {USAGE} SELECT prop AS uri, CASE WHEN d = 0 AND r = 0 THEN 'missing domain and range' WHEN d = 0 THEN 'missing domain' ELSE 'missing range' END AS reason FROM (SELECT prop, (SELECT count(*) FROM ends WHERE ends.prop = op.prop AND side = 'domain') AS d, (SELECT count(*) FROM ends WHERE ends.prop = op.prop AND side = 'range') AS r FROM op) WHERE d = 0 OR r = 0")
def q_skip_reasons(spark, sf_dir):
    t, g = _graph(spark, sf_dir)
    obj = _objects(t)
    return rdf.skipped(obj, rdf.property_ends(g, obj, t)).select("uri", "reason")


@query()
def q_definition_parts(spark, sf_dir):
    """The whole conversion of the test tables' graph, as a definition."""
    t = lens.triples(spark, sf_dir, apart=True)
    c = rdf.convert(t)
    return serialize.definition_parts(c.entities, c.properties, c.relationships, rdf.ontology_names(c.schema))


@query()
def q_exported_triples(spark, sf_dir):
    """The same, exported again."""
    t = lens.triples(spark, sf_dir, apart=True)
    c = rdf.convert(t)
    return export.ntriples(export.triples_of(c.entities, c.properties, c.relationships, rdf.ontology_names(c.schema)))


# ---- keys and inheritance

def _columns(spark, sf_dir):
    """Parts as properties of their brands: names and types by name and size."""
    size = F.col("p_size")
    ending = F.when(size % 5 == 0, "_id").when(size % 5 == 1, "_name").otherwise("")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("String", "BigInt", "Double", "DateTime")]), (size % 4 + 1).cast("int"))
    rows = _t(spark, sf_dir, "part").select(F.lit("parts").alias("file"), F.col("p_brand").alias("entity_id"), F.col("p_partkey").cast("int").alias("pos"), F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"), F.concat(F.translate("p_name", " ", "_"), ending).alias("name"), kind.alias("valueType"), F.lit(False).alias("is_timeseries"))
    return rows


COLS = "p AS (SELECT p_brand AS entity_id, p_partkey::INT AS pos, 'p' || p_partkey AS id, replace(p_name, ' ', '_') || CASE p_size % 5 WHEN 0 THEN '_id' WHEN 1 THEN '_name' ELSE '' END AS name, ['String', 'BigInt', 'Double', 'DateTime'][p_size % 4 + 1] AS vt FROM part)"


@query(f"""WITH {COLS}, v AS (SELECT * FROM p WHERE vt IN ('String', 'BigInt')), k AS (SELECT entity_id AS id, coalesce(arg_max(id, pos) FILTER (contains(lower(name), 'id')), arg_min(id, pos)) AS key, arg_max(id, pos) FILTER (vt = 'String' AND contains(lower(name), 'name')) AS nm FROM v GROUP BY entity_id)
SELECT id, key, coalesce(nm, key) AS display FROM k""")
def q_last_key(spark, sf_dir):
    return keys.last_key(_columns(spark, sf_dir)).select("id", F.get("entityIdParts", F.lit(0)).alias("key"), F.col("displayNamePropertyId").alias("display"))


@query(f"WITH {COLS}, v AS (SELECT *, CASE WHEN {' OR '.join(f'''contains(lower(name), '{x}')''' for x in keys.PATTERNS)} THEN 0 ELSE 1 END AS r FROM p WHERE vt IN ('String', 'BigInt')) SELECT entity_id AS id, arg_min(id, r * 1000000000::BIGINT + pos) AS key FROM v GROUP BY entity_id")
def q_auto_key(spark, sf_dir):
    p = _columns(spark, sf_dir)
    e = p.select("file", F.col("entity_id").alias("id"), F.col("entity_id").alias("name")).distinct()
    return keys.infer(p, e).select("id", F.get("inferred", F.lit(0)).alias("key"))


@query("""WITH RECURSIVE h AS (SELECT DISTINCT p_type AS child, 'Part' AS parent FROM part UNION SELECT DISTINCT p_type || '/' || p_brand, p_type FROM part),
u(node, anc, lvl) AS (SELECT child, parent, 1 FROM h UNION ALL SELECT node, parent, lvl + 1 FROM u JOIN h ON anc = child),
o AS (SELECT child AS owner FROM h UNION SELECT 'Part'), att AS (SELECT owner, 0 AS pos, 'name' AS name FROM o UNION ALL SELECT owner, 1, 'of ' || owner FROM o),
all_ AS (SELECT owner AS entity, owner, 0 AS lvl FROM o UNION ALL SELECT node, anc, lvl FROM u), r AS (SELECT entity, owner, lvl, pos, name, row_number() OVER (PARTITION BY entity, name ORDER BY lvl, pos) AS k FROM all_ JOIN att USING (owner))
SELECT entity, name, owner, lvl AS level, row_number() OVER (PARTITION BY entity ORDER BY lvl DESC, owner, pos) - 1 AS ord FROM r WHERE k = 1""")
def q_inherited_attributes(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    h = part.select(F.col("p_type").alias("child"), F.lit("Part").alias("parent")).union(part.select(F.concat("p_type", F.lit("/"), "p_brand"), "p_type")).distinct().withColumn("file", F.lit("f"))
    owners = h.select("file", F.col("child").alias("owner")).union(h.select("file", "parent")).distinct()
    at = owners.select("file", "owner", F.lit(0).alias("pos"), F.lit("name").alias("name")).union(owners.select("file", "owner", F.lit(1), F.concat(F.lit("of "), "owner")))
    return closure.inherited(at, h).select("entity", "name", "owner", "level", "ord")


# ---- checks

@query(f"{S}, {CLS}, pr AS (SELECT DISTINCT s AS prop FROM t WHERE p = '{TYPE}' AND o IN ('{OWL}DatatypeProperty', '{OWL}ObjectProperty', '{RDF}Property')), h AS (SELECT prop, (SELECT count(*) FROM t WHERE s = prop AND p = '{RDFS}domain') AS d, (SELECT count(*) FROM t WHERE s = prop AND p = '{RDFS}range') AS r, (SELECT count(*) FROM t WHERE s = prop AND o_kind = 'iri' AND ((p = '{RDFS}domain') OR (p = '{RDFS}range' AND NOT starts_with(o, '{XSD}'))) AND o NOT IN (SELECT uri FROM c)) AS odd FROM pr) SELECT prop AS uri, CASE WHEN d = 0 OR r = 0 THEN 'missing_signature' ELSE 'undeclared_end' END AS code FROM h WHERE d = 0 OR r = 0 OR odd > 0")
def q_signatures(spark, sf_dir):
    return checks.signatures(_schema(spark, sf_dir)).select("uri", "code")


@query(f"{S} SELECT s AS uri, {LOCAL.format('o')} AS message FROM t WHERE p = '{TYPE}' AND o IN ({', '.join(repr(OWL + c) for c in checks.CHARACTERISTICS)})")
def q_characteristics(spark, sf_dir):
    return checks.characteristics(_schema(spark, sf_dir)).select("uri", "message")


@query(f"{S} SELECT r.o AS uri, string_agg(DISTINCT {LOCAL.format('f.p')}, ', ') AS details FROM t x JOIN t r ON r.s = x.s AND r.p = '{OWL}onProperty' LEFT JOIN t f ON f.s = x.s AND f.p IN ({', '.join(repr(OWL + c) for c in checks.FACETS)}) WHERE x.p = '{TYPE}' AND x.o = '{OWL}Restriction' GROUP BY r.o")
def q_restrictions(spark, sf_dir):
    return checks.restrictions(_schema(spark, sf_dir)).select("uri", "details")


@query()
def q_preflight(spark, sf_dir):
    """All issues of the schema."""
    return checks.preflight(_schema(spark, sf_dir))


@query("""WITH x AS (SELECT CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'warning' ELSE 'info' END AS severity, event_type AS category FROM events)
SELECT severity, category, count(*) AS n FROM x GROUP BY CUBE (severity, category)""")
def q_issues_cube(spark, sf_dir):
    sev = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "click", "warning").otherwise("info")
    return checks.by_severity_category(_t(spark, sf_dir, "events").select(sev.alias("severity"), F.col("event_type").alias("category")))


@query(f"{S}, f AS (SELECT CASE WHEN p = '{TYPE}' THEN {LOCAL.format('o')} ELSE {LOCAL.format('p')} END AS feature FROM t WHERE (p = '{TYPE}' AND (starts_with(o, '{OWL}') OR starts_with(o, '{RDFS}'))) OR starts_with(p, '{OWL}') OR starts_with(p, '{RDFS}')), s(k, v) AS (VALUES {', '.join(f'''('{k}', '{v}')''' for v, ks in checks.SUPPORT.items() for k in ks)}) SELECT feature, coalesce(v, 'unknown') AS support, count(*) AS n FROM f LEFT JOIN s ON k = feature GROUP BY ALL")
def q_feature_support(spark, sf_dir):
    t = _schema(spark, sf_dir)
    return checks.features(t).join(F.broadcast(checks.support_table(spark)), "feature", "left").fillna("unknown", ["support"]).select("feature", "support", "n")


@query(f"{S}, {CLS} SELECT uri AS class, count(DISTINCT k.s) FILTER (k.o = '{OWL}DatatypeProperty') AS data, count(DISTINCT k.s) FILTER (k.o = '{OWL}ObjectProperty') AS object FROM c LEFT JOIN t d ON d.p = '{RDFS}domain' AND d.o = uri LEFT JOIN t k ON k.s = d.s AND k.p = '{TYPE}' GROUP BY uri")
def q_class_property_counts(spark, sf_dir):
    return checks.class_property_counts(_schema(spark, sf_dir)).select("class", "data", "object")


@query("SELECT o_orderkey::VARCHAR AS name, o_custkey::VARCHAR AS id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)")
def q_dangling(spark, sf_dir):
    e = _t(spark, sf_dir, "customer").where("c_custkey % 10 <> 0").select(F.lit("f").alias("file"), F.col("c_custkey").cast("string").alias("id"))
    o = _t(spark, sf_dir, "orders")
    r = o.select(F.lit("f").alias("file"), F.col("o_orderkey").cast("string").alias("name"), F.col("o_custkey").cast("string").alias("source_id"), F.col("o_custkey").cast("string").alias("target_id"))
    return checks.dangling(r, e).select(F.col("uri").alias("name"), F.col("details").alias("id")).distinct()


@query("SELECT l_orderkey::VARCHAR AS uri, CASE WHEN count(*) > 6 THEN 'error' ELSE 'warning' END AS severity FROM lineitem GROUP BY 1 HAVING count(*) > 0.9 * 6")
def q_limits(spark, sf_dir):
    n = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("uri")).agg(F.count("*").alias("n"))
    return n.where("n > 0.9 * 6").select("uri", F.when(F.col("n") > 6, "error").otherwise("warning").alias("severity"))


@query("SELECT n_regionkey AS region, count(*) AS done, count(*) FILTER (n_nationkey % 3 = 0) AS skipped, round(CASE WHEN count(*) + count(*) FILTER (n_nationkey % 3 = 0) = 0 THEN 100 ELSE count(*) * 100.0 / (count(*) + count(*) FILTER (n_nationkey % 3 = 0)) END, 6) AS success_rate FROM nation GROUP BY 1")
def q_success_rate(spark, sf_dir):
    n = _t(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("region")).agg(F.count("*").alias("done"), F.count_if(F.col("n_nationkey") % 3 == 0).alias("skipped"))
    return n.withColumn("success_rate", F.round(values.success_rate(F.col("done"), F.col("skipped")), 6))


# ---- comparison

D = f"d AS (SELECT DISTINCT {LOCAL.format('o')} AS kind, {LOCAL.format('s')} AS name FROM t WHERE p = '{TYPE}' AND o IN ('{OWL}Class', '{OWL}DatatypeProperty', '{OWL}ObjectProperty')), a AS (SELECT * FROM d WHERE NOT starts_with(name, 's_')), b AS (SELECT * FROM d WHERE NOT starts_with(name, 'o'))"


def _two(spark, sf_dir):
    t = _schema(spark, sf_dir)
    n = names.local_name(F.col("s"))
    return t.where(~F.startswith(n, F.lit("s_"))), t.where(~F.startswith(n, F.lit("o")))


@query(f"{S}, {D} SELECT kind, name, 'first' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT kind, name, 'second' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)")
def q_differences(spark, sf_dir):
    return compare.differences(*_two(spark, sf_dir))


@query(f"{S}, {D}, k(kind) AS (VALUES ('Class'), ('DatatypeProperty'), ('ObjectProperty')), r AS (SELECT kind, (SELECT count(*) FROM a WHERE a.kind = k.kind) AS first, (SELECT count(*) FROM b WHERE b.kind = k.kind) AS second, (SELECT count(*) FROM (SELECT * FROM a WHERE a.kind = k.kind EXCEPT SELECT * FROM b)) AS only_first, (SELECT count(*) FROM (SELECT * FROM b WHERE b.kind = k.kind EXCEPT SELECT * FROM a)) AS only_second FROM k), s AS (SELECT * FROM r UNION ALL SELECT 'all', sum(first)::BIGINT, sum(second)::BIGINT, sum(only_first)::BIGINT, sum(only_second)::BIGINT FROM r) SELECT *, only_first = 0 AND only_second = 0 AS equal FROM s")
def q_difference_summary(spark, sf_dir):
    return compare.summary(*_two(spark, sf_dir))


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def q_last_chunk_wins(spark, sf_dir):
    return compare.last_wins(_t(spark, sf_dir, "events").select("user_id", "event_type", "event_id"), "user_id", "event_id")


# ---- control over time

@query("""WITH RECURSIVE x AS (SELECT user_id, event_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
f(user_id, event_id, k, us, tokens, ok) AS (SELECT user_id, event_id, k, us, 2.0::DOUBLE, true FROM x WHERE k = 1
 UNION ALL SELECT x.user_id, x.event_id, x.k, x.us, t.v - (CASE WHEN t.v >= 1 THEN 1 ELSE 0 END), t.v >= 1 FROM f JOIN x ON x.user_id = f.user_id AND x.k = f.k + 1, LATERAL (SELECT least(3.0, f.tokens + (x.us - f.us) * 2.0 / 3600000000.0)) t(v))
SELECT event_id, ok AS admitted FROM f""")
def q_token_bucket(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return control.token_bucket(e, "user_id", "ts", "event_id", rate=2.0, per_seconds=3600.0, burst=3.0).select("event_id", "admitted")


@query("""SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW) AS offered FROM events""")
def q_sliding_load(spark, sf_dir):
    return control.sliding_load(_t(spark, sf_dir, "events"), "user_id", "ts", seconds=60).select("event_id", "offered")


@query("""WITH RECURSIVE x AS (SELECT user_id, event_id, epoch_us(ts) AS us, event_type = 'error' AS bad, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
f(user_id, event_id, k, state, fails, oks, opened, res) AS (SELECT user_id, event_id, k, CASE WHEN bad AND 2 <= 1 THEN 'open' ELSE 'closed' END, CASE WHEN bad THEN 1 ELSE 0 END, 0, 0::BIGINT, 'called' FROM x WHERE k = 1
 UNION ALL SELECT user_id, event_id, k, CASE WHEN st = 'open' THEN 'open' WHEN st = 'half' THEN CASE WHEN bad THEN 'open' WHEN oks + 1 >= 2 THEN 'closed' ELSE 'half' END WHEN bad AND fails + 1 >= 2 THEN 'open' ELSE 'closed' END,
   CASE WHEN st = 'open' THEN fails WHEN st = 'half' THEN 0 WHEN bad THEN fails + 1 ELSE 0 END,
   CASE WHEN st = 'half' AND NOT bad AND oks + 1 < 2 THEN oks + 1 ELSE 0 END,
   CASE WHEN st = 'open' THEN opened WHEN bad AND (st = 'half' OR fails + 1 >= 2) THEN us ELSE opened END,
   CASE WHEN st = 'open' THEN 'rejected' ELSE 'called' END
 FROM (SELECT x.*, f.fails, f.opened, CASE WHEN f.state = 'open' AND x.us - f.opened >= 3600000000 THEN 0 ELSE f.oks END AS oks, CASE WHEN f.state = 'open' AND x.us - f.opened >= 3600000000 THEN 'half' ELSE f.state END AS st FROM f JOIN x ON x.user_id = f.user_id AND x.k = f.k + 1))
SELECT event_id, state, res AS outcome FROM f""")
def q_circuit_breaker(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("bad", F.col("event_type") == "error")
    return control.circuit_breaker(e, "user_id", "ts", "event_id", "bad", failures=2, successes=2, timeout_seconds=3600.0).select("event_id", "state", "outcome")


# ---- sources

@query("SELECT 'http://ex.org/nation/' || n_nationkey AS s, 'http://ex.org/o#n_name' AS p, n_name AS o, 'literal' AS o_kind FROM nation")
def q_ntriples_lines(spark, sf_dir):
    """Lines written and read again by the line reader."""
    n = _t(spark, sf_dir, "nation")
    line = F.concat(F.lit("<http://ex.org/nation/"), F.col("n_nationkey").cast("string"), F.lit(f'> <{NS}n_name> "'), "n_name", F.lit('" .'))
    return rdf_source.lines_to_triples(n.select(F.lit("f").alias("file"), line.alias("line"))).select("s", "p", "o", "o_kind")


# ---- model documents, made from the tables

def _models(spark, sf_dir):
    """An interface for every brand, which extends that of its part type, as JSON documents."""
    part = _t(spark, sf_dir, "part")
    kind, brand = F.regexp_replace("p_type", "[^A-Za-z0-9]", "_"), F.regexp_replace("p_brand", "[^A-Za-z0-9]", "_")
    body = '","@type":"Interface","contents":[{"@type":"Property","name":"size","schema":"integer"},{"@type":"Telemetry","name":"heat","schema":"double"},{"@type":"Relationship","name":"ofType","target":"dtmi:trade:'
    head = '{"@context":"dtmi:dtdl:context;3","@id":"dtmi:trade:'
    types_ = part.select(F.concat(F.lit(head), kind, F.lit(';1","@type":"Interface","contents":[{"@type":"Property","name":"label","schema":"string"}]}')).alias("text"), kind.alias("file"))
    brands = part.select(F.concat(F.lit(head), kind, F.lit(":"), brand, F.lit(';1","extends":"dtmi:trade:'), kind, F.lit(";1" + body), kind, F.lit(';1"}]}')).alias("text"), kind.alias("file"))
    return types_.union(brands).distinct()


_KIND = "regexp_replace(p_type, '[^A-Za-z0-9]', '_', 'g')"
_BRAND = "regexp_replace(p_brand, '[^A-Za-z0-9]', '_', 'g')"
_HASH = "(('0x' || substr(sha256({}), 1, 16))::UBIGINT % 1000000000000 + 1000000000000)::VARCHAR"


@query(f"""WITH x AS (SELECT DISTINCT {_KIND} AS k, {_BRAND} AS b FROM part)
SELECT DISTINCT k AS file, {_HASH.format("'trade:' || k")} AS id, k AS name, NULL AS parent FROM x UNION ALL SELECT k, {_HASH.format("'trade:' || k || ':' || b")}, b, {_HASH.format("'trade:' || k")} FROM x""")
def q_model_entities(spark, sf_dir):
    from ..operators import dtdl
    from ..sources import dtdl as source

    c = dtdl.convert(source.parse(_models(spark, sf_dir)))
    return c.entities.select("file", "id", "name", F.col("baseEntityTypeId").alias("parent"))


@query(f"""WITH x AS (SELECT DISTINCT {_KIND} AS k, {_BRAND} AS b FROM part) SELECT k AS file, 'Interface' AS kind, count(*) + 1 AS n FROM x GROUP BY k
UNION ALL SELECT k, 'Property', count(*) + 1 FROM x GROUP BY k UNION ALL SELECT k, 'Telemetry', count(*) FROM x GROUP BY k UNION ALL SELECT k, 'Relationship', count(*) FROM x GROUP BY k""")
def q_model_kinds(spark, sf_dir):
    from ..operators import dtdl
    from ..sources import dtdl as source

    return dtdl.kinds(source.parse(_models(spark, sf_dir)))


@query("""WITH x AS (SELECT DISTINCT n_regionkey AS r, n_nationkey AS n FROM nation)
SELECT 'region' || r || '.cdm.json' AS file, 'Nation' || n AS entity, 'name' AS name, 'String' AS "valueType" FROM x UNION ALL SELECT 'region' || r || '.cdm.json', 'Nation' || n, 'since', 'DateTime' FROM x UNION ALL SELECT 'region' || r || '.cdm.json', 'Nation' || n, 'budget', 'Decimal' FROM x""")
def q_business_properties(spark, sf_dir):
    from ..operators import cdm
    from ..sources import cdm as source

    n = _t(spark, sf_dir, "nation")
    one = F.concat(F.lit('{"entityName":"Nation'), F.col("n_nationkey").cast("string"), F.lit('","hasAttributes":["name",{"name":"since","dataType":"date"},{"name":"budget","dataType":"money"}]}'))
    docs = n.groupBy(F.concat(F.lit("region"), F.col("n_regionkey").cast("string"), F.lit(".cdm.json")).alias("file")).agg(F.concat(F.lit('{"definitions":['), F.array_join(F.array_sort(F.collect_list(one)), ","), F.lit("]}")).alias("text"))
    c = cdm.convert(source.parse(docs))
    return c.properties.join(c.entities.select("file", F.col("id").alias("entity_id"), F.col("name").alias("entity")), ["file", "entity_id"]).select("file", "entity", "name", "valueType")
