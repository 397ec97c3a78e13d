"""Checks as issue relations: (file, source, severity, category, code, message, uri, details).

Each check is a plan over triples, entities, properties or relationships; a report is a union of checks and its roll-ups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names, types
from ..plans.lens import OWL, RDF, RDFS, XSD
from . import rdf, serialize

ISSUE = ["file", "source", "severity", "category", "code", "message", "uri", "details"]


def issue(df: DataFrame, source: str, severity: str | Column, category: str, code: str, message: str | Column, uri: Column, details: Column | None = None) -> DataFrame:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return df.select("file", F.lit(source).alias("source"), as_col(severity).alias("severity"), F.lit(category).alias("category"), F.lit(code).alias("code"), as_col(message).alias("message"), uri.alias("uri"), (details if details is not None else F.lit(None).cast("string")).alias("details"))


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- before a conversion of triples

FACETS = "someValuesFrom allValuesFrom hasValue minCardinality maxCardinality cardinality minQualifiedCardinality maxQualifiedCardinality qualifiedCardinality".split()
CHARACTERISTICS = "FunctionalProperty InverseFunctionalProperty TransitiveProperty SymmetricProperty AsymmetricProperty ReflexiveProperty IrreflexiveProperty".split()
PROPERTY_KINDS = [OWL + "DatatypeProperty", OWL + "ObjectProperty", RDF + "Property"]


def _p(t: DataFrame, *predicates: str) -> DataFrame:
    return t.where(F.col("p").isin(*predicates))


def declared_properties(t: DataFrame) -> DataFrame:
    return t.where((F.col("p") == RDF + "type") & F.col("o").isin(*PROPERTY_KINDS)).select("file", F.col("s").alias("prop")).distinct()


def imports(t: DataFrame) -> DataFrame:
    return issue(_p(t, OWL + "imports"), "rdf", "warning", "external_import", "imports", "imports another ontology", F.col("o"))


def class_expressions(t: DataFrame) -> DataFrame:
    rows = _p(t, OWL + "intersectionOf", OWL + "complementOf", OWL + "oneOf")
    return issue(rows, "rdf", "warning", "unsupported_construct", "class_expression", F.concat(F.lit("class expression "), names.local_name(F.col("p"))), F.col("s"))


def restrictions(t: DataFrame) -> DataFrame:
    nodes = rdf.of_type(t, OWL + "Restriction").select("file", "s")
    facets = _p(t, *[OWL + f for f in FACETS]).groupBy("file", "s").agg(F.array_join(F.array_sort(F.collect_set(names.local_name(F.col("p")))), ", ").alias("facets"))
    on = _p(t, OWL + "onProperty").groupBy("file", "s").agg(F.min("o").alias("on"))
    rows = nodes.distinct().join(facets, ["file", "s"], "left").join(on, ["file", "s"], "left")
    return issue(rows, "rdf", "warning", "property_restriction", "restriction", F.concat(F.lit("restriction on "), F.coalesce(names.local_name(F.col("on")), F.lit("nothing"))), F.col("on"), F.col("facets"))


def characteristics(t: DataFrame) -> DataFrame:
    rows = t.where((F.col("p") == RDF + "type") & F.col("o").isin(*[OWL + c for c in CHARACTERISTICS]))
    return issue(rows, "rdf", "info", "property_characteristic", "characteristic", names.local_name(F.col("o")), F.col("s"))


def property_axioms(t: DataFrame) -> DataFrame:
    rows = _p(t, OWL + "propertyChainAxiom", OWL + "equivalentProperty", OWL + "inverseOf")
    severity = F.when(F.col("p") == OWL + "propertyChainAxiom", "warning").otherwise("info")
    return issue(rows, "rdf", severity, "unsupported_construct", "property_axiom", names.local_name(F.col("p")), F.col("s"))


def class_axioms(t: DataFrame) -> DataFrame:
    rows = _p(t, OWL + "equivalentClass", OWL + "disjointWith").where("s_kind = 'iri'")
    some = issue(rows, "rdf", "info", "unsupported_construct", "class_axiom", names.local_name(F.col("p")), F.col("s"))
    return some.unionByName(issue(rdf.of_type(t, OWL + "AllDisjointClasses"), "rdf", "info", "unsupported_construct", "class_axiom", "AllDisjointClasses", F.col("s")))


def signatures(t: DataFrame) -> DataFrame:
    """Properties without domain or range; else with an undeclared domain, or a range neither declared nor an XSD type."""
    props = declared_properties(t)
    cls = rdf.classes(t).withColumnRenamed("uri", "o").withColumn("known", F.lit(1))
    ends = _p(t, RDFS + "domain", RDFS + "range").select("file", F.col("s").alias("prop"), (F.col("p") == RDFS + "domain").alias("is_domain"), "o", "o_kind").join(cls, ["file", "o"], "left")
    odd = F.col("o_kind").eqNullSafe("iri") & F.col("known").isNull() & (F.col("is_domain") | ~F.startswith("o", F.lit(XSD)))
    have = ends.groupBy("file", "prop").agg(F.count_if("is_domain").alias("d"), F.count_if(~F.col("is_domain")).alias("r"), F.array_join(F.array_sort(F.collect_set(F.when(odd, F.col("o")))), ", ").alias("odd"))
    rows = props.join(have, ["file", "prop"], "left").fillna(0, ["d", "r"])
    lacks = rows.where("d = 0 or r = 0")
    what = F.concat_ws(" and ", F.when(F.col("d") == 0, "domain"), F.when(F.col("r") == 0, "range"))
    out = issue(lacks, "rdf", "warning", "missing_signature", "missing_signature", F.concat(F.lit("no "), what), F.col("prop"))
    return out.unionByName(issue(rows.where("d > 0 and r > 0 and odd <> ''"), "rdf", "warning", "missing_signature", "undeclared_end", "names a class that is not declared", F.col("prop"), F.col("odd")))


def datatypes(t: DataFrame) -> DataFrame:
    ranges = _p(t, RDFS + "range").where(F.startswith("o", F.lit(XSD)) & ~F.col("o").isin(*[XSD + x for x in types.CHECKED_XSD]))
    some = issue(ranges, "rdf", "info", "unsupported_datatype", "datatype", names.local_name(F.col("o")), F.col("s"))
    blank = _p(t, RDFS + "range").where("o_kind = 'bnode'").select("file", "s", F.col("o").alias("n"))
    unions = blank.join(_p(t, OWL + "unionOf").select("file", F.col("s").alias("n")), ["file", "n"], "left_semi")
    return some.unionByName(issue(unions, "rdf", "info", "unsupported_datatype", "datatype_union", "a union of datatypes", F.col("s")))


def counted(t: DataFrame) -> DataFrame:
    """One row for each of individuals, identity statements, annotation properties and reified statements that a file has."""
    kinds = {
        "NamedIndividual": ("info", "individual", (F.col("p") == RDF + "type") & (F.col("o") == OWL + "NamedIndividual")),
        "sameAs": ("info", "individual", F.col("p") == OWL + "sameAs"),
        "differentFrom": ("info", "individual", F.col("p") == OWL + "differentFrom"),
        "AnnotationProperty": ("info", "annotation", (F.col("p") == RDF + "type") & (F.col("o") == OWL + "AnnotationProperty")),
        "Statement": ("warning", "reification", (F.col("p") == RDF + "type") & (F.col("o") == RDF + "Statement")),
    }
    sums = t.groupBy("file").agg(*[F.count_if(test).alias(k) for k, (_, _, test) in kinds.items()])
    cells = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(s).alias("s"), F.lit(c).alias("c"), F.col(k).alias("n")) for k, (s, c, _) in kinds.items()])
    rows = sums.select("file", F.explode(cells).alias("x")).where("x.n > 0")
    return rows.select("file", F.lit("rdf").alias("source"), F.col("x.s").alias("severity"), F.col("x.c").alias("category"), F.lit("count").alias("code"), F.concat("x.k", F.lit(": "), F.col("x.n").cast("string")).alias("message"), F.lit(None).cast("string").alias("uri"), F.lit(None).cast("string").alias("details"))


def faults(parsed: DataFrame) -> DataFrame:
    """Documents that could not be read."""
    return issue(parsed.where("fault is not null"), "rdf", "error", "syntax", "parse", F.col("fault"), F.lit(None).cast("string"))


def preflight(t: DataFrame) -> DataFrame:
    """All checks of triples."""
    return union([f(t) for f in (imports, class_expressions, restrictions, characteristics, property_axioms, class_axioms, signatures, datatypes, counted)])


# ---- roll-ups

def by_severity_category(issues: DataFrame) -> DataFrame:
    """Counts by severity, by category and by both, and in all: one pass with grouping sets. Totals are null."""
    return issues.cube("severity", "category").agg(F.count("*").alias("n"))


def report(issues: DataFrame) -> DataFrame:
    """(file, errors, warnings, infos, seamless)."""
    c = lambda s: F.count_if(F.col("severity") == s)
    return issues.groupBy("file").agg(c("error").alias("errors"), c("warning").alias("warnings"), c("info").alias("infos")).withColumn("seamless", (F.col("errors") == 0) & (F.col("warnings") == 0))


def strict(issues: DataFrame) -> DataFrame:
    """Warnings as errors."""
    return issues.withColumn("severity", F.when(F.col("severity") == "warning", "error").otherwise(F.col("severity")))


def readable(issues: DataFrame, most: int = 10) -> DataFrame:
    """(file, text): the first `most` messages of each category."""
    w = Window.partitionBy("file", "category").orderBy("severity", "message", "uri")
    rows = issues.withColumn("k", F.row_number().over(w)).groupBy("file", "category").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("k") <= most, F.struct("k", "severity", "message", "uri")))).alias("top"))
    line = lambda x: F.concat(F.lit("  "), F.upper(x["severity"]), F.lit(" "), x["message"], F.coalesce(F.concat(F.lit(" <"), x["uri"], F.lit(">")), F.lit("")))
    text = F.concat("category", F.lit(" ("), F.col("n").cast("string"), F.lit(")\n"), F.array_join(F.transform("top", line), "\n"))
    return rows.groupBy("file").agg(F.array_join(F.array_sort(F.collect_list(text)), "\n").alias("text"))


# ---- converted definitions

def dangling(relationships: DataFrame, entities: DataFrame) -> DataFrame:
    """Ends of relationships that no entity has: an anti-join."""
    ends = relationships.select("file", "name", F.explode(F.array(F.struct(F.lit("source").alias("end"), F.col("source_id").alias("id")), F.struct(F.lit("target").alias("end"), F.col("target_id").alias("id")))).alias("e")).select("file", "name", "e.*")
    rows = ends.join(entities.select("file", "id"), ["file", "id"], "left_anti")
    return issue(rows, "definition", "error", "reference", "dangling", F.concat(F.col("end"), F.lit(" is no entity")), F.col("name"), F.col("id"))


def self_references(relationships: DataFrame) -> DataFrame:
    return issue(relationships.where("source_id = target_id"), "definition", "warning", "reference", "self", "source and target are the same", F.col("name"), F.col("source_id"))


def definition_issues(entities: DataFrame, properties: DataFrame, relationships: DataFrame) -> DataFrame:
    """Parents, display properties and key parts that are missing or of the wrong kind, and relationship ends."""
    child = entities.where("baseEntityTypeId is not null").select("file", "name", "id", F.col("baseEntityTypeId").alias("up"))
    no_parent = child.join(entities.select("file", F.col("id").alias("up")), ["file", "up"], "left_anti")
    own = properties.select("file", F.col("entity_id").alias("id"), F.col("id").alias("pid"), "valueType")
    shown = entities.where("displayNamePropertyId is not null").select("file", "name", "id", F.col("displayNamePropertyId").alias("pid")).join(own, ["file", "id", "pid"], "left")
    parts = entities.select("file", "name", "id", F.explode("entityIdParts").alias("pid")).join(own, ["file", "id", "pid"], "left")
    return union([
        issue(no_parent, "definition", "error", "reference", "parent", "the parent is no entity", F.col("name"), F.col("up")),
        issue(child.where("id = up"), "definition", "error", "reference", "own_parent", "the entity is its own parent", F.col("name"), F.col("up")),
        issue(shown.where("valueType is null"), "definition", "error", "reference", "display", "the display property is none of the entity", F.col("name"), F.col("pid")),
        issue(shown.where("valueType <> 'String'"), "definition", "warning", "type", "display_type", "the display property is no String", F.col("name"), F.col("pid")),
        issue(parts.where("valueType is null"), "definition", "error", "reference", "key", "a key part is none of the entity", F.col("name"), F.col("pid")),
        issue(parts.where("valueType not in ('String', 'BigInt')"), "definition", "warning", "type", "key_type", "a key part is neither String nor BigInt", F.col("name"), F.col("pid")),
        dangling(relationships, entities),
        self_references(relationships),
    ])


# Limits by profile.
LIMITS = {
    "service": {"name": 26, "entities": 500, "relationships": 500, "properties": 200, "key_parts": 5, "warn_kb": 768, "max_kb": 1024},
    "payload": {"name": 256, "entities": 500, "relationships": 500, "properties": 200, "key_parts": 5, "warn_kb": 768, "max_kb": 1024},
    "model": {"name": 256, "entities": 1000, "relationships": 1000, "properties": 100, "key_parts": 50, "warn_kb": 3072, "max_kb": 4000},
}


def limit_issues(entities: DataFrame, properties: DataFrame, relationships: DataFrame, profile: str = "service") -> DataFrame:
    """Counts (over nine tenths a warning, over the limit an error), name lengths, key parts, size."""
    lim = LIMITS[profile]

    def counts(df: DataFrame, what: str, key: Column, most: int) -> DataFrame:
        rows = df.where(F.col("n") > 0.9 * most)
        severity = F.when(F.col("n") > most, "error").otherwise("warning")
        return issue(rows, "limits", severity, "limit", what, F.concat(F.lit(f"{what} of {most}: "), F.col("n").cast("string")), key)

    def lengths(df: DataFrame, what: str) -> DataFrame:
        return issue(df.where(F.length("name") > lim["name"]), "limits", "error", "limit", f"{what}_name", F.concat(F.lit(f"name over {lim['name']} characters: "), F.length("name").cast("string")), F.col("name"))

    per = properties.groupBy("file", F.col("entity_id").alias("id")).agg(F.count("*").alias("n")).join(entities.select("file", "id", "name"), ["file", "id"])
    size = serialize.definition_size(entities, properties, relationships)
    kb = F.when(F.col("kb") > lim["max_kb"], "error").otherwise("warning")
    return union([
        counts(entities.groupBy("file").agg(F.count("*").alias("n")), "entities", F.lit(None).cast("string"), lim["entities"]),
        counts(relationships.groupBy("file").agg(F.count("*").alias("n")), "relationships", F.lit(None).cast("string"), lim["relationships"]),
        counts(per, "properties", F.col("name"), lim["properties"]),
        issue(entities.where(F.size("entityIdParts") > lim["key_parts"]), "limits", "error", "limit", "key_parts", "too many key parts", F.col("name")),
        lengths(entities, "entity"), lengths(properties, "property"), lengths(relationships, "relationship"),
        issue(size.where(F.col("kb") > lim["warn_kb"]), "limits", kb, "limit", "size", F.concat(F.lit("KB: "), F.format_number("kb", 1)), F.lit(None).cast("string")),
    ])


# What payloads may say.
PAYLOAD_TYPES = "String BigInt Double Decimal Boolean DateTime Binary Guid".split()
RESERVED = ("system",)


def payload_issues(parts: DataFrame, reserved: tuple[str, ...] = RESERVED) -> DataFrame:
    """Checks of a finished definition: part fields, encoding, keys, ids, names, enumerations, types, references. Vendors'
    own namespaces are given with `reserved`."""
    d = serialize.decoded_parts(parts)
    e, p, r = serialize.relations_of(parts)
    null = F.lit(None).cast("string")
    named = e.select("file", "id", "name", "namespace", "namespaceType", "visibility", F.lit("entity").alias("k")).unionByName(r.select("file", "id", "name", "namespace", "namespaceType", F.lit("Visible").alias("visibility"), F.lit("relationship").alias("k")))
    return union([
        issue(d.where("path is null or trim(path) = ''"), "payload", "error", "part", "path", "a part has no path", null),
        issue(d.where("payloadType is null or payloadType <> 'InlineBase64'"), "payload", "error", "part", "payload_type", "the payload type is not InlineBase64", F.col("path")),
        issue(d.where("json is null"), "payload", "error", "part", "payload", "the payload is no base64 JSON", F.col("path")),
        issue(named.where("id is null or name is null or namespace is null"), "payload", "error", "keys", "required", F.concat(F.col("k"), F.lit(" lacks id, name or namespace")), F.coalesce("name", "id")),
        issue(named.where(~F.col("id").rlike("^[0-9]+$")), "payload", "error", "id", "number", "the id is no number", F.col("id")),
        issue(named.where(F.length("name") > 256), "payload", "error", "name", "length", "the name is over 256 characters", F.col("name")),
        issue(named.where(F.lower("namespace").isin(*reserved)), "payload", "error", "namespace", "reserved", "the namespace is reserved", F.col("namespace")),
        issue(named.where("namespaceType not in ('Custom', 'System') or visibility not in ('Visible', 'Hidden')"), "payload", "error", "enum", "enum", "an enumeration has another value", F.col("name")),
        issue(e.where("baseEntityTypeId is null"), "payload", "warning", "keys", "parent", "no parent", F.col("name")),
        issue(p.where(~F.col("valueType").isin(*PAYLOAD_TYPES)), "payload", "error", "type", "value_type", F.concat(F.lit("unknown type "), F.col("valueType")), F.col("name")),
        dangling(r, e).withColumn("source", F.lit("payload")).withColumn("severity", F.lit("warning")),
    ])


# ---- compliance

# What becomes of constructs.
SUPPORT = {
    "full": "Class subClassOf DatatypeProperty ObjectProperty domain range".split(),
    "partial": "unionOf intersectionOf oneOf".split(),
    "none": "Restriction allValuesFrom someValuesFrom hasValue cardinality minCardinality maxCardinality qualifiedCardinality FunctionalProperty InverseFunctionalProperty TransitiveProperty SymmetricProperty AsymmetricProperty ReflexiveProperty IrreflexiveProperty inverseOf propertyChainAxiom complementOf equivalentClass disjointWith disjointUnionOf equivalentProperty propertyDisjointWith imports NamedIndividual sameAs differentFrom".split(),
    "metadata": "versionInfo label comment".split(),
}
MODEL_SUPPORT = {
    "full": "Interface Property Relationship extends".split(),
    "partial": "Telemetry Component displayName Object Array Enum Map point lineString polygon scaledDecimal".split(),
    "none": "description comment Command writable unit semanticType minMultiplicity maxMultiplicity".split(),
}


def support_table(spark: SparkSession, table: dict[str, list[str]] = SUPPORT) -> DataFrame:
    return spark.createDataFrame(sorted((f, s) for s, fs in table.items() for f in fs), "feature string, support string")


def features(t: DataFrame) -> DataFrame:
    """(file, feature, n): constructs by name, as types and as predicates."""
    vocab = lambda c: F.startswith(c, F.lit(OWL)) | F.startswith(c, F.lit(RDFS))
    typed = (F.col("p") == RDF + "type") & vocab(F.col("o"))
    return t.where(typed | vocab(F.col("p"))).groupBy("file", names.local_name(F.when(typed, F.col("o")).otherwise(F.col("p"))).alias("feature")).agg(F.count("*").alias("n"))


def feature_report(counts: DataFrame, table: dict[str, list[str]] = SUPPORT) -> DataFrame:
    """(file, feature, n) to (file, full, partial, none, metadata, unknown): counts by what becomes of the constructs."""
    rows = counts.join(F.broadcast(support_table(counts.sparkSession, table)), "feature", "left").fillna("unknown", ["support"])
    return rows.groupBy("file").pivot("support", ["full", "partial", "none", "metadata", "unknown"]).agg(F.sum("n")).fillna(0)


def owl_compliance(t: DataFrame) -> DataFrame:
    """Coded findings: restrictions, individuals, domains and ranges, constructs, imports."""
    props = declared_properties(t)
    cls = rdf.classes(t).withColumnRenamed("uri", "o")
    ends = lambda p: _p(t, p).where("o_kind = 'iri'").select("file", F.col("s").alias("prop"), "o")
    no_domain = props.join(_p(t, RDFS + "domain").select("file", F.col("s").alias("prop")), ["file", "prop"], "left_anti")
    no_range = props.join(_p(t, RDFS + "range").select("file", F.col("s").alias("prop")), ["file", "prop"], "left_anti")
    undeclared = ends(RDFS + "domain").union(ends(RDFS + "range").where(~F.startswith("o", F.lit(XSD)))).join(cls, ["file", "o"], "left_anti")
    construct = {"OWL030": "equivalentClass", "OWL031": "disjointWith", "OWL032": "propertyChainAxiom", "OWL033": "hasKey"}
    parts = [
        issue(rdf.of_type(t, OWL + "Restriction"), "compliance", "warning", "construct", "OWL001", "restrictions are not kept", F.col("s")),
        issue(rdf.of_type(t, OWL + "NamedIndividual"), "compliance", "info", "instance", "OWL010", "individuals are not kept", F.col("s")),
        issue(no_domain, "compliance", "warning", "signature", "OWL020", "no domain", F.col("prop")),
        issue(no_range, "compliance", "warning", "signature", "OWL021", "no range", F.col("prop")),
        issue(undeclared, "compliance", "warning", "signature", "OWL022", "an undeclared class", F.col("prop"), F.col("o")),
        issue(_p(t, OWL + "imports"), "compliance", "warning", "import", "OWL040", "imports are not followed", F.col("o")),
    ]
    parts += [issue(t.where((F.col("p") == OWL + k) | ((F.col("p") == RDF + "type") & (F.col("o") == OWL + k))), "compliance", "info", "construct", code, k, F.col("s")) for code, k in construct.items()]
    return union(parts)


def class_property_counts(t: DataFrame) -> DataFrame:
    """(file, class, data, object): properties by domain, one aggregate."""
    kinds = t.where((F.col("p") == RDF + "type") & F.col("o").isin(OWL + "DatatypeProperty", OWL + "ObjectProperty")).select("file", F.col("s").alias("prop"), (F.col("o") == OWL + "DatatypeProperty").alias("is_data")).distinct()
    dom = _p(t, RDFS + "domain").where("o_kind = 'iri'").select("file", F.col("s").alias("prop"), F.col("o").alias("class")).distinct()
    counts = dom.join(kinds, ["file", "prop"]).groupBy("file", "class").agg(F.count_if("is_data").alias("data"), F.count_if(~F.col("is_data")).alias("object"))
    return rdf.classes(t).withColumnRenamed("uri", "class").join(counts, ["file", "class"], "left").fillna(0, ["data", "object"])


def converted_compliance(entities: DataFrame, properties: DataFrame, relationships: DataFrame) -> DataFrame:
    """Coded findings on converted types: names, properties, keys, ends."""
    per = properties.groupBy("file", F.col("entity_id").alias("id")).agg(F.count("*").alias("n")).join(entities.select("file", "id", "name"), ["file", "id"])
    lim = LIMITS["model"]
    return union([
        issue(entities.where(~names.is_valid_name(F.col("name"))), "compliance", "error", "name", "TGT001", "not a valid name", F.col("name")),
        issue(entities.where(F.length("name") > lim["name"]), "compliance", "error", "name", "TGT002", "the name is too long", F.col("name")),
        issue(per.where(F.col("n") > lim["properties"]), "compliance", "warning", "limit", "TGT003", "many properties", F.col("name")),
        issue(properties.where(~F.col("valueType").isin(*PAYLOAD_TYPES)), "compliance", "error", "type", "TGT010", "unknown type", F.col("name")),
        dangling(relationships, entities).withColumn("code", F.lit("TGT020")).withColumn("source", F.lit("compliance")),
        issue(relationships.where(~names.is_valid_name(F.col("name"))), "compliance", "error", "name", "TGT021", "not a valid name", F.col("name")),
    ])
