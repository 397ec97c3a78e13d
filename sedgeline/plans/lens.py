"""The test tables seen as a graph: instance triples by a direct mapping, and a schema over them.

The schema leaves some domains and ranges out, has a union domain, a cycle, and constructs that checks speak of, so that
every operator has work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NS, DATA = "http://ex.org/o#", "http://ex.org/"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
TYPE = RDF + "type"

# table: class, key columns, {column: XSD type}, {foreign key: (predicate, table)}
TABLES = {
    "region": ("Region", ["r_regionkey"], {"r_name": "string"}, {}),
    "nation": ("Nation", ["n_nationkey"], {"n_name": "string"}, {"n_regionkey": ("inRegion", "region")}),
    "customer": ("Customer", ["c_custkey"], {"c_name": "string", "c_acctbal": "double", "c_mktsegment": "token"}, {"c_nationkey": ("ofNation", "nation")}),
    "supplier": ("Supplier", ["s_suppkey"], {"s_name": "string", "s_acctbal": "double"}, {"s_nationkey": ("ofNation", "nation")}),
    "part": ("Part", ["p_partkey"], {"p_name": "string", "p_brand": "string", "p_size": "int", "p_retailprice": "decimal"}, {}),
    "orders": ("Order", ["o_orderkey"], {"o_orderstatus": "string", "o_orderpriority": "string"}, {"o_custkey": ("placedBy", "customer")}),
    "lineitem": ("LineItem", ["l_orderkey", "l_linenumber"], {"l_returnflag": "string", "l_linenumber": "int"}, {"l_orderkey": ("ofOrder", "orders"), "l_partkey": ("ofPart", "part"), "l_suppkey": ("bySupplier", "supplier")}),
    "events": ("Event", ["event_id"], {"event_type": "string", "user_id": "long"}, {}),
}
CLASSES = {t: c for t, (c, _, _, _) in TABLES.items()}


def schema_rows() -> list[tuple]:
    """(s, s_kind, p, o, o_kind, o_datatype) of the fixed part of the schema."""
    out: list[tuple] = []
    iri = lambda s, p, o: out.append((s, "iri", p, o, "iri", None))
    blank = lambda s, p, o, kind="iri": out.append((s, "bnode", p, o, kind, None))
    for _, (cls, _, cols, keys) in TABLES.items():
        iri(NS + cls, TYPE, OWL + "Class")
        for col, xsd in cols.items():
            iri(NS + col, TYPE, OWL + "DatatypeProperty")
            if col != "p_brand":  # no domain: stays unattached
                iri(NS + col, RDFS + "domain", NS + cls)
            if col != "o_orderpriority":  # no range: String
                iri(NS + col, RDFS + "range", XSD + xsd)
        for _, (pred, other) in keys.items():
            iri(NS + pred, TYPE, OWL + "ObjectProperty")
            if pred not in ("ofNation", "ofPart"):
                iri(NS + pred, RDFS + "domain", NS + cls)
            if pred not in ("ofNation", "placedBy", "ofPart"):
                iri(NS + pred, RDFS + "range", NS + CLASSES[other])
    # a property with a union domain, as a list of two classes
    iri(NS + "acctbal", TYPE, RDF + "Property")
    iri(NS + "acctbal", RDFS + "range", XSD + "double")
    out.append((NS + "acctbal", "iri", RDFS + "domain", "u1", "bnode", None))
    blank("u1", TYPE, OWL + "Class")
    blank("u1", OWL + "unionOf", "l1", "bnode")
    blank("l1", RDF + "first", NS + "Customer")
    blank("l1", RDF + "rest", "l2", "bnode")
    blank("l2", RDF + "first", NS + "Supplier")
    blank("l2", RDF + "rest", RDF + "nil")
    # properties without a usable end
    iri(NS + "lostBoth", TYPE, OWL + "ObjectProperty")
    iri(NS + "lostRange", TYPE, OWL + "ObjectProperty")
    iri(NS + "lostRange", RDFS + "domain", NS + "Order")
    iri(NS + "toNowhere", TYPE, OWL + "ObjectProperty")
    iri(NS + "toNowhere", RDFS + "domain", NS + "Order")
    iri(NS + "toNowhere", RDFS + "range", NS + "Undeclared")
    iri(NS + "sameTeam", TYPE, OWL + "ObjectProperty")
    iri(NS + "sameTeam", RDFS + "domain", NS + "Customer")
    iri(NS + "sameTeam", RDFS + "range", NS + "Customer")
    # time series by comment
    iri(NS + "reading", TYPE, OWL + "DatatypeProperty")
    iri(NS + "reading", RDFS + "domain", NS + "Event")
    iri(NS + "reading", RDFS + "range", XSD + "double")
    out.append((NS + "reading", "iri", RDFS + "comment", "value of an event (TimeSeries)", "literal", XSD + "string"))
    # a cycle, and a class below it
    for a, b in (("CycleA", "CycleB"), ("CycleB", "CycleA"), ("BelowCycle", "CycleA"), ("Premium", "Customer"), ("Vip", "Premium")):
        iri(NS + a, RDFS + "subClassOf", NS + b)
    iri(NS + "Premium", TYPE, RDFS + "Class")
    # what checks speak of
    iri(DATA + "onto", TYPE, OWL + "Ontology")
    out.append((DATA + "onto", "iri", RDFS + "label", "Trade catalogue", "literal", XSD + "string"))
    iri(DATA + "onto", OWL + "imports", "http://other.example/onto")
    iri(NS + "placedBy", TYPE, OWL + "FunctionalProperty")
    iri(NS + "sameTeam", TYPE, OWL + "SymmetricProperty")
    iri(NS + "sameTeam", OWL + "inverseOf", NS + "sameTeam")
    iri(NS + "Order", OWL + "disjointWith", NS + "Part")
    iri(NS + "Order", OWL + "equivalentClass", NS + "Purchase")
    out.append((NS + "Order", "iri", RDFS + "subClassOf", "r1", "bnode", None))
    blank("r1", TYPE, OWL + "Restriction")
    blank("r1", OWL + "onProperty", NS + "placedBy")
    out.append(("r1", "bnode", OWL + "minCardinality", "1", "literal", XSD + "nonNegativeInteger"))
    out.append((NS + "Part", "iri", OWL + "intersectionOf", "i1", "bnode", None))
    blank("i1", RDF + "first", NS + "Order")
    blank("i1", RDF + "rest", RDF + "nil")
    iri(NS + "note", TYPE, OWL + "AnnotationProperty")
    iri(DATA + "nation/0", TYPE, OWL + "NamedIndividual")
    iri(DATA + "nation/0", OWL + "sameAs", DATA + "nation/zero")
    return out


SCHEMA_DDL = "s string, s_kind string, p string, o string, o_kind string, o_datatype string"


def hierarchy(part: DataFrame) -> DataFrame:
    """Part, its types, and their brands: (child, parent) of three levels."""
    part = part.select("p_type", "p_brand").distinct()
    kind = F.concat(F.lit(NS), F.regexp_replace("p_type", "[^A-Za-z0-9]", "_"))
    brand = F.concat(kind, F.lit("_"), F.regexp_replace("p_brand", "[^A-Za-z0-9]", "_"))
    edge = lambda child, parent: F.struct(child.alias("child"), parent.alias("parent"))
    return part.select(F.inline(F.array(edge(kind, F.lit(NS + "Part")), edge(brand, kind)))).where("child is not null").distinct()


def schema_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = spark.createDataFrame(schema_rows(), SCHEMA_DDL)
    tree = hierarchy(spark.read.parquet(f"{sf_dir}/part.parquet"))
    none = F.lit(None).cast("string")
    below = tree.select(F.col("child").alias("s"), F.lit("iri").alias("s_kind"), F.lit(RDFS + "subClassOf").alias("p"), F.col("parent").alias("o"), F.lit("iri").alias("o_kind"), none.alias("o_datatype"))
    return fixed.union(below).distinct()


def subject(table: str, columns: list[str]) -> F.Column:
    return F.concat(F.lit(f"{DATA}{table}/"), F.concat_ws("-", *[F.col(c).cast("string") for c in columns]))


def instance_triples(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = tuple(TABLES), *, literals: bool = True, apart: bool = False) -> DataFrame:
    """One pass over each table: every row gives its type, its literals and its references. Without literals only the columns
    of keys and references are read. `apart` gives the same triples with each predicate of a table as a branch of its own: what
    asks for few predicates or classes goes over their branches and columns, the others are constants that do not fit."""
    out = None
    none = F.lit(None).cast("string")
    for t in tables:
        cls, keys, cols, refs = TABLES[t]
        cells = [F.struct(F.lit(TYPE).alias("p"), F.lit(NS + cls).alias("o"), F.lit("iri").alias("o_kind"), none.alias("o_datatype"))]
        cells += [F.struct(F.lit(NS + c).alias("p"), F.col(c).cast("string").alias("o"), F.lit("literal").alias("o_kind"), F.lit(XSD + x).alias("o_datatype")) for c, x in cols.items() if literals]
        cells += [F.struct(F.lit(NS + p).alias("p"), subject(other, [c]).alias("o"), F.lit("iri").alias("o_kind"), none.alias("o_datatype")) for c, (p, other) in refs.items()]
        df = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        for c in cells if apart else [F.explode(F.array(*cells))]:
            rows = df.select(subject(t, keys).alias("s"), c.alias("c")).select("s", F.lit("iri").alias("s_kind"), "c.*").where("o is not null")
            out = rows if out is None else out.unionByName(rows)
    return out


def triples(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = tuple(TABLES), *, apart: bool = False) -> DataFrame:
    """Schema and instances as one document."""
    return schema_triples(spark, sf_dir).unionByName(instance_triples(spark, sf_dir, tables, apart=apart)).withColumn("file", F.lit("lens")).withColumn("o_lang", F.lit(None).cast("string"))


def _q(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


def schema_sql() -> str:
    """The schema as a SQL query over `part`, of DuckDB."""
    values = ", ".join("(" + ", ".join(map(_q, r)) + ")" for r in schema_rows())
    kind = "regexp_replace(p_type, '[^A-Za-z0-9]', '_', 'g')"
    brand = "regexp_replace(p_brand, '[^A-Za-z0-9]', '_', 'g')"
    sub = f"'iri' AS s_kind, '{RDFS}subClassOf' AS p"
    return (
        f"SELECT * FROM (VALUES {values}) AS v(s, s_kind, p, o, o_kind, o_datatype)"
        f" UNION SELECT '{NS}' || {kind}, {sub}, '{NS}Part', 'iri', NULL FROM part"
        f" UNION SELECT '{NS}' || {kind} || '_' || {brand}, {sub}, '{NS}' || {kind}, 'iri', NULL FROM part"
    )


def _subject_sql(table: str, columns: list[str]) -> str:
    return f"'{DATA}{table}/' || " + " || '-' || ".join(f"{c}::VARCHAR" for c in columns)


def instance_sql(tables: tuple[str, ...] = tuple(TABLES)) -> str:
    parts = []
    for t in tables:
        cls, keys, cols, refs = TABLES[t]
        s = _subject_sql(t, keys)
        parts.append(f"SELECT {s} AS s, 'iri' AS s_kind, '{TYPE}' AS p, '{NS}{cls}' AS o, 'iri' AS o_kind, NULL AS o_datatype FROM {t}")
        parts += [f"SELECT {s}, 'iri', '{NS}{c}', {c}::VARCHAR, 'literal', '{XSD}{x}' FROM {t}" for c, x in cols.items()]
        parts += [f"SELECT {s}, 'iri', '{NS}{p}', {_subject_sql(o, [c])}, 'iri', NULL FROM {t}" for c, (p, o) in refs.items()]
    return " UNION ALL ".join(parts)


def triples_sql(tables: tuple[str, ...] = tuple(TABLES)) -> str:
    return f"SELECT * FROM ({schema_sql()}) UNION ALL SELECT * FROM ({instance_sql(tables)})"
