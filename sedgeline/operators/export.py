"""Entities, properties and relationships as Turtle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names, types
from ..plans.lens import OWL, RDF, RDFS, XSD

BASE = "http://example.org/ontology#"


def _entity_uri(df: DataFrame, entities: DataFrame, ref: str, base: str) -> DataFrame:
    """`df` with `uri` of the entity that `ref` names by id, else by name; rows without one go."""
    by_id = entities.select("file", F.col("id").alias(ref), F.col("name").alias("n1"))
    by_name = entities.groupBy("file", F.col("name").alias(ref)).agg(F.min("name").alias("n2"))
    rows = df.join(by_id, ["file", ref], "left").join(by_name, ["file", ref], "left")
    return rows.withColumn("found", F.coalesce("n1", "n2")).where("found is not null").withColumn("uri", F.concat(F.lit(base), names.export_name(F.col("found")))).drop("n1", "n2", "found")


def triples_of(entities: DataFrame, properties: DataFrame, relationships: DataFrame, ontology: DataFrame, *, base: str = BASE) -> DataFrame:
    """(file, s, s_kind, p, o, o_kind, o_datatype). Equal names become one URI."""
    def rows(df: DataFrame, s: Column, *pairs: tuple[str, Column, str, str | None]) -> DataFrame:
        cells = [F.struct(F.lit(p).alias("p"), o.alias("o"), F.lit(k).alias("o_kind"), F.lit(d).cast("string").alias("o_datatype")) for p, o, k, d in pairs]
        return df.select("file", s.alias("s"), F.lit("iri").alias("s_kind"), F.explode(F.array(*cells)).alias("c")).select("file", "s", "s_kind", "c.*")

    uri = F.concat(F.lit(base), names.export_name(F.col("name")))
    label = (RDFS + "label", F.col("name"), "literal", XSD + "string")
    out = rows(ontology, F.lit(base.rstrip("#/")), (RDF + "type", F.lit(OWL + "Ontology"), "iri", None), (RDFS + "label", F.col("ontology"), "literal", XSD + "string"))
    out = out.union(rows(entities, uri, (RDF + "type", F.lit(OWL + "Class"), "iri", None), label))
    sub = _entity_uri(entities.where("baseEntityTypeId is not null").select("file", "name", F.col("baseEntityTypeId").alias("ref")), entities, "ref", base)
    out = out.union(rows(sub, F.concat(F.lit(base), names.export_name(F.col("name"))), (RDFS + "subClassOf", F.col("uri"), "iri", None)))
    regular = properties.where(~F.coalesce("is_timeseries", F.lit(False))).select("file", "name", "valueType", F.col("entity_id").alias("ref"))
    out = out.union(rows(_entity_uri(regular, entities, "ref", base), uri, (RDF + "type", F.lit(OWL + "DatatypeProperty"), "iri", None), label, (RDFS + "domain", F.col("uri"), "iri", None), (RDFS + "range", types.target_xsd(F.col("valueType")), "iri", None)))
    src = _entity_uri(relationships.select("file", "name", F.col("source_id").alias("ref"), "target_id"), entities, "ref", base).select("file", "name", F.col("uri").alias("from"), F.col("target_id").alias("ref"))
    both = _entity_uri(src, entities, "ref", base)
    out = out.union(rows(both, uri, (RDF + "type", F.lit(OWL + "ObjectProperty"), "iri", None), label, (RDFS + "domain", F.col("from"), "iri", None), (RDFS + "range", F.col("uri"), "iri", None)))
    return out.distinct()


def _term(value: Column, kind: Column, datatype: Column) -> Column:
    text = value
    for a, b in (("\\\\", "\\\\\\\\"), ('"', '\\\\"'), ("\n", "\\\\n"), ("\r", "\\\\r")):
        text = F.regexp_replace(text, a, b)
    quoted = F.concat(F.lit('"'), text, F.lit('"'))
    typed = F.when(datatype.isNull() | (datatype == XSD + "string"), quoted).otherwise(F.concat(quoted, F.lit("^^<"), datatype, F.lit(">")))
    return F.when(kind == "literal", typed).when(kind == "bnode", F.concat(F.lit("_:"), F.regexp_replace(value, "[^A-Za-z0-9]", "_"))).otherwise(F.concat(F.lit("<"), value, F.lit(">")))


def ntriples(t: DataFrame) -> DataFrame:
    """(file, line): each triple as a line, which is Turtle and N-Triples alike; `write.text` writes it."""
    none = F.lit(None).cast("string")
    return t.select("file", F.concat_ws(" ", _term(F.col("s"), F.col("s_kind"), none), F.concat(F.lit("<"), "p", F.lit(">")), _term(F.col("o"), F.col("o_kind"), F.col("o_datatype")), F.lit(".")).alias("line"))


def turtle(t: DataFrame) -> DataFrame:
    """(file, text): one document per file, statements grouped by subject."""
    none = F.lit(None).cast("string")
    pair = F.concat(F.lit("<"), "p", F.lit("> "), _term(F.col("o"), F.col("o_kind"), F.col("o_datatype")))
    subjects = t.groupBy("file", "s", "s_kind").agg(F.array_join(F.array_sort(F.collect_set(pair)), " ;\n    ").alias("body"))
    block = F.concat(_term(F.col("s"), F.col("s_kind"), none), F.lit("\n    "), "body", F.lit(" ."))
    return subjects.groupBy("file").agg(F.concat(F.array_join(F.array_sort(F.collect_list(block)), "\n\n"), F.lit("\n")).alias("text"))
