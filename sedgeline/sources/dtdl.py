"""Digital-twin model documents (JSON-LD interfaces) as relations, by VARIANT functions.

A document is an object, an array, or has `@graph`; items that are no Interface are issues. Schemas stay JSON text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .rdf import _decoded


def text_of(v: Column, path: str) -> Column:
    """A JSON string; null for anything else that stands there."""
    return F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING", F.try_variant_get(v, path, "string"))


def list_of(v: Column, path: str) -> Column:
    """An array of variants; null where there is none."""
    return F.try_variant_get(v, path, "array<variant>")


def json_of(v: Column, path: str) -> Column:
    """What stands at `path`, as JSON text; a plain string as itself."""
    return F.coalesce(text_of(v, path), F.to_json(F.try_variant_get(v, path, "variant")))


@dataclass
class Models:
    """interfaces (file, pos, dtmi, version, display, display_map, description, extends), contents (file, dtmi, pos, kind,
    semantic, name, id, schema, schema_kind, target, min_multiplicity, max_multiplicity, unit, writable, request, response,
    properties), faults (file, fault), schemas (file, dtmi, pos, id): the shared schemas of interfaces."""

    interfaces: DataFrame
    contents: DataFrame
    faults: DataFrame
    schemas: DataFrame


def kind_of(v: Column, path: str = "$") -> Column:
    """`primitive` for a type name or reference; the `@type` of a schema object; null if there is no schema."""
    p = "" if path == "$" else path
    typed = F.coalesce(text_of(v, f'{p or "$"}["@type"]'), text_of(v, f'{p or "$"}["@type"][0]'))
    return F.when(text_of(v, p or "$").isNotNull() & typed.isNull(), "primitive").otherwise(typed)


def parse(docs: DataFrame, file: str = "file", text: str = "text") -> Models:
    """Documents (file, text) to models; all documents in one plan."""
    d = docs.select(F.col(file).alias("file"), F.col(text).alias("text"), F.try_parse_json(F.col(text)).alias("v"))
    items = F.coalesce(list_of(F.col("v"), "$"), list_of(F.col("v"), '$["@graph"]'), F.array("v"))
    rows = d.where("v is not null").select("file", (list_of(F.col("v"), "$").isNotNull()).alias("listed"), F.posexplode(items).alias("pos", "x"))
    x = F.col("x")
    rows = rows.withColumn("type", text_of(x, '$["@type"]')).withColumn("dtmi", text_of(x, '$["@id"]'))
    bad = F.when(F.col("type").isNull() | (F.col("type") != "Interface"), F.concat(F.lit("item "), F.col("pos").cast("string"), F.lit(" is no Interface"))).when(F.col("dtmi").isNull(), F.concat(F.lit("item "), F.col("pos").cast("string"), F.lit(" has no @id")))
    rows = rows.withColumn("fault", bad)
    faults = d.where("v is null").select("file", F.lit("no JSON").alias("fault")).union(rows.where("fault is not null").select("file", "fault"))
    ok = rows.where("fault is null")
    context = F.coalesce(F.array(text_of(x, '$["@context"]')), F.array().cast("array<string>"))
    contexts = F.filter(F.concat(context, F.coalesce(F.transform(list_of(x, '$["@context"]'), lambda c: text_of(c, "$")), F.array().cast("array<string>"))), lambda c: c.isNotNull())
    version = F.array_max(F.transform(contexts, lambda c: F.nullif(F.regexp_extract(c, r"^dtmi:dtdl:context;(\d+)", 1), F.lit("")).cast("int")))
    parents = F.filter(F.concat(F.array(text_of(x, "$.extends")), F.coalesce(F.transform(list_of(x, "$.extends"), lambda e: text_of(e, "$")), F.array().cast("array<string>"))), lambda e: e.isNotNull())
    names = F.try_variant_get(x, "$.displayName", "map<string,string>")
    interfaces = ok.select("file", "pos", "dtmi", F.coalesce(version, F.lit(0)).alias("version"), text_of(x, "$.displayName").alias("display"), names.alias("display_map"), json_of(x, "$.description").alias("description"), parents.alias("extends"))
    c = F.col("c")
    cont = ok.select("file", "dtmi", F.posexplode(list_of(x, "$.contents")).alias("pos", "c"))
    kinds = F.coalesce(F.array(text_of(c, '$["@type"]')), F.array().cast("array<string>"))
    kinds = F.filter(F.concat(kinds, F.coalesce(F.transform(list_of(c, '$["@type"]'), lambda k: text_of(k, "$")), F.array().cast("array<string>"))), lambda k: k.isNotNull())
    contents = cont.select(
        "file", "dtmi", "pos", F.get(kinds, F.lit(0)).alias("kind"), F.slice(kinds, 2, 100).alias("semantic"), text_of(c, "$.name").alias("name"), text_of(c, '$["@id"]').alias("id"),
        F.coalesce(json_of(c, "$.schema"), F.lit("string")).alias("schema"), F.coalesce(kind_of(c, "$.schema"), F.lit("primitive")).alias("schema_kind"), text_of(c, "$.schema.valueSchema").alias("value_schema"),
        text_of(c, "$.target").alias("target"), F.try_variant_get(c, "$.minMultiplicity", "int").alias("min_multiplicity"), F.try_variant_get(c, "$.maxMultiplicity", "int").alias("max_multiplicity"),
        text_of(c, "$.unit").alias("unit"), F.try_variant_get(c, "$.writable", "boolean").alias("writable"), json_of(c, "$.request").alias("request"), json_of(c, "$.response").alias("response"), json_of(c, "$.properties").alias("properties"),
    )
    schemas = ok.select("file", "dtmi", F.posexplode(list_of(x, "$.schemas")).alias("pos", "s")).select("file", "dtmi", "pos", text_of(F.col("s"), '$["@id"]').alias("id"))
    known = F.col("kind").isin("Property", "Telemetry", "Relationship", "Component", "Command") & F.col("name").isNotNull()
    return Models(interfaces, contents.where(known & ((F.col("kind") != "Component") | (F.col("schema_kind") == "primitive"))), faults, schemas)


def read(spark: SparkSession, path: str, *, recursive: bool = True) -> Models:
    """Files `*.json` and `*.dtdl` of a folder, or one file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    files = files.where(F.lower("path").rlike(r"\.(json|dtdl)$"))
    return parse(files.select(F.col("path").alias("file"), _decoded(F.col("content")).alias("text")))


def fields_of(schema: Column) -> Column:
    """One level of an Object schema: array of (name, schema, schema_kind)."""
    v = F.try_parse_json(schema)
    return F.transform(list_of(v, "$.fields"), lambda f: F.struct(text_of(f, "$.name").alias("name"), F.coalesce(json_of(f, "$.schema"), F.lit("string")).alias("schema"), F.coalesce(kind_of(f, "$.schema"), F.lit("primitive")).alias("schema_kind")))
