"""Business-data documents (manifests, entity schemas, `model.json`) as relations, by VARIANT functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .dtdl import json_of, list_of, text_of
from .rdf import _decoded

NONE = "array<struct<ref:string,args:array<struct<name:string,value:string>>>>"


@dataclass
class Manifest:
    """documents (file, kind, name, version), entities (file, pos, entity, extends, description), attributes (file, entity,
    pos, name, type, form, purpose, max_length, nullable, traits), relationships (file, pos, name, from_entity, from_attribute,
    to_entity, to_attribute, traits), faults."""

    documents: DataFrame
    entities: DataFrame
    attributes: DataFrame
    relationships: DataFrame
    faults: DataFrame


def document_kind(path: Column, v: Column) -> Column:
    """By the file's name, else by its keys."""
    low = F.lower(path)
    has = lambda key: F.try_variant_get(v, f"$.{key}", "variant").isNotNull()
    return (
        F.when(F.endswith(low, F.lit(".manifest.cdm.json")), "manifest").when(F.endswith(low, F.lit("model.json")), "model").when(F.endswith(low, F.lit(".cdm.json")), "schema")
        .when(has("manifestName"), "manifest").when(has("definitions") | has("entityName"), "schema").when(has("entities") & has("name"), "model").otherwise("unknown")
    )


def looks_like(text: Column) -> Column:
    """Whether a JSON text is one of these documents, from its first 4096 characters, which must be all of it."""
    v = F.try_parse_json(F.substring(text, 1, 4096))
    return F.coalesce((F.length(text) <= 4096) & v.isNotNull() & (document_kind(F.lit(""), v) != "unknown"), F.lit(False))


def _traits(v: Column, path: str) -> Column:
    """Names, or objects with arguments."""
    arg = lambda a: F.struct(text_of(a, "$.name").alias("name"), F.coalesce(F.try_variant_get(a, "$.value", "string"), F.try_variant_get(a, "$", "string")).alias("value"))
    one = lambda t: F.struct(F.coalesce(text_of(t, "$"), text_of(t, "$.traitReference")).alias("ref"), F.coalesce(F.transform(list_of(t, "$.arguments"), arg), F.array().cast("array<struct<name:string,value:string>>")).alias("args"))
    return F.coalesce(F.filter(F.transform(list_of(v, path), one), lambda t: t["ref"].isNotNull()), F.array().cast(NONE))


def _attributes(rows: DataFrame) -> DataFrame:
    """(file, entity, pos, a): attribute forms: a bare name, a reference to an entity, to an attribute, or a whole one;
    references to attribute groups give none."""
    a = F.col("a")
    group = F.try_variant_get(a, "$.attributeGroupReference", "variant").isNotNull()
    kind = F.coalesce(text_of(a, "$.dataType"), text_of(a, "$.dataType.dataTypeReference"))
    form = F.when(text_of(a, "$").isNotNull(), "name").when(group, "group").when(F.try_variant_get(a, "$.entityReference", "variant").isNotNull() | F.try_variant_get(a, "$.entity", "variant").isNotNull(), "entity").when(text_of(a, "$.attributeReference").isNotNull(), "reference").otherwise("whole")
    traits = _traits(a, "$.appliedTraits")
    bound = F.get(F.filter(traits, lambda t: t["ref"] == "is.constrained.length"), F.lit(0))["args"]
    by_trait = F.get(F.filter(bound, lambda x: F.coalesce(x["name"], F.lit("maximumLength")) == "maximumLength"), F.lit(0))["value"].try_cast("int")
    return rows.withColumn("form", form).where("form <> 'group'").select(
        "file", "entity", "pos", F.coalesce(text_of(a, "$"), text_of(a, "$.name"), text_of(a, "$.attributeReference"), text_of(a, "$.entityReference"), text_of(a, "$.entity")).alias("name"),
        F.when(F.col("form") == "entity", "entity").when(F.col("form").isin("name", "reference"), "string").otherwise(F.coalesce(kind, F.lit("string"))).alias("type"), "form",
        F.coalesce(text_of(a, "$.purpose"), text_of(a, "$.purpose.purposeReference")).alias("purpose"), F.coalesce(F.try_variant_get(a, "$.maximumLength", "int"), by_trait).alias("max_length"),
        F.try_variant_get(a, "$.isNullable", "boolean").alias("nullable"), traits.alias("traits"), json_of(a, "$.attributeReference").alias("points_to"),
    ).where("name is not null")


def parse(docs: DataFrame, file: str = "file", text: str = "text") -> Manifest:
    """All documents in one plan. A manifest's entities are local references, filled by the schema documents that their path
    names by its end; a reference without a type counts for nothing."""
    d = docs.select(F.col(file).alias("file"), F.try_parse_json(F.col(text)).alias("v"))
    v = F.col("v")
    faults = d.where("v is null").select("file", F.lit("no JSON").alias("fault"))
    d = d.where("v is not null").withColumn("kind", document_kind(F.col("file"), v))
    documents = d.select("file", "kind", F.coalesce(text_of(v, "$.manifestName"), text_of(v, "$.name"), text_of(v, "$.entityName")).alias("name"), F.coalesce(text_of(v, "$.jsonSchemaSemanticVersion"), text_of(v, "$.version")).alias("version"))
    schema = d.where("kind = 'schema'")
    defs = schema.select("file", F.posexplode(F.coalesce(list_of(v, "$.definitions"), F.array("v"))).alias("pos", "x"))
    model = d.where("kind = 'model'").select("file", F.posexplode(list_of(v, "$.entities")).alias("pos", "x"))
    x = F.col("x")
    name = F.coalesce(text_of(x, "$.entityName"), text_of(x, "$.name"))
    whole = defs.union(model).withColumn("entity", name).where("entity is not null")
    ent = whole.select("file", "pos", "entity", F.coalesce(text_of(x, "$.extendsEntity"), text_of(x, "$.extendsEntity.entityReference")).alias("extends"), F.coalesce(text_of(x, "$.description"), text_of(x, "$.displayName")).alias("description"))
    attrs = _attributes(whole.select("file", "entity", F.posexplode(F.coalesce(list_of(x, "$.hasAttributes"), list_of(x, "$.attributes"))).alias("pos", "a")))
    # A manifest's references; the parts of the files that they name stand under the manifest.
    refs = d.where("kind = 'manifest'").select("file", F.posexplode(list_of(v, "$.entities")).alias("pos", "x")).withColumn("entity", text_of(x, "$.entityName")).withColumn("path", text_of(x, "$.entityPath"))
    refs = refs.where(F.lower(text_of(x, "$.type")).isin("localentity", "local", "referencedentity") & F.col("entity").isNotNull()).select("file", "pos", "entity", F.substring_index("path", "/", 1).alias("doc"))
    files = whole.select(F.col("file").alias("own"), F.substring_index("file", "/", -1).alias("doc"), "entity").distinct()
    linked = refs.join(files, ["doc", "entity"], "left")
    by_ref = linked.join(ent.select(F.col("file").alias("own"), "entity", "extends", "description"), ["own", "entity"], "left").select("file", "pos", "entity", "extends", "description")
    under = linked.where("own is not null").select("file", "own", "entity").join(attrs.withColumnRenamed("file", "own"), ["own", "entity"]).select("file", "entity", *[c for c in attrs.columns if c not in ("file", "entity")])
    named = d.where("kind = 'manifest'").select("file", F.posexplode(list_of(v, "$.relationships")).alias("pos", "r"))
    r = F.col("r")
    rels = named.select("file", "pos", text_of(r, "$.name").alias("name"), text_of(r, "$.fromEntity").alias("from_entity"), text_of(r, "$.fromEntityAttribute").alias("from_attribute"), text_of(r, "$.toEntity").alias("to_entity"), text_of(r, "$.toEntityAttribute").alias("to_attribute"), _traits(r, "$.exhibitsTraits").alias("traits"))
    points = attrs.where("form = 'whole' and points_to is not null").withColumn("p", F.try_parse_json("points_to"))
    by_attr = points.select("file", F.lit(1000).alias("pos"), F.lit(None).cast("string").alias("name"), F.col("entity").alias("from_entity"), F.col("name").alias("from_attribute"), F.coalesce(text_of(F.col("p"), "$.entityName"), text_of(F.col("p"), "$.entity")).alias("to_entity"), F.coalesce(text_of(F.col("p"), "$.attributeName"), text_of(F.col("p"), "$.attribute")).alias("to_attribute"), F.array().cast(NONE).alias("traits"))
    rels = rels.union(by_attr).where("from_entity is not null and to_entity is not null")
    return Manifest(documents, ent.unionByName(by_ref), attrs.drop("points_to").unionByName(under.drop("points_to")), rels, faults)


def preferred(docs: DataFrame) -> DataFrame:
    """Of each folder's documents (file, text): the first manifest by name with the schemas beside it, else `model.json`, else
    all schemas."""
    low, folder = F.lower("file"), F.regexp_extract("file", "^(.*/)?", 1)
    kind = F.when(low.rlike(r"\.manifest\.cdm\.json$"), 0).when(low.rlike(r"(^|/)model\.json$"), 1).when(low.rlike(r"\.cdm\.json$"), 2)
    rows = docs.withColumns({"_folder": folder, "_kind": kind}).where("_kind is not null")
    best = rows.groupBy("_folder").agg(F.min(F.struct("_kind", "file")).alias("_best"))
    taken = (F.col("_best._kind") == F.col("_kind")) & ((F.col("_kind") == 2) | (F.col("_best.file") == F.col("file"))) | ((F.col("_best._kind") == 0) & (F.col("_kind") == 2))
    return rows.join(best, "_folder").where(taken).select(*docs.columns)


def read(spark: SparkSession, path: str) -> Manifest:
    """A folder, or one file. A manifest of a folder takes its parts from the files beside it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(F.lower("path").rlike(r"(\.cdm\.json|model\.json)$"))
    return parse(preferred(files.select(F.col("path").alias("file"), _decoded(F.col("content")).alias("text"))))
