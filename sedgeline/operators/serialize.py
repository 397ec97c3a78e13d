"""Definitions: entities and relationships as ordered parts of base64 JSON, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values
from . import closure
from .ordered import numbered


def quoted(x: Column) -> Column:
    """A JSON string; null as `null`."""
    one = F.to_json(F.struct(x.cast("string").alias("x")))
    return F.when(x.isNull(), "null").otherwise(F.substring(one, 6, 1 << 30).substr(F.lit(1), F.length(one) - 6))


def _block(items: list[Column], depth: int, open_: str = "{", close: str = "}") -> Column:
    pad, end = "\n" + "  " * (depth + 1), "\n" + "  " * depth
    parts: list[Column] = [F.lit(open_ + pad)]
    for i, x in enumerate(items):
        parts += ([F.lit("," + pad)] if i else []) + [x]
    return F.concat(*parts, F.lit(end + close))


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}": '), value)


def _array(items: Column, depth: int) -> Column:
    """A JSON array of texts that are JSON already, indented by two."""
    pad, end = "\n" + "  " * (depth + 1), "\n" + "  " * depth
    return F.when(F.size(items) == 0, "[]").otherwise(F.concat(F.lit("[" + pad), F.array_join(items, "," + pad), F.lit(end + "]")))


def property_json(p: Column, depth: int) -> Column:
    return _block([_field("id", quoted(p["id"])), _field("name", quoted(p["name"])), _field("redefines", F.lit("null")), _field("baseTypeNamespaceType", F.lit("null")), _field("valueType", quoted(p["valueType"]))], depth)


def entity_json() -> Column:
    """An entity row (with array columns `properties`, `timeseries`) as JSON, two blanks a level. The parent is always there;
    key parts, display name and property lists only when they say something."""
    opt = lambda test, name, value: F.when(test, F.concat(F.lit(",\n  "), _field(name, value))).otherwise("")
    lists = lambda c: _array(F.transform(F.col(c), lambda p: property_json(p, 2)), 1)
    head = F.concat(F.lit("{\n  "), F.concat_ws(",\n  ", _field("id", quoted(F.col("id"))), _field("namespace", quoted(F.col("namespace"))), _field("baseEntityTypeId", quoted(F.col("baseEntityTypeId"))), _field("name", quoted(F.col("name"))), _field("namespaceType", quoted(F.col("namespaceType"))), _field("visibility", quoted(F.col("visibility")))))
    return F.concat(
        head,
        opt(F.size("entityIdParts") > 0, "entityIdParts", _array(F.transform("entityIdParts", lambda x: quoted(x)), 1)),
        opt(F.col("displayNamePropertyId").isNotNull(), "displayNamePropertyId", quoted(F.col("displayNamePropertyId"))),
        opt(F.size("properties") > 0, "properties", lists("properties")),
        opt(F.size("timeseries") > 0, "timeseriesProperties", lists("timeseries")),
        F.lit("\n}"),
    )


def relationship_json() -> Column:
    end = lambda c: _block([_field("entityTypeId", quoted(F.col(c)))], 1)
    return _block([_field("namespace", quoted(F.col("namespace"))), _field("id", quoted(F.col("id"))), _field("name", quoted(F.col("name"))), _field("namespaceType", quoted(F.col("namespaceType"))), _field("source", end("source_id")), _field("target", end("target_id"))], 0)


def with_lists(entities: DataFrame, properties: DataFrame) -> DataFrame:
    """Entities with their property lists in order; time series apart."""
    item = F.struct("pos", "id", "name", "valueType")
    ts = F.coalesce(F.col("is_timeseries"), F.lit(False))
    lists = properties.groupBy("file", "entity_id").agg(F.array_sort(F.collect_list(F.when(~ts, item))).alias("properties"), F.array_sort(F.collect_list(F.when(ts, item))).alias("timeseries"))
    none = F.array().cast("array<struct<pos:int,id:string,name:string,valueType:string>>")
    out = entities.join(lists.withColumnRenamed("entity_id", "id"), ["file", "id"], "left")
    return out.withColumn("properties", F.coalesce("properties", none)).withColumn("timeseries", F.coalesce("timeseries", none))


def definition_parts(entities: DataFrame, properties: DataFrame, relationships: DataFrame, ontology: DataFrame) -> DataFrame:
    """(file, ord, path, payload, payloadType): platform and definition parts, entities parents first, relationships."""
    edges = entities.where("baseEntityTypeId is not null").select("file", F.col("id").alias("child"), F.col("baseEntityTypeId").alias("parent"))
    order = closure.topological(entities.select("file", F.col("id").alias("node")), edges).withColumnRenamed("node", "id")
    text = F.concat(F.lit('{\n  "metadata": {\n    "type": "Ontology",\n    "displayName": '), quoted(F.col("ontology")), F.lit("\n  }\n}"))
    none = F.lit("").alias("by")
    first = ontology.select("file", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("k"), none, F.lit(".platform").alias("path"), text.alias("json"))
    second = ontology.select("file", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("k"), none, F.lit("definition.json").alias("path"), F.lit("{}").alias("json"))
    ents = with_lists(entities, properties).join(order, ["file", "id"]).select("file", F.lit(2).alias("kind"), F.col("ord").cast("long").alias("k"), none, F.concat(F.lit("EntityTypes/"), "id", F.lit("/definition.json")).alias("path"), entity_json().alias("json"))
    rels = relationships.select("file", F.lit(3).alias("kind"), F.lit(0).cast("long").alias("k"), F.col("id").alias("by"), F.concat(F.lit("RelationshipTypes/"), "id", F.lit("/definition.json")).alias("path"), relationship_json().alias("json"))
    rows = numbered(first.union(second).union(ents).union(rels), ["file"], ["kind", "k", "by", "path"], "ord")
    return rows.select("file", F.col("ord").cast("int").alias("ord"), "path", F.regexp_replace(values.encoded(F.col("json")), "[\r\n]", "").alias("payload"), F.lit("InlineBase64").alias("payloadType"))


def definition_size(entities: DataFrame, properties: DataFrame, relationships: DataFrame) -> DataFrame:
    """(file, kb): the size of the JSON of both lists, with their separators."""
    rows = with_lists(entities, properties).select("file", F.octet_length(entity_json()).alias("n")).union(relationships.select("file", F.octet_length(relationship_json()).alias("n")))
    return rows.groupBy("file").agg(((F.sum(F.col("n") + 2) + 4) / 1024.0).alias("kb"))


def decoded_parts(parts: DataFrame) -> DataFrame:
    """Parts with their payload as `json` text (null where it is not base64 JSON) and `kind` by path."""
    text = values.decoded(F.col("payload"))
    kind = F.when(F.contains("path", F.lit("EntityTypes/")), "entity").when(F.contains("path", F.lit("RelationshipTypes/")), "relationship").when(F.endswith("path", F.lit(".platform")), "platform").when(F.endswith("path", F.lit("definition.json")), "definition").otherwise("other")
    return parts.withColumn("json", F.when(F.try_parse_json(text).isNotNull(), text)).withColumn("kind", kind)


_PROP = "struct<id:string,name:string,valueType:string>"
_ENTITY = f"struct<id:string,name:string,namespace:string,namespaceType:string,visibility:string,baseEntityTypeId:string,entityIdParts:array<string>,displayNamePropertyId:string,properties:array<{_PROP}>,timeseriesProperties:array<{_PROP}>>"
_REL = "struct<id:string,name:string,namespace:string,namespaceType:string,source:struct<entityTypeId:string>,target:struct<entityTypeId:string>>"


def relations_of(parts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities, properties and relationships of a definition's parts; parts that cannot be read are left out."""
    d = decoded_parts(parts)
    e = d.where("kind = 'entity' and json is not null").select("file", F.from_json("json", _ENTITY).alias("e"))
    none = F.array().cast("array<string>")
    entities = e.select("file", "e.id", "e.name", "e.namespace", "e.namespaceType", "e.visibility", "e.baseEntityTypeId", F.coalesce("e.entityIdParts", none).alias("entityIdParts"), "e.displayNamePropertyId")
    plists = None
    for field, ts in (("properties", False), ("timeseriesProperties", True)):
        rows = e.select("file", F.col("e.id").alias("entity_id"), F.posexplode(f"e.{field}").alias("pos", "p")).select("file", "entity_id", "pos", "p.id", "p.name", "p.valueType", F.lit(ts).alias("is_timeseries"))
        plists = rows if plists is None else plists.union(rows)
    r = d.where("kind = 'relationship' and json is not null").select("file", F.from_json("json", _REL).alias("r"))
    rels = r.select("file", "r.id", "r.name", "r.namespace", "r.namespaceType", F.col("r.source.entityTypeId").alias("source_id"), F.col("r.target.entityTypeId").alias("target_id"))
    return entities, plists, rels


def parts_of_document(spark: SparkSession, text: str, file: str = "definition") -> DataFrame:
    """The parts of a definition document, wrapped in `definition` or bare."""
    df = spark.createDataFrame([(file, text)], "file string, text string")
    part = "array<struct<path:string,payload:string,payloadType:string>>"
    found = df.select("file", F.from_json("text", f"struct<definition:struct<parts:{part}>,parts:{part}>").alias("d"))
    return found.select("file", F.posexplode(F.coalesce("d.definition.parts", "d.parts")).alias("ord", "x")).select("file", "ord", "x.*")
