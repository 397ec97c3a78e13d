"""From business-data documents to entities, properties and relationships; and the checks of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, names, types
from ..sources.cdm import Manifest
from . import checks, closure
from .ordered import numbered
from .rdf import NAMESPACE, Converted
from .shared import written

# What marks keys and display names.
KEY_TRAITS, KEY_PURPOSE = ("means.identity.entityId", "is.identifiedBy"), "identifiedBy"
NAME_TRAITS, NAME_PURPOSE = ("means.identity.name", "means.identity.person.fullName"), "namedBy"


def has_trait(traits: Column, *refs: str) -> Column:
    return F.exists(traits, lambda t: t["ref"].isin(*refs))


def is_key() -> Column:
    return F.coalesce(has_trait(F.col("traits"), *KEY_TRAITS), F.lit(False)) | F.coalesce(F.col("purpose") == KEY_PURPOSE, F.lit(False))


def is_display() -> Column:
    return F.coalesce(has_trait(F.col("traits"), *NAME_TRAITS), F.lit(False)) | F.coalesce(F.col("purpose") == NAME_PURPOSE, F.lit(False))


def trait_class(ref: Column) -> Column:
    """`format`, `meaning` or `constraint` of a trait by its name; null for others."""
    return F.when(F.startswith(ref, F.lit("is.dataFormat")), "format").when(F.startswith(ref, F.lit("means.")), "meaning").when(F.startswith(ref, F.lit("is.constrained")), "constraint")


def relationship_name() -> Column:
    """Given, else the verb phrase of a trait, else from_to."""
    verb = F.get(F.filter("traits", lambda t: F.contains(t["ref"], F.lit("verbPhrase"))), F.lit(0))["args"]
    own = F.concat(names.path_tail(F.col("from_entity")), F.lit("_to_"), names.path_tail(F.col("to_entity")))
    return F.coalesce("name", F.get(verb, F.lit(0))["value"], own)


def edges(m: Manifest) -> DataFrame:
    known = m.entities.select("file", F.col("entity").alias("parent"))
    e = m.entities.where("extends is not null").select("file", F.col("entity").alias("child"), names.path_tail(F.col("extends")).alias("parent"))
    return e.join(known, ["file", "parent"], "left_semi").distinct()


def convert(m: Manifest, *, flatten: bool = True, prefix: int = ids.PREFIX) -> Converted:
    """One counter per document, the first id the prefix itself: an entity, then its attributes, entity by entity; then the
    entities that only relationships name, each before the first relationship that names it, and the relationships."""
    ents = written(m.entities.dropDuplicates(["file", "entity"]).select("file", "pos", "entity", F.when(F.col("extends").isNotNull(), names.path_tail(F.col("extends"))).alias("base")), "cdm-entities")
    attrs = m.attributes.withColumnRenamed("entity", "owner")
    e = edges(m)
    if flatten:
        a = closure.inherited(attrs, e)
    else:
        a = attrs.withColumn("entity", F.col("owner")).withColumn("level", F.lit(0)).withColumn("ord", F.col("pos"))
    a = written(a.where("type not in ('entity', 'entityReference')"), "cdm-attributes")
    at = ents.select("file", "entity", F.col("pos").alias("epos"))
    rels = m.relationships.select("file", "pos", relationship_name().alias("name"), names.path_tail(F.col("from_entity")).alias("source"), names.path_tail(F.col("to_entity")).alias("target"))
    rels = numbered(rels, ["file"], ["pos", "name", "source", "target"], "k", 1)
    ends = rels.select("file", "k", F.posexplode(F.array("source", "target")).alias("side", "entity")).join(ents.select("file", "entity"), ["file", "entity"], "left_anti")
    missing = ends.groupBy("file", "entity").agg(F.min(F.struct("k", "side")).alias("x"))
    things = (
        at.select("file", F.lit(0).alias("phase"), F.col("epos").alias("a"), F.lit(-1).alias("b"), "entity", F.lit("").alias("name"))
        .union(a.join(at, ["file", "entity"]).select("file", F.lit(0), "epos", "ord", "entity", "name"))
        .union(missing.select("file", F.lit(1), F.col("x.k"), F.col("x.side") - 2, "entity", F.lit("")))
        .union(rels.select("file", F.lit(1), "k", F.lit(0), F.lit(""), "name"))
    )
    n = written(ids.numbered(things, "phase", "a", "b", "entity", partition=("file",), prefix=prefix, first=0), "cdm-ids")
    eid = n.where("(phase = 0 and b = -1) or (phase = 1 and b < 0)").select("file", "entity", "id")
    aid = n.where("phase = 0 and b >= 0").select("file", "entity", F.col("b").alias("ord"), "id")
    rid = n.where("phase = 1 and b = 0").select("file", F.col("a").alias("k"), "id")
    props = a.join(aid, ["file", "entity", "ord"]).join(eid.withColumnRenamed("id", "entity_id"), ["file", "entity"])
    traits = F.transform("traits", lambda t: t["ref"])
    props = props.select("file", "entity", "entity_id", F.col("ord").alias("pos"), "id", "name", types.cdm_type(F.col("type"), traits)["type"].alias("valueType"), F.lit(False).alias("is_timeseries"), is_key().alias("is_key"), is_display().alias("is_display"))
    props = written(props, "cdm-properties")
    marks = props.groupBy("file", "entity").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("is_key"), F.struct("pos", "id")))), lambda x: x["id"]).alias("entityIdParts"), F.min(F.when(F.col("is_display"), F.struct("pos", "id")))["id"].alias("displayNamePropertyId"))
    up = eid.select("file", F.col("entity").alias("base"), F.col("id").alias("base_id"))
    out = ents.join(eid, ["file", "entity"]).join(marks, ["file", "entity"], "left").join(up, ["file", "base"], "left")
    base = F.lit(None).cast("string") if flatten else F.col("base_id")
    entities = out.select("file", "id", F.col("entity").alias("name"), F.lit(NAMESPACE).alias("namespace"), F.lit("Custom").alias("namespaceType"), F.lit("Visible").alias("visibility"), base.alias("baseEntityTypeId"), F.coalesce("entityIdParts", F.array().cast("array<string>")).alias("entityIdParts"), "displayNamePropertyId")
    side = lambda c: eid.select("file", F.col("entity").alias(c), F.col("id").alias(f"{c}_id"))
    r = rels.join(rid, ["file", "k"]).join(side("source"), ["file", "source"]).join(side("target"), ["file", "target"])
    r = r.select("file", "id", "name", F.lit(NAMESPACE).alias("namespace"), F.lit("Custom").alias("namespaceType"), "source_id", "target_id")
    none = m.faults.select("file", F.lit("document").alias("item_type"), F.col("file").alias("name"), F.col("fault").alias("reason"), F.lit(None).cast("string").alias("uri"))
    return Converted(entities, props.drop("entity", "is_key", "is_display"), r, none)


# Words that names may not be.
RESERVED = "id type namespace version created modified entity relationship property system internal".split()


def issues(m: Manifest) -> DataFrame:
    """Checks of manifests, entities, attributes, types, relationships, inheritance and names."""
    iss, null = checks.issue, F.lit(None).cast("string")
    e, a, r = m.entities, m.attributes, m.relationships
    twice = e.groupBy("file", "entity").agg(F.count("*").alias("n")).where("n > 1")
    doubled = a.groupBy("file", "entity", "name").agg(F.count("*").alias("n")).where("n > 1")
    refs = F.transform("traits", lambda t: t["ref"])
    unknown = a.where(~types.is_cdm_type(F.col("type")) & ~F.lower("type").isin("entity", "entityid", "entityname", "attributegroup") & (types.cdm_type(F.col("type"), refs)["how"] == "default"))
    ends = r.select("file", F.explode(F.array(names.path_tail(F.col("from_entity")), names.path_tail(F.col("to_entity")))).alias("entity")).distinct().join(e.select("file", "entity"), ["file", "entity"], "left_anti")
    no_base = e.where("extends is not null").select("file", F.col("entity").alias("child"), names.path_tail(F.col("extends")).alias("entity")).join(e.select("file", "entity"), ["file", "entity"], "left_anti")
    all_edges = e.where("extends is not null").select("file", F.col("entity").alias("child"), names.path_tail(F.col("extends")).alias("parent"))
    named = e.select("file", F.col("entity").alias("name")).union(a.select("file", "name"))
    no_name = m.documents.where("kind = 'manifest' and name is null")
    empty = m.documents.where("kind in ('manifest', 'model')").join(e.select("file"), "file", "left_anti")
    bare = e.join(a.select("file", "entity"), ["file", "entity"], "left_anti")
    return checks.union([
        iss(m.faults, "cdm", "error", "syntax", "parse", F.col("fault"), null),
        iss(no_name, "cdm", "error", "manifest", "name", "the manifest has no name", null),
        iss(empty, "cdm", "warning", "manifest", "empty", "no entities", null),
        iss(twice, "cdm", "error", "name_conflict", "entity_twice", "an entity's name is used twice", F.col("entity")),
        iss(bare, "cdm", "info", "entity", "bare", "an entity without attributes", F.col("entity")),
        iss(doubled, "cdm", "error", "name_conflict", "attribute_twice", "an attribute's name is used twice", F.col("entity"), F.col("name")),
        iss(unknown, "cdm", "warning", "type", "type", F.concat(F.lit("unknown type "), F.col("type")), F.col("entity"), F.col("name")),
        iss(ends, "cdm", "warning", "reference", "end", "a relationship names an entity that is not there", F.col("entity")),
        iss(no_base, "cdm", "warning", "inheritance", "base", "the base is not there", F.col("child"), F.col("entity")),
        iss(closure.on_cycle(closure.ancestors(all_edges)), "cdm", "error", "inheritance", "cycle", "is its own ancestor", F.col("node")),
        iss(named.where(F.length("name") > 100), "cdm", "warning", "name", "length", "the name is over 100 characters", F.col("name")),
        iss(named.where(~F.col("name").rlike(r"^[\p{L}_]")), "cdm", "warning", "name", "first", "the name begins with another character than a letter", F.col("name")),
        iss(named.where(F.contains("name", F.lit(" "))), "cdm", "warning", "name", "blank", "the name has a blank", F.col("name")),
        iss(named.where(F.lower("name").isin(*RESERVED)), "cdm", "info", "name_conflict", "reserved", "the name is reserved", F.col("name")),
    ])
