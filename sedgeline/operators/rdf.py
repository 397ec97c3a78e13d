"""From triples to entities, properties and relationships.

Every relation carries its document in `file`; a plan takes any number of documents. Where the meaning leaves a choice
("the first"), the least by name is taken, so that results do not depend on the order of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, names, types
from ..plans.lens import OWL, RDF, RDFS, XSD
from . import closure, keys, marks
from .shared import written

TYPE = RDF + "type"


def schema_part(t: DataFrame) -> DataFrame:
    """The triples that speak of the schema, written: everything but the instances. Converters read the instances once, for
    usage, and go over this small part for the rest."""
    vocabulary = F.startswith("p", F.lit(RDFS)) | F.startswith("p", F.lit(OWL)) | F.col("p").isin(RDF + "first", RDF + "rest")
    declared = (F.col("p") == TYPE) & (F.startswith("o", F.lit(OWL)) | F.startswith("o", F.lit(RDFS)) | (F.col("o") == RDF + "Property"))
    return written(t.where(vocabulary | declared).repartition(8, "file", "s"), "schema")


def of_type(t: DataFrame, cls: str) -> DataFrame:
    return t.where((F.col("p") == TYPE) & (F.col("o") == cls))


def classes(t: DataFrame) -> DataFrame:
    """(file, uri): IRIs declared as a class of either vocabulary, or below another class. One filter over the triples."""
    declared = (F.col("p") == TYPE) & F.col("o").isin(OWL + "Class", RDFS + "Class")
    return t.where((F.col("s_kind") == "iri") & (declared | (F.col("p") == RDFS + "subClassOf"))).select("file", F.col("s").alias("uri")).distinct()


def subclass_edges(t: DataFrame) -> DataFrame:
    """(file, child, parent) between IRIs."""
    return t.where((F.col("p") == RDFS + "subClassOf") & (F.col("s_kind") == "iri") & (F.col("o_kind") == "iri")).select("file", F.col("s").alias("child"), F.col("o").alias("parent")).distinct()


def parents(t: DataFrame) -> DataFrame:
    """(file, child, parent): at most one parent each, none that reaches a cycle."""
    return closure.chosen_parent(subclass_edges(t), classes(t).withColumnRenamed("uri", "node"))


def first_range(t: DataFrame) -> DataFrame:
    """(file, prop, range, range_kind): the least range of each property, IRIs before blank nodes."""
    r = t.where(F.col("p") == RDFS + "range").groupBy("file", F.col("s").alias("prop")).agg(F.min(F.struct((F.col("o_kind") != "iri").alias("blank"), "o", "o_kind")).alias("r"))
    return r.select("file", "prop", F.col("r.o").alias("range"), F.col("r.o_kind").alias("range_kind"))


def resolved_ends(t: DataFrame, predicate: str, members: DataFrame | None = None) -> DataFrame:
    """(file, prop, class): what domains or ranges name, class expressions resolved; only classes."""
    ends = t.where(F.col("p") == predicate).select("file", F.col("s").alias("prop"), "o", "o_kind")
    direct = ends.where("o_kind = 'iri'").select("file", "prop", F.col("o").alias("class"))
    members = closure.class_members(t, RDF, OWL) if members is None else members
    nested = ends.where("o_kind = 'bnode'").withColumnRenamed("o", "expression").join(members, ["file", "expression"]).select("file", "prop", "class")
    known = classes(t).withColumnRenamed("uri", "class")
    return direct.union(nested).distinct().join(known, ["file", "class"], "left_semi").select("file", "prop", "class")


def data_properties(t: DataFrame) -> DataFrame:
    """(file, prop, valueType, is_timeseries): declared data properties, and plain properties whose range is an XSD type.
    A range that is a union of datatypes gives the most restrictive of their types."""
    ranges = first_range(t)
    declared = of_type(t, OWL + "DatatypeProperty").select("file", F.col("s").alias("prop"))
    plain = of_type(t, RDF + "Property").select("file", F.col("s").alias("prop")).join(ranges.where(F.startswith("range", F.lit(XSD)) & (F.col("range_kind") == "iri")), ["file", "prop"], "left_semi")
    props = declared.union(plain).distinct()
    unions = datatype_unions(t)
    comment = t.where(F.col("p") == RDFS + "comment").groupBy("file", F.col("s").alias("prop")).agg(F.min("o").alias("comment"))
    out = props.join(ranges, ["file", "prop"], "left").join(unions, ["file", "prop"], "left").join(comment, ["file", "prop"], "left")
    kind = F.when(F.col("union").isNotNull(), F.col("union")).otherwise(types.xsd_type(F.col("range")))
    return out.select("file", "prop", kind.alias("valueType"), is_timeseries(F.col("comment")).alias("is_timeseries"))


def is_timeseries(comment: Column) -> Column:
    return F.coalesce(F.contains(F.lower(comment), F.lit("(timeseries)")), F.lit(False))


def datatype_unions(t: DataFrame) -> DataFrame:
    """(file, prop, union): the type of a property whose range is a blank union of datatypes."""
    blank = t.where((F.col("p") == RDFS + "range") & (F.col("o_kind") == "bnode")).select("file", F.col("s").alias("prop"), F.col("o").alias("node"))
    lists = t.where(F.col("p").isin(OWL + "unionOf", OWL + "oneOf") & (F.col("o_kind") == "bnode")).select("file", F.col("s").alias("node"), F.col("o").alias("list"))
    found = blank.join(lists, ["file", "node"])
    members = closure.list_members(t, RDF, found.select("file", "list"))
    kinds = found.join(members, ["file", "list"]).where(F.startswith("member", F.lit(XSD))).groupBy("file", "prop").agg(F.collect_set(types.xsd_type(F.col("member"))).alias("kinds"))
    return kinds.select("file", "prop", types.union_type(F.col("kinds")).alias("union"))


def attached(t: DataFrame, props: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Data properties on the classes of their domains: one row per (class, property)."""
    return props.join(resolved_ends(t, RDFS + "domain", members), ["file", "prop"]).select("file", "class", "prop", "valueType", "is_timeseries")


def object_properties(t: DataFrame, attached_props: DataFrame) -> DataFrame:
    """(file, prop): declared object properties, and plain properties with a range that is no XSD type, but those that are
    attached as data properties."""
    ranges = first_range(t).where((F.col("range_kind") == "iri") & ~F.startswith("range", F.lit(XSD)))
    plain = of_type(t, RDF + "Property").select("file", F.col("s").alias("prop")).join(ranges, ["file", "prop"], "left_semi")
    plain = plain.join(attached_props.select("file", "prop"), ["file", "prop"], "left_anti")
    return of_type(t, OWL + "ObjectProperty").select("file", F.col("s").alias("prop")).union(plain).distinct()


#: Name spaces that are told apart in a broadcast; of how many nodes one is looked at in the first reading.
SPACES, SHARE = 1 << 16, 1 << 10


def usage(t: DataFrame, props: DataFrame, known: DataFrame | None = None, most: int = marks.MOST, spaces: int = SPACES, share: int = SHARE) -> DataFrame:
    """(file, prop, end, class): classes of the subjects and objects that use a property, from the instances. `props` (file,
    prop) asks for both ends, or for one a row with a column `end`.

    Up to `most` ends and classes are bits of a node; more of them are joined by node. Classes are those of the document.
    The first reading puts the bits of all nodes of a name space together, which says what pairs may occur, and those of one
    node in `share`, which shows pairs that do. A second one goes node by node, for the ends, classes and name spaces of pairs
    that may occur and were not shown; so every pair is decided by nodes, and few nodes are exchanged."""
    if "end" not in props.columns:
        props = props.select("file", "prop", F.explode(F.array(F.lit("domain"), F.lit("range"))).alias("end"))
    props = written(props.select("file", "prop", "end").distinct().coalesce(1), "asked-ends")
    known = written((classes(t) if known is None else known).select("file", F.col("uri").alias("class")).distinct(), "known-classes")
    ends = written(marks.coded(props.select("prop", "end").distinct()), "end-codes")
    kinds = written(marks.coded(known.select("class").distinct()), "class-codes")
    n, m = ends.count(), kinds.count()
    if n + m > most or not n or not m:
        return _usage_by_join(t, props, known)
    es, ks = marks.words(F.col("code"), n), marks.words(F.col("code"), m)
    en, kn = [f"e{i}" for i in range(len(es))], [f"k{i}" for i in range(len(ks))]
    bits = [F.bit_or(c).alias(c) for c in en + kn]
    some = lambda names: " or ".join(f"{c} <> 0" for c in names)
    both = f"({some(en)}) and ({some(kn)})"

    def marked(ends: DataFrame, kinds: DataFrame) -> DataFrame:
        """(file, node, space, bits): a row for each end that a triple uses, and for each type."""
        sides = ends.select(F.col("prop").alias("p"), (F.col("end") == "domain").alias("of_s"), *[x.alias(c) for x, c in zip(es, en, strict=True)])
        types_ = ends.sparkSession.range(1).select(F.lit(TYPE).alias("p"), F.lit(None).cast("boolean").alias("of_s"), *[F.lit(0).cast("long").alias(c) for c in en])
        kind = kinds.select(F.col("class").alias("type"), *[x.alias(c) for x, c in zip(ks, kn, strict=True)])
        names_ = lambda df, c: [r[0] for r in df.select(c).distinct().collect()]
        asked = F.col("p").isin(names_(ends, "prop")) | ((F.col("p") == TYPE) & F.col("o").isin(names_(kinds, "class")))  # few names, which spare most rows the joins
        rows = t.where((F.col("o_kind") == "iri") & asked).select("file", "s", "p", "o").join(F.broadcast(sides.union(types_)), "p")
        rows = rows.withColumn("type", F.when(F.col("of_s").isNull(), F.col("o"))).join(F.broadcast(kind), "type", "left").where("of_s is not null or k0 is not null")
        node = F.when(F.col("of_s").isNull() | F.col("of_s"), F.col("s")).otherwise(F.col("o"))
        return rows.select("file", node.alias("node"), name_space(node).alias("space"), *en, *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in kn])

    def pairs(sets: DataFrame, *keep: str) -> DataFrame:
        out = sets.select("file", *keep, F.explode(marks.codes(en)).alias("e"), *[c for c in kn if c not in keep]).distinct()
        return out.select("file", *keep, "e", F.explode(marks.codes(kn)).alias("k")).distinct()

    rows = marked(ends, kinds)
    some_nodes = F.when(F.pmod(F.xxhash64("node"), F.lit(share)) == 0, F.col("node"))
    near = written(rows.groupBy("file", "space", some_nodes.alias("node")).agg(*bits), "spaces")
    shown = written(pairs(near.where("node is not null").where(both).select("file", *en, *kn).distinct()), "shown-pairs")
    near = written(near.groupBy("file", "space").agg(*bits).where(both), "spaces")
    unseen = pairs(near.select("file", *en, *kn).distinct(), *en, *kn).join(shown, ["file", "e", "k"], "left_anti")
    unseen = written(unseen, "unseen-pairs")
    found = shown
    if not unseen.isEmpty():
        of = lambda codes, c: codes.join(unseen.select(F.col(c).alias("code")).distinct(), "code", "left_semi")
        rest = marked(of(ends, "e"), of(kinds, "k"))
        where = near.join(unseen.select("file", *en, *kn).distinct(), ["file", *en, *kn], "left_semi").select("file", "space")
        if near.count() <= spaces:
            rest = rest.join(F.broadcast(where), ["file", "space"], "left_semi")
        found = found.union(pairs(rest.groupBy("file", "node").agg(*bits).where(both).select("file", *en, *kn).distinct())).distinct()
    found = found.join(F.broadcast(ends.withColumnRenamed("code", "e")), "e").join(F.broadcast(kinds.withColumnRenamed("code", "k")), "k")
    return found.join(props, ["file", "prop", "end"], "left_semi").join(known, ["file", "class"], "left_semi").select("file", "prop", "end", "class")


def name_space(node: Column) -> Column:
    """What a node's name has before and with its last / or #."""
    own = F.substring_index(F.substring_index(node, "/", -1), "#", -1)
    return F.left(node, F.length(node) - F.length(own))


def _usage_by_join(t: DataFrame, asked: DataFrame, known: DataFrame) -> DataFrame:
    """The used pairs are reduced to distinct (property, node) before the join with the nodes' classes."""
    used = t.where("o_kind = 'iri'").select("file", F.col("p").alias("prop"), F.explode(F.array(F.struct(F.lit("domain").alias("end"), F.col("s").alias("node")), F.struct(F.lit("range").alias("end"), F.col("o").alias("node")))).alias("e"))
    ends = used.select("file", "prop", "e.end", "e.node").join(asked, ["file", "prop", "end"], "left_semi").distinct()
    kinds = t.where((F.col("p") == TYPE) & (F.col("o_kind") == "iri")).select("file", F.col("s").alias("node"), F.col("o").alias("class"))
    return ends.join(kinds, ["file", "node"]).select("file", "prop", "end", "class").distinct().join(known, ["file", "class"], "left_semi").select("file", "prop", "end", "class")


def property_ends(t: DataFrame, props: DataFrame, schema: DataFrame | None = None, members: DataFrame | None = None) -> DataFrame:
    """(file, prop, end, class): declared ends; where an end has none, the least class of its usage. The instances are asked
    for these ends only."""
    schema = t if schema is None else schema
    declared = None
    for end in ("domain", "range"):
        rows = resolved_ends(schema, RDFS + end, members).join(props, ["file", "prop"], "left_semi").select("file", "prop", F.lit(end).alias("end"), "class")
        declared = rows if declared is None else declared.union(rows)
    declared = written(declared, "declared-ends")
    both = props.select("file", "prop", F.explode(F.array(F.lit("domain"), F.lit("range"))).alias("end"))
    asked = both.join(declared, ["file", "prop", "end"], "left_anti")
    fallback = usage(t, asked, classes(schema)).groupBy("file", "prop", "end").agg(F.min("class").alias("class"))
    return written(declared.union(fallback.select("file", "prop", "end", "class")), "ends")


def relationship_pairs(ends: DataFrame) -> DataFrame:
    """(file, prop, source, target): every pair of a property's domain and range classes, once: a join on the property."""
    side = lambda end, name: ends.where(F.col("end") == end).select("file", "prop", F.col("class").alias(name))
    return side("domain", "source").join(side("range", "target"), ["file", "prop"]).distinct()


def skipped(props: DataFrame, ends: DataFrame) -> DataFrame:
    """(file, item_type, name, reason, uri) of properties that lack an end."""
    have = ends.groupBy("file", "prop").agg(F.count_if(F.col("end") == "domain").alias("d"), F.count_if(F.col("end") == "range").alias("r"))
    rows = props.join(have, ["file", "prop"], "left").fillna(0, ["d", "r"]).where("d = 0 or r = 0")
    why = F.when((F.col("d") == 0) & (F.col("r") == 0), "missing domain and range").when(F.col("d") == 0, "missing domain").otherwise("missing range")
    return rows.select("file", F.lit("relationship").alias("item_type"), names.uri_name(F.col("prop")).alias("name"), why.alias("reason"), F.col("prop").alias("uri"))


@dataclass
class Converted:
    """The relations of converted documents."""

    entities: DataFrame
    properties: DataFrame
    relationships: DataFrame
    skipped: DataFrame
    schema: DataFrame | None = None  # of triples: the part that speaks of the schema


NAMESPACE = "usertypes"


def convert(t: DataFrame, *, prefix: int = ids.PREFIX) -> Converted:
    """Entities, properties and relationships with ids in order: classes, data properties, relationship pairs, by URI."""
    instances, t = t, schema_part(t)
    members = written(closure.class_members(t, RDF, OWL), "expressions")
    cls = classes(t)
    props = written(data_properties(t), "data-properties")
    on = written(attached(t, props, members), "attached")
    obj = object_properties(t, on)
    ends = property_ends(instances, obj, t, members)
    pairs = relationship_pairs(ends)
    # one numbering over all that takes an id, document by document
    things = (
        cls.select("file", F.lit(0).alias("phase"), F.col("uri").alias("key"), F.lit("").alias("a"), F.lit("").alias("b"))
        .union(props.select("file", F.lit(1), "prop", F.lit(""), F.lit("")))
        .union(pairs.select("file", F.lit(2), "prop", "source", "target"))
    )
    numbered = ids.numbered(things, "phase", "key", "a", "b", partition=("file",), prefix=prefix)
    numbered = written(numbered, "ids")
    of = lambda phase, *cols: numbered.where(F.col("phase") == phase).select("file", *cols, "id")
    class_ids = of(0, F.col("key").alias("uri"))
    up = parents(t).join(class_ids.select("file", F.col("uri").alias("parent"), F.col("id").alias("baseEntityTypeId")), ["file", "parent"])
    entities = class_ids.join(up.select("file", F.col("child").alias("uri"), "baseEntityTypeId"), ["file", "uri"], "left")
    prop_ids = of(1, F.col("key").alias("prop"))
    properties = on.join(prop_ids, ["file", "prop"]).join(class_ids.select("file", F.col("uri").alias("class"), F.col("id").alias("entity_id")), ["file", "class"])
    place = Window.partitionBy("file", "entity_id").orderBy("prop")
    properties = properties.select("file", "entity_id", (F.row_number().over(place) - 1).alias("pos"), "id", names.uri_name(F.col("prop")).alias("name"), "valueType", "is_timeseries", F.col("prop").alias("uri"))
    properties = written(properties, "properties")
    parts = keys.last_key(properties)
    entities = entities.join(parts, ["file", "id"], "left").select("file", "id", names.uri_name(F.col("uri")).alias("name"), F.lit(NAMESPACE).alias("namespace"), F.lit("Custom").alias("namespaceType"), F.lit("Visible").alias("visibility"), "baseEntityTypeId", F.coalesce("entityIdParts", F.array().cast("array<string>")).alias("entityIdParts"), "displayNamePropertyId", "uri")
    entities = written(entities, "entities")
    rel_ids = of(2, F.col("key").alias("prop"), F.col("a").alias("source"), F.col("b").alias("target"))
    end = lambda name: class_ids.select("file", F.col("uri").alias(name), F.col("id").alias(f"{name}_id"))
    rel = pairs.join(rel_ids, ["file", "prop", "source", "target"]).join(end("source"), ["file", "source"]).join(end("target"), ["file", "target"])
    rel = rel.select("file", "id", names.uri_name(F.col("prop")).alias("name"), F.lit(NAMESPACE).alias("namespace"), F.lit("Custom").alias("namespaceType"), "source_id", "target_id", F.col("prop").alias("uri"))
    return Converted(entities, properties, rel, skipped(obj, ends), t)


def ontology_names(t: DataFrame) -> DataFrame:
    """(file, ontology): the sanitised label of the least ontology node, else a fixed name; from the triples, without a
    second parse."""
    named = of_type(t, OWL + "Ontology").groupBy("file").agg(F.min("s").alias("s"))
    label = named.join(t.where(F.col("p") == RDFS + "label").select("file", "s", "o"), ["file", "s"], "left").groupBy("file").agg(F.min("o").alias("label"))
    files = t.select("file").distinct()
    return files.join(label, "file", "left").select("file", names.ontology_name(F.coalesce("label", F.lit(""))).alias("ontology"))
