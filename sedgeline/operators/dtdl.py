"""From digital-twin models to entities, properties and relationships, with the modes for components, commands and scaled
decimals; and the checks of models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, names, types
from ..sources.dtdl import Models, fields_of, list_of, text_of
from . import checks, closure, keys
from .rdf import NAMESPACE, Converted
from .shared import written

COMPONENTS, COMMANDS, DECIMALS = ("skip", "flatten", "separate"), ("skip", "property", "entity"), ("json_string", "structured", "calculated")


def value_type(schema: Column, kind: Column, value_schema: Column, *, decimals: str = "json_string") -> Column:
    """The target type of a schema: of an Enum that of its values; complex schemas are text; calculated decimals are numbers."""
    number = F.lit("Double" if decimals == "calculated" else "String")
    return F.when((kind == "scaledDecimal") | (schema == "scaledDecimal"), number).when(kind == "primitive", types.dtdl_type(schema)).when(kind == "Enum", types.dtdl_type(F.coalesce(value_schema, F.lit("integer")))).otherwise("String")


def rich_type(schema: Column, kind: Column, value_schema: Column, semantic: Column, unit: Column) -> Column:
    """Struct (type, is_complex, is_array, semantic, semantic_schema, unit, json_schema)."""
    return F.struct(value_type(schema, kind, value_schema).alias("type"), kind.isin("Object", "Map", "Array").alias("is_complex"), (kind == "Array").alias("is_array"), F.get(semantic, F.lit(0)).alias("semantic"), types.semantic_schema(F.get(semantic, F.lit(0))).alias("semantic_schema"), unit.alias("unit"), F.when(kind != "primitive", schema).alias("json_schema"))


def flattened_fields(contents: DataFrame) -> DataFrame:
    """Object-valued contents by field, one level: (file, dtmi, pos, name `content_field`, valueType)."""
    rows = contents.where("schema_kind = 'Object'").select("file", "dtmi", "pos", "name", F.posexplode(fields_of(F.col("schema"))).alias("i", "f"))
    return rows.select("file", "dtmi", "pos", "i", F.concat("name", F.lit("_"), "f.name").alias("name"), value_type(F.col("f.schema"), F.col("f.schema_kind"), F.lit(None).cast("string")).alias("valueType"))


def edges(m: Models) -> DataFrame:
    """All (child, parent) within the set."""
    e = m.interfaces.select("file", F.col("dtmi").alias("child"), F.explode("extends").alias("parent")).distinct()
    return e.join(m.interfaces.select("file", F.col("dtmi").alias("parent")), ["file", "parent"], "left_semi").select("file", "child", "parent")


def resolved_names(props: DataFrame, up: DataFrame, order: DataFrame) -> DataFrame:
    """Names where one name has several types: a property whose name an ancestor has with another type, or that is seen
    first elsewhere with another type, gets `_type`. Seen first: by topological order, properties before telemetry, position."""
    of = props.select("file", "dtmi", "name", "valueType", "phase", "pos").join(order.withColumnRenamed("node", "dtmi"), ["file", "dtmi"], "left")
    above = up.where("node <> ancestor").select("file", F.col("node").alias("dtmi"), F.col("ancestor"), "level")
    held = above.join(props.where("phase = 0").select("file", F.col("dtmi").alias("ancestor"), "name", F.col("valueType").alias("t")), ["file", "ancestor"])
    held = held.groupBy("file", "dtmi", "name").agg(F.max_by("t", "level").alias("ancestor_type"))  # the farthest ancestor counts
    w = Window.partitionBy("file", "name").orderBy("ord", "phase", "pos")
    out = of.join(held, ["file", "dtmi", "name"], "left").withColumn("first_type", F.first("valueType").over(w))
    clash = (F.col("ancestor_type").isNotNull() & (F.col("ancestor_type") != F.col("valueType"))) | (F.col("first_type") != F.col("valueType"))
    return out.select("file", "dtmi", "phase", "pos", F.when(clash, F.concat("name", F.lit("_"), F.lower("valueType"))).otherwise(F.col("name")).alias("shown"))


_PROPERTY = ["file", "entity_id", "k", "pos", "id", "name", "valueType", "is_timeseries"]


def convert(m: Models, *, components: str = "skip", commands: str = "skip", decimals: str = "json_string", prefix: int = ids.PREFIX) -> Converted:
    """Ids are hashes of identifiers, so that references need no look-up; ends without an interface dangle, as checks say."""
    for mode, allowed in ((components, COMPONENTS), (commands, COMMANDS), (decimals, DECIMALS)):
        if mode not in allowed:
            raise ValueError(f"unknown mode {mode}")
    i = written(m.interfaces.dropDuplicates(["file", "dtmi"]), "interfaces")
    c = written(m.contents.join(i.select("file", "dtmi"), ["file", "dtmi"], "left_semi"), "contents")
    m = Models(i, c, m.faults, m.schemas)
    e = edges(m)
    up, order = closure.ancestors(e), closure.topological(i.select("file", F.col("dtmi").alias("node")), e)
    owner = ids.hash_id(F.col("dtmi"), prefix)
    data = c.where("kind in ('Property', 'Telemetry')").withColumn("phase", F.when(F.col("kind") == "Property", 0).otherwise(1)).withColumn("valueType", value_type(F.col("schema"), F.col("schema_kind"), F.col("value_schema"), decimals=decimals))
    shown = resolved_names(data, up, order)
    ts = F.col("phase") == 1
    p = data.join(shown, ["file", "dtmi", "phase", "pos"]).select("file", owner.alias("entity_id"), F.lit(0).alias("k"), "pos", ids.member_id(owner, F.when(ts, F.concat(F.lit("ts_"), "name")).otherwise(F.col("name"))).alias("id"), names.model_name(F.col("shown")).alias("name"), "valueType", ts.alias("is_timeseries"))
    string = lambda df, k, key, name, kind="String": df.select("file", owner.alias("entity_id"), F.lit(k).alias("k"), "pos", ids.member_id(owner, key).alias("id"), name.alias("name"), F.lit(kind).alias("valueType"), F.lit(False).alias("is_timeseries"))
    cmd, comp = c.where("kind = 'Command'"), c.where("kind = 'Component'")
    entities_more, rels = [], []
    if commands == "property":
        p = p.unionByName(string(cmd, 1, F.concat(F.lit("cmd_"), "name"), F.concat(F.lit("command_"), "name")))
    if components == "flatten":
        inner = c.where("kind = 'Property'").select("file", F.col("dtmi").alias("schema"), F.col("pos").alias("q"), F.col("name").alias("inner"), F.col("schema").alias("s2"), F.col("schema_kind").alias("sk2"), F.col("value_schema").alias("vs2"))
        flat = comp.select("file", "dtmi", "pos", "name", "schema").join(inner, ["file", "schema"])
        full = F.concat("name", F.lit("_"), "inner")
        p = p.unionByName(flat.select("file", owner.alias("entity_id"), F.lit(2).alias("k"), (F.col("pos") * 1000 + F.col("q")).alias("pos"), ids.member_id(owner, F.concat(F.lit("comp_"), full)).alias("id"), names.model_name(full).alias("name"), value_type(F.col("s2"), F.col("sk2"), F.col("vs2")).alias("valueType"), F.lit(False).alias("is_timeseries")))
    if decimals == "structured":
        dec = c.where("kind = 'Property' and (schema_kind = 'scaledDecimal' or schema = 'scaledDecimal')")
        for suffix, kind in (("_scale", "BigInt"), ("_value", "String")):
            full = F.concat("name", F.lit(suffix))
            p = p.unionByName(string(dec, 3, full, names.model_name(full), kind))
    rel = c.where("kind = 'Relationship' and target is not null")
    rels.append(rel.select("file", ids.member_id(owner, F.concat(F.lit("rel_"), "name")).alias("id"), names.model_name(F.col("name")).alias("name"), owner.alias("source_id"), ids.hash_id(F.col("target"), prefix).alias("target_id")))
    if components == "separate":
        rels.append(comp.select("file", ids.member_id(owner, F.concat(F.lit("comp_"), "name")).alias("id"), names.model_name(F.concat(F.lit("has_"), "name")).alias("name"), owner.alias("source_id"), ids.hash_id(F.col("schema"), prefix).alias("target_id")))
        stub = comp.join(i.select("file", F.col("dtmi").alias("schema")), ["file", "schema"], "left_anti").select("file", "pos", F.col("schema").alias("dtmi"), names.model_name(F.concat("name", F.lit("_"), names.dtmi_name(F.col("schema")))).alias("stub")).groupBy("file", "dtmi").agg(F.min("stub").alias("stub"), F.min("pos").alias("pos"))
        p = p.unionByName(string(stub, 4, F.lit("componentId"), F.lit("componentId")))
        entities_more.append(stub.select("file", owner.alias("id"), F.col("stub").alias("name")))
    if commands == "entity":
        own = F.coalesce("id", F.concat(F.substring_index("dtmi", ";", 1), F.lit(":cmd:"), "name"))  # no version inside, so that the id is the command's own
        ce = cmd.select("file", "pos", "dtmi", F.col("name").alias("cmd"), own.alias("own"), "request", "response")
        rels.append(ce.select("file", ids.member_id(owner, F.concat(F.lit("cmd_rel_"), "cmd")).alias("id"), names.model_name(F.concat(F.lit("supports_"), "cmd")).alias("name"), owner.alias("source_id"), ids.hash_id(F.col("own"), prefix).alias("target_id")))
        body = ce.select("file", "pos", F.col("own").alias("dtmi"), "cmd", "request", "response")
        p = p.unionByName(string(body, 5, F.lit("commandName"), F.lit("commandName")))
        for k, side in ((6, "request"), (8, "response")):
            have = body.where(f"{side} is not null")
            p = p.unionByName(string(have, k, F.lit(f"{side}Schema"), F.lit(f"{side}Schema")))
            v = F.try_parse_json(side)
            fields = F.coalesce(fields_of(F.to_json(F.try_variant_get(v, "$.schema", "variant"))), F.array(F.struct(F.coalesce(F.try_variant_get(v, "$.name", "string"), F.lit("payload")).alias("name"), F.coalesce(F.try_variant_get(v, "$.schema", "string"), F.lit("string")).alias("schema"), F.lit("primitive").alias("schema_kind"))))
            params = have.select("file", "dtmi", F.posexplode(fields).alias("pos", "f")).withColumn("full", F.concat(F.lit(f"{side}_"), "f.name"))
            p = p.unionByName(params.select("file", owner.alias("entity_id"), F.lit(k + 1).alias("k"), "pos", ids.member_id(owner, F.col("full")).alias("id"), names.model_name(F.col("full")).alias("name"), value_type(F.col("f.schema"), F.col("f.schema_kind"), F.lit(None).cast("string")).alias("valueType"), F.lit(False).alias("is_timeseries")))
        entities_more.append(body.select("file", owner.alias("id"), names.model_name(F.concat(F.lit("Command_"), "cmd")).alias("name")))
    p = p.select(*_PROPERTY)
    w = Window.partitionBy("file", "entity_id").orderBy("is_timeseries", "k", "pos", "id")
    p = written(p.withColumn("pos", F.row_number().over(w) - 1).select("file", "entity_id", "pos", "id", "name", "valueType", "is_timeseries"), "properties")
    parent = F.get("extends", F.lit(0))
    known = i.select("file", F.col("dtmi").alias("up"))
    shown_name = F.coalesce("display", F.coalesce(F.try_element_at("display_map", F.lit("en")), F.get(F.map_values("display_map"), F.lit(0))), names.dtmi_name(F.col("dtmi")))
    base = i.withColumn("up", parent).join(known.withColumn("has", F.lit(True)), ["file", "up"], "left").select("file", owner.alias("id"), names.model_name(shown_name).alias("name"), F.when(F.col("has"), ids.hash_id(F.col("up"), prefix)).alias("baseEntityTypeId"))
    ent = base
    for x in entities_more:
        ent = ent.unionByName(x.withColumn("baseEntityTypeId", F.lit(None).cast("string")))
    ent = ent.dropDuplicates(["file", "id"])
    ent = keys.infer(p, ent.withColumn("entityIdParts", F.array().cast("array<string>"))).withColumn("entityIdParts", F.col("inferred")).drop("inferred")
    first = p.where("not is_timeseries and valueType = 'String'").groupBy("file", F.col("entity_id").alias("id")).agg(F.min_by(F.col("id"), "pos").alias("displayNamePropertyId"))
    ent = ent.join(first, ["file", "id"], "left").select("file", "id", "name", F.lit(NAMESPACE).alias("namespace"), F.lit("Custom").alias("namespaceType"), F.lit("Visible").alias("visibility"), "baseEntityTypeId", "entityIdParts", "displayNamePropertyId")
    r = rels[0]
    for x in rels[1:]:
        r = r.unionByName(x)
    r = r.select("file", "id", "name", F.lit(NAMESPACE).alias("namespace"), F.lit("Custom").alias("namespaceType"), "source_id", "target_id")
    no_target = c.where("kind = 'Relationship' and target is null").select("file", F.lit("relationship").alias("item_type"), "name", F.lit("no target").alias("reason"), F.col("dtmi").alias("uri"))
    return Converted(ent, p, r, no_target)


def id_mapping(m: Models, prefix: int = ids.PREFIX) -> DataFrame:
    """(file, mapping): a map of each identifier to its id."""
    rows = m.interfaces.select("file", F.struct("dtmi", ids.hash_id(F.col("dtmi"), prefix).alias("id")).alias("x"))
    return rows.groupBy("file").agg(F.map_from_entries(F.array_sort(F.collect_set("x"))).alias("mapping"))


# Limits of the language's versions.
LIMITS = {2: {"contents": 300, "extends": 2, "depth": 10, "name": 64}, 3: {"contents": 100000, "extends": 1024, "depth": 10, "name": 512}, 4: {"contents": 100000, "extends": 1024, "depth": 12, "name": 512}}
DEEPEST = 12
NAME = "^[A-Za-z](?:[A-Za-z0-9_]*[A-Za-z0-9])?$"


def issues(m: Models, *, external_allowed: bool = True) -> DataFrame:
    """All checks of models: identifiers, versions, parents, cycles and depths, contents, names, schemas, targets."""
    i, c, iss = m.interfaces, m.contents, checks.issue
    null = F.lit(None).cast("string")
    twice = i.withColumn("k", F.row_number().over(Window.partitionBy("file", "dtmi").orderBy("pos"))).where("k > 1")
    dtmi = i.withColumn("why", names.dtmi_faults(F.col("dtmi"))).where("why is not null")
    all_edges = i.select("file", F.col("dtmi").alias("child"), F.explode("extends").alias("parent")).distinct()
    outside = all_edges.join(i.select("file", F.col("dtmi").alias("parent")), ["file", "parent"], "left_anti")
    up = closure.ancestors(all_edges)
    loops = closure.reaches_cycle(up)
    deep = closure.deeper(all_edges, DEEPEST).join(loops, ["file", "node"], "left_anti")
    same = c.withColumn("k", F.row_number().over(Window.partitionBy("file", "dtmi", "name").orderBy("pos"))).where("k > 1")
    targets = lambda kind, col: c.where(f"kind = '{kind}' and {col} is not null").select("file", F.col("name"), "dtmi", F.col(col).alias("ref")).join(i.select("file", F.col("dtmi").alias("ref")), ["file", "ref"], "left_anti")
    users = lambda df: df.groupBy("file", "ref").agg(F.array_join(F.slice(F.array_sort(F.collect_set("name")), 1, 3), ", ").alias("users"))
    ext = "warning" if external_allowed else "error"
    prim = F.col("schema_kind") == "primitive"
    known = F.col("schema").isin([s for ss in types.DTDL_TYPES.values() for s in ss]) | F.startswith("schema", F.lit("dtmi:"))
    data = F.col("kind").isin("Property", "Telemetry")
    inner = F.transform(list_of(F.try_parse_json("properties"), "$"), lambda q: text_of(q, "$.name"))
    inner = c.where("kind = 'Relationship'").select("file", "dtmi", "name", F.posexplode(inner).alias("i", "inner")).where("inner is not null")
    again = inner.withColumn("k", F.row_number().over(Window.partitionBy("file", "dtmi", "name", "inner").orderBy("i"))).where("k > 1")
    sides = F.array(*[F.struct(F.lit(x).alias("side"), text_of(F.try_parse_json(x), "$.schema").alias("schema")) for x in ("request", "response")])
    sides = c.where("kind = 'Command'").select("file", "dtmi", "name", F.explode(sides).alias("s")).select("file", "dtmi", "name", "s.side", "s.schema").where(F.col("schema").isNotNull() & ~known)
    shared = m.schemas.withColumn("why", names.dtmi_faults(F.col("id")))
    return checks.union([
        iss(m.faults, "dtdl", "error", "syntax", "parse", F.col("fault"), null),
        iss(twice, "dtdl", "error", "identifier", "duplicate", "the identifier is used twice", F.col("dtmi")),
        iss(dtmi, "dtdl", "error", "identifier", "dtmi", F.concat(F.lit("identifier: "), "why"), F.col("dtmi")),
        iss(i.where("version not in (2, 3, 4)"), "dtdl", "warning", "version", "version", "an unknown version", F.col("dtmi")),
        iss(i.where(F.length(F.coalesce("display", F.lit(""))) > 512), "dtdl", "error", "length", "display", "the display name is too long", F.col("dtmi")),
        iss(i.where(F.length(F.coalesce("description", F.lit(""))) > 512), "dtdl", "warning", "length", "description", "the description is too long", F.col("dtmi")),
        iss(all_edges.where("child = parent"), "dtdl", "error", "inheritance", "self", "extends itself", F.col("child")),
        iss(outside, "dtdl", ext, "inheritance", "parent", "the parent is not in the set", F.col("child"), F.col("parent")),
        iss(loops.join(i.select("file", F.col("dtmi").alias("node")), ["file", "node"], "left_semi"), "dtdl", "error", "inheritance", "cycle", "inherits in a circle", F.col("node")),
        iss(deep.join(i.select("file", F.col("dtmi").alias("node")), ["file", "node"], "left_semi"), "dtdl", "error", "inheritance", "depth", f"inherits over more than {DEEPEST} levels", F.col("node")),
        iss(same, "dtdl", "error", "content", "name_twice", "a content name is used twice", F.col("dtmi"), F.col("name")),
        iss(c.where(~F.col("name").rlike(NAME)), "dtdl", "error", "content", "name", "not a content name", F.col("dtmi"), F.col("name")),
        iss(c.where(F.length("name") > 512), "dtdl", "error", "content", "name_length", "a content name is too long", F.col("dtmi"), F.col("name")),
        iss(c.where("kind = 'Relationship' and max_multiplicity < 1"), "dtdl", "error", "content", "multiplicity", "maxMultiplicity is below 1", F.col("dtmi"), F.col("name")),
        iss(c.where(data & prim & ~known), "dtdl", "warning", "schema", "schema", F.concat(F.lit("unknown schema "), F.col("schema")), F.col("dtmi"), F.col("name")),
        iss(again, "dtdl", "error", "content", "property_twice", F.concat(F.lit("a relationship's property name is used twice: "), "inner"), F.col("dtmi"), F.col("name")),
        iss(sides, "dtdl", "warning", "schema", "command_schema", F.concat(F.lit("unknown schema of the "), "side", F.lit(": "), "schema"), F.col("dtmi"), F.col("name")),
        iss(shared.where("id is null"), "dtdl", "error", "schema", "shared_id", "a shared schema has no identifier", F.col("dtmi")),
        iss(shared.where("id is not null and why is not null"), "dtdl", "error", "identifier", "shared_dtmi", F.concat(F.lit("identifier of a shared schema: "), "why"), F.col("dtmi"), F.col("id")),
        iss(users(targets("Relationship", "target")), "dtdl", ext, "reference", "target", "a target is not in the set", F.col("ref"), F.col("users")),
        iss(users(targets("Component", "schema")), "dtdl", ext, "reference", "component", "a component's schema is not in the set", F.col("ref"), F.col("users")),
    ])


def compliance(m: Models) -> DataFrame:
    """Findings by the limits of the version of each document: that of its first interface with a known one, else 3. The depth
    of an interface is the number of interfaces on its longest way up within the document, itself among them; where ways
    run in a circle, of all that it reaches."""
    spark = m.interfaces.sparkSession
    lim = F.broadcast(spark.createDataFrame([(v, *x.values()) for v, x in LIMITS.items()], "version int, l_contents int, l_extends int, l_depth int, l_name int"))
    known = F.col("version").isin(*LIMITS)
    of = written(m.interfaces.groupBy("file").agg(F.coalesce(F.min_by("version", F.when(known, F.col("pos"))), F.lit(3)).alias("version")).join(lim, "version"))
    i = m.interfaces.drop("version").join(of, "file")
    c = m.contents.where("kind <> 'Component'").join(of, "file")
    bare = F.substring_index(F.regexp_replace("dtmi", "dtmi:", ""), ";", 1)
    name = F.substring_index(bare, ":", -1)
    system = i.select("file", "dtmi", F.explode(F.filter(F.split(bare, ":"), lambda x: F.startswith(x, F.lit("_")))).alias("segment"))
    shown = F.coalesce(F.nullif(name, F.lit("")), names.display_name(F.col("display_map"), F.col("dtmi")), F.lit(""))
    outside = i.select("file", "dtmi", F.explode("extends").alias("parent")).join(m.interfaces.select("file", F.col("dtmi").alias("parent")).distinct(), ["file", "parent"], "left_anti")
    inner = written(edges(m).select("file", "child", "parent").distinct())
    limits = sorted({x["depth"] for x in LIMITS.values()})
    deep = None
    for most in limits:
        some = closure.deeper(inner, most - 1).withColumn("l_depth", F.lit(most))
        deep = some if deep is None else deep.unionByName(some)
    up = closure.ancestors(inner)
    loops = closure.reaches_cycle(up)
    reach = up.where("node <> ancestor").join(loops, ["file", "node"], "left_semi").groupBy("file", "node").agg((F.count("*") + 1).alias("d"))
    deep = deep.join(of.select("file", "l_depth"), ["file", "l_depth"]).join(loops, ["file", "node"], "left_anti").select("file", "node")
    deep = deep.unionByName(reach.join(of, "file").where("d > l_depth").select("file", "node"))
    iss = checks.issue
    null = F.lit(None).cast("string")
    return checks.union([
        iss(m.faults.where(F.endswith("fault", F.lit("has no @id"))), "compliance", "error", "identifier", "DTDL001", F.col("fault"), null),
        iss(i.where(~F.startswith("dtmi", F.lit("dtmi:"))), "compliance", "error", "identifier", "DTDL002", "the identifier has another scheme", F.col("dtmi")),
        iss(i.where(F.length("dtmi") > 128), "compliance", "error", "identifier", "DTDL003", "the identifier is too long", F.col("dtmi")),
        iss(system, "compliance", "error", "identifier", "DTDL004", F.concat(F.lit("a segment of the system: "), "segment"), F.col("dtmi")),
        iss(i.where(F.length(shown) > F.col("l_name")), "compliance", "error", "name", "DTDL010", "the interface's name is too long for the version", F.col("dtmi")),
        iss(i.where(F.size("extends") > F.col("l_extends")), "compliance", "error", "inheritance", "DTDL020", "too many parents for the version", F.col("dtmi")),
        iss(deep, "compliance", "error", "inheritance", "DTDL021", "too deep for the version", F.col("node")),
        iss(outside, "compliance", "warning", "inheritance", "DTDL022", F.concat(F.lit("the parent is not in the document: "), "parent"), F.col("dtmi"), F.col("parent")),
        iss(c.where(F.length("name") > F.col("l_name")), "compliance", "error", "content", "DTDL030", "a content name is too long for the version", F.col("dtmi"), F.col("name")),
        iss(c.where(F.col("name").rlike(r"^[^\p{L}]")), "compliance", "error", "content", "DTDL031", "a content name starts with no letter", F.col("dtmi"), F.col("name")),
    ])


def target_compliance(m: Models, **modes: str) -> DataFrame:
    """Findings on what the models become, under the wider limits of models."""
    c = convert(m, **modes)
    return checks.union([checks.limit_issues(c.entities, c.properties, c.relationships, profile="model"), checks.converted_compliance(c.entities, c.properties, c.relationships)])


def kinds(m: Models) -> DataFrame:
    """(file, kind, n): interfaces and contents by kind."""
    return m.interfaces.select("file", F.lit("Interface").alias("kind")).union(m.contents.select("file", "kind")).groupBy("file", "kind").agg(F.count("*").alias("n"))


def features(m: Models) -> DataFrame:
    """(file, feature, n): constructs of models by name, for the support table."""
    c = m.contents
    named = lambda df, test, name: df.where(test).select("file", F.lit(name).alias("feature"))
    rows = m.interfaces.select("file", F.lit("Interface").alias("feature")).union(c.select("file", "kind"))
    rows = rows.union(c.where("schema_kind <> 'primitive'").select("file", "schema_kind"))
    rows = rows.union(c.where((F.col("schema_kind") == "primitive") & F.col("schema").isin(*checks.MODEL_SUPPORT["partial"])).select("file", "schema"))
    rows = rows.union(m.interfaces.select("file", F.explode("extends").alias("x")).select("file", F.lit("extends")))
    for test, name in (("unit is not null", "unit"), ("writable", "writable"), ("size(semantic) > 0", "semanticType"), ("min_multiplicity is not null", "minMultiplicity"), ("max_multiplicity is not null", "maxMultiplicity")):
        rows = rows.union(named(c, test, name))
    for test, name in (("description is not null", "description"), ("display is not null or display_map is not null", "displayName")):
        rows = rows.union(named(m.interfaces, test, name))
    return rows.groupBy("file", "feature").agg(F.count("*").alias("n"))
