"""Which properties identify an entity, and which names it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALID = ("String", "BigInt")
# Names of keys.
PATTERNS = "id identifier pk primary_key primarykey key uuid guid oid object_id objectid entity_id entityid record_id recordid unique_id uniqueid".split()


def _valid() -> Column:
    return F.col("valueType").isin(*VALID) & ~F.coalesce(F.col("is_timeseries"), F.lit(False))


def last_key(properties: DataFrame) -> DataFrame:
    """(file, id, entityIdParts, displayNamePropertyId): the last valid property with `id` in its name is the key, the last
    String property with `name` the display name, else the key; without such a key the first valid property is both."""
    low = F.lower("name")
    rows = properties.where(_valid())
    agg = rows.groupBy("file", F.col("entity_id").alias("id")).agg(
        F.max_by(F.when(F.contains(low, F.lit("id")), F.col("id")), F.when(F.contains(low, F.lit("id")), F.col("pos"))).alias("k"),
        F.max_by("id", F.when((F.col("valueType") == "String") & F.contains(low, F.lit("name")), F.col("pos"))).alias("n0"),
        F.max(F.when((F.col("valueType") == "String") & F.contains(low, F.lit("name")), F.col("pos"))).alias("np"),
        F.min_by("id", "pos").alias("first"),
    )
    name = F.when(F.col("np").isNotNull(), F.col("n0"))
    key = F.coalesce("k", "first")
    return agg.select("file", "id", F.array(key).alias("entityIdParts"), F.coalesce(name, key).alias("displayNamePropertyId"))


def infer(properties: DataFrame, entities: DataFrame, *, strategy: str = "auto", explicit: dict[str, list[str]] | None = None, patterns: list[str] = PATTERNS) -> DataFrame:
    """`entities` (file, id, name, …) with `inferred` key parts: an explicit list of property names wins; `auto` is the first
    valid property whose name is or has a pattern, else the first valid one; `first_valid`; `explicit` and `none` give no other."""
    if strategy not in ("auto", "first_valid", "explicit", "none"):
        raise ValueError(f"unknown strategy {strategy}")
    low = F.lower("name")
    fits = F.lit(False)
    for p in patterns:
        fits = fits | F.contains(low, F.lit(p.lower()))
    rows = properties.where(_valid())
    best = F.min(F.struct(F.when(fits, 0).otherwise(1).alias("rank") if strategy == "auto" else F.lit(0).alias("rank"), "pos", "id"))
    own = rows.groupBy("file", F.col("entity_id").alias("id")).agg(F.array(best["id"]).alias("own"))
    none = F.array().cast("array<string>")
    out = entities.join(own, ["file", "id"], "left")
    given = none
    if explicit:
        table = entities.sparkSession.createDataFrame([(e, i, p) for e, ps in explicit.items() for i, p in enumerate(ps)], "e string, i int, p string")
        named = entities.select("file", "id", F.col("name").alias("e")).join(table, "e").join(properties.where(_valid()).select("file", F.col("entity_id").alias("id"), F.col("name").alias("p"), F.col("id").alias("pid")), ["file", "id", "p"])
        named = named.groupBy("file", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "pid"))), lambda x: x["pid"]).alias("given"))
        out = out.join(named, ["file", "id"], "left")
        given = F.coalesce("given", none)
    auto = F.coalesce("own", none) if strategy in ("auto", "first_valid") else none
    return out.withColumn("inferred", F.when(F.size(given) > 0, given).otherwise(auto)).drop("own", "given")


def infer_all(properties: DataFrame, entities: DataFrame, *, overwrite: bool = False, **how) -> DataFrame:
    """Key parts filled in where there are none, or everywhere; `changed` says where."""
    out = infer(properties, entities, **how)
    take = (F.lit(overwrite) | (F.size(F.coalesce("entityIdParts", F.array().cast("array<string>"))) == 0)) & (F.size("inferred") > 0)
    return out.withColumn("changed", take).withColumn("entityIdParts", F.when(take, F.col("inferred")).otherwise(F.col("entityIdParts"))).drop("inferred")


def display_names(properties: DataFrame, entities: DataFrame) -> DataFrame:
    """(file, id, displayNamePropertyId): the first key part if it is a String, else the first String property with `name`,
    else the first String property."""
    rows = properties.where((F.col("valueType") == "String") & ~F.coalesce("is_timeseries", F.lit(False)))
    own = rows.groupBy("file", F.col("entity_id").alias("id")).agg(F.min(F.struct(F.when(F.contains(F.lower("name"), F.lit("name")), 0).otherwise(1).alias("r"), "pos", F.col("id").alias("pid")))["pid"].alias("own"), F.collect_set("id").alias("strings"))
    key = F.get("entityIdParts", F.lit(0))
    return entities.join(own, ["file", "id"], "left").select("file", "id", F.when(F.array_contains(F.coalesce("strings", F.array().cast("array<string>")), key), key).otherwise(F.col("own")).alias("displayNamePropertyId"))
