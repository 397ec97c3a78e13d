"""What bringing a set of definitions to a store would do: a plan by a full outer join, nothing is sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIONS = ("create", "update_definition", "update_description", "unchanged", "conflict", "keep")


def digest(parts: DataFrame) -> DataFrame:
    """(name, digest) of definitions (name, path, payload): equal ones have the same parts, whatever their order."""
    part = F.struct("path", "payload")
    return parts.groupBy("name").agg(F.sha2(F.to_json(F.array_sort(F.collect_list(part))), 256).alias("digest"))


def plan(wanted: DataFrame, stored: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """(name, id, action, changes) for definitions (name, description, digest) and those of a store (with `id`): by name, what is
    not there is created, else the definition is updated if its digest differs and the description if it does, and nothing
    is sent for what is equal; what only the store has is kept. Names are compared as they are; of several in the store with
    one name the least id is taken.

    With `base`, what both came from, it is a three-way plan: a field that the store alone has changed is left as the store has
    it, and one that both sides have changed to different values is a conflict."""
    first = stored.groupBy("name").agg(F.min_by(F.struct("id", "description", "digest"), "id").alias("s"))
    both = wanted.select("name", F.struct("description", "digest").alias("w")).join(first, "name", "full_outer")
    if base is None:
        both = both.withColumn("b", F.lit(None).cast("struct<description:string,digest:string>"))
    else:
        both = both.join(base.select("name", F.struct("description", "digest").alias("b")), "name", "left")

    def change(field: str) -> Column:
        w, s, b = (F.col(f"{x}.{field}") for x in "wsb")
        known = F.col("b").isNotNull()
        theirs = known & ~s.eqNullSafe(b)
        return F.when(w.eqNullSafe(s), F.lit("same")).when(theirs & w.eqNullSafe(b), "theirs").when(theirs, "conflict").otherwise("ours")

    # A description that is not given is no wish to empty it.
    text = F.when(F.col("w.description").isNull(), "same").otherwise(change("description"))
    body = change("digest")
    action = (
        F.when(F.col("w").isNull(), "keep")
        .when(F.col("s").isNull(), "create")
        .when((body == "conflict") | (text == "conflict"), "conflict")
        .when(body == "ours", "update_definition")
        .when(text == "ours", "update_description")
        .otherwise("unchanged")
    )
    there = F.col("w").isNotNull() & F.col("s").isNotNull()
    changes = F.array_compact(F.array(F.when(there & body.isin("ours", "conflict"), "definition"), F.when(there & text.isin("ours", "conflict"), "description")))
    return both.select("name", F.col("s.id").alias("id"), action.alias("action"), changes.alias("changes"))


def summary(planned: DataFrame) -> DataFrame:
    """(action, n), the report of a dry run."""
    return planned.groupBy("action").agg(F.count("*").alias("n"))


def merged(wanted: DataFrame, stored: DataFrame, planned: DataFrame) -> DataFrame:
    """(name, description, digest) as the store would be after the plan; conflicts stay as the store has them."""
    w = wanted.select("name", F.struct("description", "digest").alias("w"))
    s = stored.groupBy("name").agg(F.min_by(F.struct("description", "digest"), "id").alias("s"))
    rows = planned.join(w, "name", "left").join(s, "name", "left")
    of = lambda field, word: F.when((F.col("action") == "create") | (F.col("action") != "conflict") & F.array_contains("changes", word), F.col(f"w.{field}")).otherwise(F.col(f"s.{field}")).alias(field)
    return rows.select("name", of("description", "description"), of("digest", "definition"))
