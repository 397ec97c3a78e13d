"""Recursion over metadata edges: closures, cycles, depths, orders, RDF lists and class expressions.

Edges carry their document in `file`, so that any number of documents are closed in one plan. Paths double each round, so
that the deepest document of n levels takes log n joins, without a bound; what a round finds is written to the shared
folder, which ends its lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import numbered
from .shared import written


def ancestors(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """`edges` (file, child, parent) to (file, node, ancestor, level), level 1 for parents: each pair at its least level.
    Cycles end because a pair is found once; a node on a cycle is its own ancestor."""
    e = written(edges.select("file", F.col(child).alias("node"), F.col(parent).alias("up")).where("up is not null").distinct())
    seen, reach = e.select("file", "node", F.col("up").alias("ancestor"), F.lit(1).alias("level")), 1
    while True:
        # A least way of more than `reach` levels is one of just so many and another of at most as many.
        far = seen.where(F.col("level") == reach).alias("f").join(seen.alias("s"), (F.col("f.file") == F.col("s.file")) & (F.col("f.ancestor") == F.col("s.node")))
        step = far.select("f.file", "f.node", "s.ancestor", (F.col("s.level") + reach).alias("level")).groupBy("file", "node", "ancestor").agg(F.min("level").alias("level"))
        new = written(step.join(seen.select("file", "node", "ancestor"), ["file", "node", "ancestor"], "left_anti"))
        if new.isEmpty():
            return seen
        seen, reach = seen.unionByName(new), reach * 2


def on_cycle(closure: DataFrame) -> DataFrame:
    """(file, node) of the nodes that are their own ancestors."""
    return closure.where("node = ancestor").select("file", "node").distinct()


def reaches_cycle(closure: DataFrame) -> DataFrame:
    """(file, node) of the nodes that are on a cycle or have an ancestor that is."""
    loops = on_cycle(closure)
    return loops.union(closure.join(loops.withColumnRenamed("node", "ancestor"), ["file", "ancestor"], "left_semi").select("file", "node")).distinct()


def chosen_parent(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(file, child, parent): of a node's parents that are nodes themselves and reach no cycle, the least."""
    known = edges.join(nodes.select("file", F.col("node").alias("parent")), ["file", "parent"], "left_semi")
    bad = reaches_cycle(ancestors(edges)).withColumnRenamed("node", "parent")
    return known.join(bad, ["file", "parent"], "left_anti").groupBy("file", "child").agg(F.min("parent").alias("parent"))


def depths(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(file, node, depth): the longest way up, 0 for roots; nodes that reach a cycle have no depth (null)."""
    up = ancestors(edges)
    bad = reaches_cycle(up).withColumn("bad", F.lit(True))
    clean = edges.join(bad.select("file", F.col("node").alias("child")), ["file", "child"], "left_anti").select("file", F.col("child").alias("node"), F.col("parent").alias("up"))
    now = written(nodes.select("file", "node").distinct().join(bad, ["file", "node"], "left").withColumn("depth", F.when(F.col("bad").isNull(), F.lit(0))).drop("bad"))
    known = now.select("file", "node")
    clean = clean.join(known, ["file", "node"], "left_semi").join(known.withColumnRenamed("node", "up"), ["file", "up"], "left_semi")
    # Ways of 1, 2, 4, ... edges; there are no cycles in them, so they run out.
    ways = [written(clean.select("file", "node", "up").distinct())]
    while not ways[-1].isEmpty():
        a, b = ways[-1].alias("a"), ways[-1].alias("b")
        ways.append(written(a.join(b, (F.col("a.file") == F.col("b.file")) & (F.col("a.up") == F.col("b.node"))).select("a.file", "a.node", "b.up").distinct()))
    # Where a node's ways of `depth` edges end: the longest steps first, each taken if any way goes on so far.
    at = now.withColumn("up", F.col("node"))
    for k in reversed(range(len(ways) - 1)):
        farther = at.alias("a").join(ways[k].alias("w"), (F.col("a.file") == F.col("w.file")) & (F.col("a.up") == F.col("w.node")))
        farther = written(farther.select("a.file", "a.node", (F.col("a.depth") + (1 << k)).alias("depth"), "w.up").distinct())
        at = written(at.join(farther.select("file", "node"), ["file", "node"], "left_anti").unionByName(farther))
    return at.select("file", "node", "depth").distinct()


def deeper(edges: DataFrame, most: int, child: str = "child", parent: str = "parent") -> DataFrame:
    """(file, node) of the nodes with a way up of more than `most` edges, whatever shorter ways they have: the nodes with a way
    of k edges are the children of those with one of k - 1, so no pairs are built and the search ends at the limit. What
    reaches a cycle has ways without end."""
    e = written(edges.select("file", F.col(child).alias("node"), F.col(parent).alias("up")).where("up is not null").distinct())
    now = e.select("file", "node").distinct()
    for k in range(most):
        above = now.select("file", F.col("node").alias("up"))
        now = e.join(above, ["file", "up"], "left_semi").select("file", "node").distinct()
        if k % 4 == 3:  # a few levels a plan
            now = written(now)
            if now.isEmpty():
                break
    return now


def topological(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(file, node, ord): parents before children; what reaches a cycle comes last; ties by name. Ordered per document, by
    ranges of the order."""
    return numbered(depths(nodes, edges), ["file"], [F.col("depth").asc_nulls_last(), "node"], "ord")


def list_members(triples: DataFrame, rdf: str, heads: DataFrame, *, longest: int = 1000) -> DataFrame:
    """`heads` (file, list) to (file, list, i, member, member_kind), in order; a list ends at nil, at a cell seen before, or
    after `longest` cells. Pointers double each round, so that a list of n cells takes log n joins."""
    rest = triples.where((F.col("p") == rdf + "rest") & (F.col("o") != rdf + "nil")).groupBy("file", F.col("s").alias("cell")).agg(F.min("o").alias("next"))
    first = triples.where(F.col("p") == rdf + "first").groupBy("file", F.col("s").alias("cell")).agg(F.min(F.struct("o", "o_kind")).alias("v"))
    at = written(heads.select("file", "list", F.col("list").alias("cell"), F.lit(0).alias("i")).distinct())
    jump, step = written(rest), 1
    while step <= longest:
        more = at.join(jump, ["file", "cell"]).select("file", "list", F.col("next").alias("cell"), (F.col("i") + step).alias("i")).where(F.col("i") < longest)
        both = at.unionByName(more).groupBy("file", "list", "cell").agg(F.min("i").alias("i"))
        both = written(both)
        jump = jump.alias("a").join(jump.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.next") == F.col("b.cell"))).select("a.file", "a.cell", F.col("b.next").alias("next"))
        jump = written(jump)
        at, step = both, step * 2
        if jump.isEmpty():
            break
    return at.join(first, ["file", "cell"]).select("file", "list", "i", F.col("v.o").alias("member"), F.col("v.o_kind").alias("member_kind"))


def class_members(triples: DataFrame, rdf: str, owl: str, *, deepest: int = 10) -> DataFrame:
    """(file, expression, i, class): the classes that a blank class expression stands for, in order, duplicates kept: unions,
    then intersections, complements and enumerations, nested to `deepest`."""
    order = {owl + k: i for i, k in enumerate(("unionOf", "intersectionOf", "complementOf", "oneOf"))}
    key = F.create_map(*[F.lit(x) for kv in order.items() for x in kv])
    parts = triples.where(F.col("p").isin(list(order)) & (F.col("s_kind") == "bnode")).select("file", F.col("s").alias("expression"), F.try_element_at(key, F.col("p")).alias("k"), F.col("o").alias("list"), "o_kind")
    members = list_members(triples, rdf, parts.where("o_kind = 'bnode'").select("file", "list"))
    listed = parts.join(members, ["file", "list"]).select("file", "expression", "k", "i", "member", "member_kind")
    single = parts.join(members.select("file", "list").distinct(), ["file", "list"], "left_anti").select("file", "expression", "k", F.lit(0).alias("i"), F.col("list").alias("member"), F.col("o_kind").alias("member_kind"))
    w = Window.partitionBy("file", "expression").orderBy("k", "i", "member")
    own = written(listed.unionByName(single).where("member_kind <> 'literal'").withColumn("n", F.row_number().over(w)).select("file", "expression", "n", "member", "member_kind"))
    now = own.select("file", "expression", F.array("n").alias("path"), "member", "member_kind", F.array("expression").alias("through"))
    done = now.where("member_kind = 'iri'")
    for _ in range(deepest - 1):
        open_ = now.where("member_kind = 'bnode' and not array_contains(through, member)")
        nested = open_.alias("a").join(own.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.member") == F.col("b.expression")))
        now = written(nested.select("a.file", "a.expression", F.concat("a.path", F.array("b.n")).alias("path"), "b.member", "b.member_kind", F.array_append("a.through", F.col("b.expression")).alias("through")))
        if now.isEmpty():
            break
        done = done.unionByName(now.where("member_kind = 'iri'"))
    w = Window.partitionBy("file", "expression").orderBy("path")
    return done.select("file", "expression", (F.row_number().over(w) - 1).alias("i"), F.col("member").alias("class"))


def inherited(attributes: DataFrame, edges: DataFrame) -> DataFrame:
    """`attributes` (file, owner, pos, name, …) and `edges` (file, child, parent) to all attributes of each owner, its
    ancestors' first; a nearer attribute replaces a farther one of its name and stands where its own owner stands.
    Adds `entity`, `level` (0 for own) and `ord`."""
    up = ancestors(edges).where("node <> ancestor").select("file", F.col("node").alias("entity"), F.col("ancestor").alias("owner"), "level")
    own = attributes.select("file", F.col("owner").alias("entity"), "owner").distinct().withColumn("level", F.lit(0))
    rows = own.unionByName(up).join(attributes, ["file", "owner"])
    near = Window.partitionBy("file", "entity", "name").orderBy("level", "pos")
    place = Window.partitionBy("file", "entity").orderBy(F.col("level").desc(), "owner", "pos")
    return rows.withColumn("k", F.row_number().over(near)).where("k = 1").drop("k").withColumn("ord", F.row_number().over(place) - 1)
