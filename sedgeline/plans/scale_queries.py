"""Registered queries of what works on large documents and over time: split reading, admission, breakers with kept state,
upsert plans and numbers over ranges."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ordered, upsert
from ..operators.shared import written
from ..sources import split
from ..streaming import control, stateful
from .queries import _t

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
T = "http://ex.org/t#"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _folder(spark: SparkSession, name: str) -> str:
    """A path of its own beside the written tables."""
    home = written(spark.range(1), name).inputFiles()[0].rsplit("/", 2)[0]
    return f"{home}/{name}-{uuid.uuid4().hex}"


def _documents(lines: DataFrame, folder: str) -> None:
    """`lines` (doc, k, line) as files, one for each document, in the order of k."""
    lines.repartition("doc").sortWithinPartitions("doc", "k").select("doc", "line").write.partitionBy("doc").text(folder)


@query(f"""SELECT o_orderpriority AS doc, '{T}o' || o_orderkey AS s, p, CASE p WHEN '{T}by' THEN '{T}c' || o_custkey ELSE 'status ' || o_orderstatus || '.' || chr(10) || '[ "' || o_orderkey || '" .' END AS o FROM orders, (VALUES ('{T}by'), ('{T}note')) x(p)""")
def q_split_turtle(spark, sf_dir):
    """Orders as Turtle documents, one for each priority, read in pieces."""
    o = _t(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    text = F.concat(F.lit("x:o"), key, F.lit(" a x:Order ; x:by x:c"), F.col("o_custkey").cast("string"), F.lit(' ;\n  # a comment . with "quotes\n  x:note """status '), "o_orderstatus", F.lit('.\n[ "'), key, F.lit('" .""" .'))
    head = o.select("o_orderpriority").distinct().select(F.col("o_orderpriority").alias("doc"), F.lit(-1).cast("long").alias("k"), F.lit(f"@prefix x: <{T}> .").alias("line"))
    folder = _folder(spark, "turtle")
    _documents(head.unionByName(o.select(F.col("o_orderpriority").alias("doc"), F.col("o_orderkey").alias("k"), text.alias("line"))), folder)
    t = split.read_turtle(split.records(spark, folder, "turtle"), piece=1 << 16)
    doc = F.url_decode(F.regexp_extract(F.url_decode("file"), "doc=([^/]*)/", 1))
    return t.where(F.col("p").isin(f"{T}by", f"{T}note")).select(doc.alias("doc"), "s", "p", "o")


@query("""SELECT c_nationkey AS nation, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS number, c_custkey AS custkey, c_name || ' } "]' AS name FROM customer""")
def q_split_array(spark, sf_dir):
    """Customers as JSON arrays, one for each nation, cut at their elements, which are numbered."""
    c = _t(spark, sf_dir, "customer")
    item = F.to_json(F.struct(F.col("c_custkey").alias("key"), F.struct(F.concat("c_name", F.lit(' } "]')).alias("name")).alias("of")))
    rows = c.select(F.col("c_nationkey").alias("doc"), F.col("c_custkey").alias("k"), F.concat(F.lit(", "), item).alias("line"))
    ends = c.select(F.col("c_nationkey").alias("doc")).distinct().select("doc", F.explode(F.array(F.struct(F.lit(-1).cast("long").alias("k"), F.lit("[null").alias("line")), F.struct(F.lit((1 << 63) - 1).alias("k"), F.lit("]").alias("line")))).alias("x")).select("doc", "x.*")
    folder = _folder(spark, "arrays")
    _documents(rows.unionByName(ends), folder)
    e = split.array_elements(split.records(spark, folder, "json"), piece=1 << 14).where("element <> 'null'")
    return e.select(F.regexp_extract("file", "doc=([^/]*)/", 1).cast("int").alias("nation"), "number", F.get_json_object("element", "$.key").cast("long").alias("custkey"), F.get_json_object("element", "$.of.name").alias("name"))


@query("""SELECT o_orderpriority AS priority, o_orderkey AS orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS number, coalesce(sum(o_custkey) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM orders""")
def q_ranged_numbers(spark, sf_dir):
    """Numbers and running sums of five large groups, over ranges."""
    o = _t(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"), F.col("o_orderkey").alias("orderkey"), "o_custkey")
    sums = ordered.running(o, ["priority"], ["orderkey"], F.col("o_custkey"), "before")
    return ordered.numbered(sums, ["priority"], ["orderkey"], start=1).select("priority", "orderkey", "number", "before")


@query("""WITH RECURSIVE x AS (SELECT user_id, event_id, epoch_us(ts) AS us, coalesce(value, 0) * 2 AS mb, event_id % 100 AS used, (event_id % 7) * 6 * 3600000000::BIGINT AS took, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
f(user_id, event_id, k, why, starts, ends) AS (SELECT NULL::BIGINT, NULL::BIGINT, 0::BIGINT, NULL::VARCHAR, []::BIGINT[], []::BIGINT[]
 UNION ALL SELECT y.user_id, y.event_id, y.k, y.why, CASE WHEN y.why IS NULL THEN list_append(y.st, y.us) ELSE y.st END, CASE WHEN y.why IS NULL THEN list_append(y.en, y.us + y.took) ELSE y.en END
 FROM (SELECT z.*, CASE WHEN len(st) >= 2 THEN 'rate' WHEN mb > 50 THEN 'size' WHEN used > 80 THEN 'memory' WHEN len(en) >= 2 THEN 'concurrency' END AS why
  FROM (SELECT x.*, list_filter(f.starts, lambda s: s > x.us - 43200000000) AS st, list_filter(f.ends, lambda e: e > x.us) AS en FROM f JOIN x ON x.k = f.k + 1 AND (f.k = 0 OR f.user_id IS NOT DISTINCT FROM x.user_id)) z) y)
SELECT event_id, why IS NULL AS admitted, why AS "limit" FROM f WHERE k > 0""")
def q_admission(spark, sf_dir):
    """Events as requests: the first limit that each meets, of rate, size, memory and concurrency."""
    e = _t(spark, sf_dir, "events").withColumns({"mb": F.coalesce("value", F.lit(0.0)) * 2, "used": F.col("event_id") % 100, "took": (F.col("event_id") % 7) * 6 * 3600})
    return control.admission(e, "user_id", "ts", "event_id", size_mb="mb", memory="used", took_seconds="took", most=2, seconds=43200.0, most_open=2).select("event_id", "admitted", "limit")


@query("""WITH RECURSIVE x AS (SELECT user_id, epoch_us(ts) AS us, event_type = 'error' AS bad, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
f(user_id, k, state, fails, oks, opened, called, bad, us, last) AS (SELECT user_id, 0::BIGINT, 'closed', 0, 0, 0::BIGINT, NULL::BOOLEAN, NULL::BOOLEAN, NULL::BIGINT, 'closed' FROM x GROUP BY user_id
 UNION ALL SELECT user_id, k, CASE WHEN st = 'open' THEN 'open' WHEN st = 'half' THEN CASE WHEN bad THEN 'open' WHEN oks + 1 >= 2 THEN 'closed' ELSE 'half' END WHEN bad AND fails + 1 >= 2 THEN 'open' ELSE 'closed' END,
   CASE WHEN st = 'open' THEN fails WHEN st = 'half' THEN 0 WHEN bad THEN fails + 1 ELSE 0 END, CASE WHEN st = 'half' AND NOT bad AND oks + 1 < 2 THEN oks + 1 ELSE 0 END,
   CASE WHEN st = 'open' THEN opened WHEN bad AND (st = 'half' OR fails + 1 >= 2) THEN us ELSE opened END, st <> 'open', bad, us, was
 FROM (SELECT x.*, f.fails, f.opened, f.state AS was, CASE WHEN f.state = 'open' AND x.us - f.opened >= 3600000000 THEN 0 ELSE f.oks END AS oks, CASE WHEN f.state = 'open' AND x.us - f.opened >= 3600000000 THEN 'half' ELSE f.state END AS st FROM f JOIN x ON x.user_id = f.user_id AND x.k = f.k + 1))
SELECT user_id::VARCHAR AS name, arg_max(state, k) AS state, count(*) FILTER (called) AS calls, count(*) FILTER (called AND NOT bad) AS good, count(*) FILTER (called AND bad) AS bad, count(*) FILTER (NOT called) AS rejected, count(*) FILTER (state <> last AND k > 0) AS changes, max(us) FILTER (called AND bad) AS last_bad FROM f GROUP BY user_id""")
def q_breaker_registry(spark, sf_dir):
    """Events of users as a stream of calls; the breakers' states and counters, read from what the query keeps."""
    folder, kept = _folder(spark, "calls"), _folder(spark, "breakers")
    calls = _t(spark, sf_dir, "events").select("user_id", "ts", "event_id", (F.col("event_type") == "error").alias("bad"))
    calls.write.parquet(folder)
    out = stateful.breakers(spark.readStream.schema(calls.schema).parquet(folder), "user_id", "ts", "event_id", "bad", failures=2, successes=2, timeout_seconds=3600.0)
    out.writeStream.format("noop").option("checkpointLocation", kept).trigger(availableNow=True).start().awaitTermination()
    return stateful.registry(spark, kept).select("name", "state", "calls", "good", "bad", "rejected", "changes", "last_bad")


@query("""WITH w AS (SELECT 'part ' || p_partkey AS name, p_brand AS description, p_type AS digest FROM part WHERE p_partkey % 10 <> 0),
s AS (SELECT 'part ' || p_partkey AS name, p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN 'old' ELSE p_brand END AS description, CASE WHEN p_partkey % 3 = 0 THEN 'old' ELSE p_type END AS digest FROM part WHERE p_partkey % 7 <> 0),
b AS (SELECT 'part ' || p_partkey AS name, p_brand AS description, CASE WHEN p_partkey % 6 = 0 THEN p_type WHEN p_partkey % 5 = 0 THEN 'other' ELSE 'old' END AS digest FROM part WHERE p_partkey % 2 = 0),
j AS (SELECT name, s.id, w.name IS NULL AS no_w, s.name IS NULL AS no_s, b.name IS NOT NULL AS known, w.digest AS wg, s.digest AS sg, b.digest AS bg, w.description AS wd, s.description AS sd, b.description AS bd FROM w FULL JOIN s USING (name) LEFT JOIN b USING (name)),
c AS (SELECT *, CASE WHEN wg = sg THEN 'same' WHEN known AND sg <> bg AND wg = bg THEN 'theirs' WHEN known AND sg <> bg THEN 'conflict' ELSE 'ours' END AS g, CASE WHEN wd = sd THEN 'same' WHEN known AND sd <> bd AND wd = bd THEN 'theirs' WHEN known AND sd <> bd THEN 'conflict' ELSE 'ours' END AS d FROM j)
SELECT name, id, CASE WHEN no_w THEN 'keep' WHEN no_s THEN 'create' WHEN g = 'conflict' OR d = 'conflict' THEN 'conflict' WHEN g = 'ours' THEN 'update_definition' WHEN d = 'ours' THEN 'update_description' ELSE 'unchanged' END AS action,
 CASE WHEN no_w OR no_s THEN '' ELSE concat_ws(',', CASE WHEN g IN ('ours', 'conflict') THEN 'definition' END, CASE WHEN d IN ('ours', 'conflict') THEN 'description' END) END AS changes FROM c""")
def q_upsert_plan(spark, sf_dir):
    """A three-way plan over parts as definitions: wanted, stored, and what both came from."""
    p = _t(spark, sf_dir, "part")
    k, name = F.col("p_partkey"), F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("name")
    wanted = p.where(k % 10 != 0).select(name, F.col("p_brand").alias("description"), F.col("p_type").alias("digest"))
    stored = p.where(k % 7 != 0).select(name, k.alias("id"), F.when(k % 4 == 0, "old").otherwise(F.col("p_brand")).alias("description"), F.when(k % 3 == 0, "old").otherwise(F.col("p_type")).alias("digest"))
    base = p.where(k % 2 == 0).select(name, F.col("p_brand").alias("description"), F.when(k % 6 == 0, F.col("p_type")).when(k % 5 == 0, "other").otherwise("old").alias("digest"))
    return upsert.plan(wanted, stored, base).withColumn("changes", F.array_join("changes", ","))
