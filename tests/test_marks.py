"""Sets of names as bits of a node, against the same by joins and distinct counts."""

import random

from pyspark.sql import functions as F

from sedgeline.operators import marks, rdf
from sedgeline.operators.shared import written
from sedgeline.plans.lens import OWL, TYPE

DDL = "file string, s string, s_kind string, p string, o string, o_kind string"


def _graph(spark, seed=5):
    r = random.Random(seed)
    rows = []
    for f in ("a", "b"):
        for k in range(150):
            if f == "a" or k % 3:
                rows.append((f, f"C{k}", "iri", TYPE, OWL + "Class", "iri"))
        rows += [(f, f"n{r.randrange(60)}", "iri", TYPE, f"C{r.randrange(170)}", "iri") for _ in range(200)]
        rows += [(f, f"n{r.randrange(80)}", "iri", f"p{r.randrange(50)}", f"n{r.randrange(80)}", r.choice(["iri", "iri", "literal", "bnode"])) for _ in range(300)]
    props = [(f, f"p{k}") for f in ("a", "b") for k in range(48) if f == "a" or k % 5]
    return spark.createDataFrame(rows, DDL), rows, spark.createDataFrame(props, "file string, prop string"), props


def test_usage_by_bits_and_by_joins(spark):
    t, rows, props, ps = _graph(spark)
    known = {(f, s) for f, s, _, p, o, _ in rows if p == TYPE and o == OWL + "Class"}
    kinds = {(f, s, o) for f, s, _, p, o, k in rows if p == TYPE and (f, o) in known}
    want = {(f, p, end, c) for f, s, _, p, o, k in rows if k == "iri" and (f, p) in ps for end, n in (("domain", s), ("range", o)) for g, m, c in kinds if (g, m) == (f, n)}
    got = rdf.usage(t, props)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    asked = props.withColumn("end", F.lit("range"))
    for most in (marks.MOST, 10):
        assert sorted(map(tuple, rdf.usage(t, asked, most=most).collect())) == sorted(x for x in want if x[2] == "range")


def test_rows_and_nodes_of_each_name(spark):
    t, rows, _, _ = _graph(spark, 6)
    want = sorted((p, sum(x[3] == p for x in rows), len({x[1] for x in rows if x[3] == p})) for p in {x[3] for x in rows})
    for most in (marks.MOST, 10):
        assert sorted(map(tuple, marks.counted(t, "p", "s", most).collect())) == want


def _exchanged(spark, run):
    """Rows that `run` writes to exchanges."""
    store, none = spark._jsc.sc().statusStore(), spark._sc._gateway.new_array(spark._jvm.double, 0)
    stages = lambda: (lambda x: [x.apply(i) for i in range(x.size())])(store.stageList(None, False, False, none, None))
    last = max([s.stageId() for s in stages()], default=-1)
    out = run()
    return out, sum(s.shuffleWriteRecords() for s in stages() if s.stageId() > last)


def test_usage_exchanges_few_nodes(spark):
    """Name spaces say what may be, and some nodes show that it is; one node that differs is found by the second reading."""
    n, x = 20000, F.col("id").cast("string")
    a, b = F.concat(F.lit("http://x/a/"), x), F.concat(F.lit("http://x/b#"), x)
    row = lambda s, p, o: F.struct(F.lit("f").alias("file"), s.alias("s"), F.lit("iri").alias("s_kind"), F.lit(p).alias("p"), o.alias("o"), F.lit("iri").alias("o_kind"))
    t = spark.range(n).select(F.inline(F.array(row(a, TYPE, F.lit("A")), row(b, TYPE, F.lit("B")), row(a, "p", b)))).repartition(4, "o")
    t = written(t).union(spark.createDataFrame([("f", c, "iri", TYPE, OWL + "Class", "iri") for c in "ABC"], DDL))
    props = spark.createDataFrame([("f", "p")], "file string, prop string")
    plain = [("f", "p", "domain", "A"), ("f", "p", "range", "B")]
    got, rows = _exchanged(spark, lambda: rdf.usage(t, props).collect())
    assert sorted(map(tuple, got)) == plain
    assert rows < n / 10, rows
    odd = t.union(spark.createDataFrame([("f", "http://x/a/7", "iri", TYPE, "C", "iri")], DDL))
    for how in ({}, {"share": 1}, {"spaces": 0}):
        assert sorted(map(tuple, rdf.usage(odd, props, **how).collect())) == sorted([*plain, ("f", "p", "domain", "C")])


def test_schema_is_taken_from_the_instances_by_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(rdf, "written", lambda df, name: df)
    plan = rdf.schema_part(_graph(spark)[0].repartition(12))._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 8, false" not in plan and "RepartitionByExpression" in plan
