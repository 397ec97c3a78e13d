"""The test tables as a graph: what asks for few predicates goes over few branches, with the same triples."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sedgeline.operators import rdf
from sedgeline.plans import lens, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_triples_apart_are_the_same(spark):
    one, many = lens.triples(spark, SF), lens.triples(spark, SF, apart=True)
    assert one.columns == many.columns
    sums = lambda t: sorted(map(tuple, t.groupBy("p", "o_kind", "o_datatype").agg(F.count("*"), F.sum(F.xxhash64("s", "s_kind", "o", "file", "o_lang").cast("decimal(38,0)"))).collect()), key=repr)
    assert sums(one) == sums(many)


def test_conversion_looks_for_the_schema_in_no_instances(spark, monkeypatch):
    """The triples that the registered conversion is given: the branches of instances do not fit the schema's filter."""
    given = []
    monkeypatch.setattr(queries.rdf, "convert", lambda t: given.append(t) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        queries.q_definition_parts(spark, SF)
    monkeypatch.setattr(rdf, "written", lambda df, name: df)
    plan = _plan(rdf.schema_part(given[0]))
    assert "l_orderkey" not in plan and "event_id" not in plan
    assert plan.count("p_brand#") and plan.count("Relation [") == 1  # part, for the hierarchy, once
    used = _plan(given[0].where(F.col("p").isin(lens.NS + "ofPart", lens.NS + "placedBy")))
    assert used.count("Relation [") == 2 and "Generate explode" not in used
