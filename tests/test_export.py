"""The exported triples of a small fixture of all eight tables against its conversion done plainly."""

import re

from sedgeline import registry
from sedgeline.plans import lens

ROWS = {
    "region": ("r_regionkey long, r_name string", [(0, "R")]),
    "nation": ("n_nationkey long, n_name string, n_regionkey long", [(0, "N", 0)]),
    "customer": ("c_custkey long, c_name string, c_acctbal double, c_mktsegment string, c_nationkey long", [(1, "C", 1.5, "M", 0)]),
    "supplier": ("s_suppkey long, s_name string, s_acctbal double, s_nationkey long", [(1, "S", 2.5, 0)]),
    "part": ("p_partkey long, p_name string, p_brand string, p_size int, p_retailprice double, p_type string", [(1, "P", "B1", 3, 4.5, "T")]),
    "orders": ("o_orderkey long, o_orderstatus string, o_orderpriority string, o_custkey long", [(1, "O", "1", 1)]),
    "lineitem": ("l_orderkey long, l_linenumber int, l_returnflag string, l_partkey long, l_suppkey long", [(1, 1, "A", 1, 1)]),
    "events": ("event_id long, event_type string, user_id long", [(1, "E", 9)]),
}


def test_every_reference_of_the_tables_is_exported(spark, tmp_path):
    for name, (ddl, rows) in ROWS.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    ends = {}
    for r in registry.QUERIES["q_exported_triples"](spark, str(tmp_path)).collect():
        m = re.fullmatch(r"<[^>]*#(\w+)> <[^>]*#(domain|range|type)> <[^>]*#(\w+)> \.", r.line)
        if m:
            ends.setdefault((m[1], m[2]), set()).add(m[3])
    # Plainly: each key of each row links its own class to the class of the row that it points to; of several, the least.
    want = {}
    for _, (cls, _, _, keys) in lens.TABLES.items():
        for pred, other in keys.values():
            want.setdefault((pred, "domain"), set()).add(cls)
            want.setdefault((pred, "range"), set()).add(lens.CLASSES[other])
    for end, classes in want.items():
        assert ends.get(end) == {min(classes)}, end
    for cls in lens.CLASSES.values():
        assert "Class" in ends[cls, "type"]
