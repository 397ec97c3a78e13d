"""Scalar functions against plain Python."""

import hashlib
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedgeline.functions import guards, ids, names, types, values


def column(spark, expr, rows, ddl):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(expr).collect()]


def plain_name(x, prefix="E_", most=128, empty="Entity"):
    if not x:
        return empty
    y = "".join(c if c.isalnum() or c == "_" else "_" for c in x)
    return (y if y[0].isalpha() else prefix + y)[:most]


def test_names(spark):
    xs = ["ñ a-b٣_x", "9lives", "_x", "", None, "a" * 200, "été/§", "x.y"]
    assert column(spark, names.sanitize(F.col("x")), [(x,) for x in xs], "x string") == [plain_name(x) for x in xs]
    uris = ["http://a/b#c/d", "http://a/b", "plain", "http://a/b/", "a#b#c"]
    assert column(spark, names.local_name(F.col("x")), [(x,) for x in uris], "x string") == ["c/d", "b", "plain", "", "c"]
    assert column(spark, names.namespace(F.col("x")), [(x,) for x in uris], "x string") == ["http://a/b#", "http://a/", "", "http://a/b/", "a#b#"]
    assert column(spark, names.is_valid_name(F.col("x")), [("aB_1",), ("1a",), ("a-b",), (None,), ("é1",)], "x string") == [True, False, False, False, True]


def test_hash_ids(spark):
    name = "orchard:water:Sprinkler"
    want = str(10**12 + int.from_bytes(hashlib.sha256(name.encode()).digest()[:8], "big") % 10**12)
    assert column(spark, ids.hash_id(F.col("x")), [(f"dtmi:{name};1",), (f"dtmi:{name};2",)], "x string") == [want, want]
    want += f"{int(hashlib.md5(b'p').hexdigest()[:8], 16) % 10000:04d}"
    assert column(spark, ids.member_id(ids.hash_id(F.col("x")), F.lit("p")), [(f"dtmi:{name};1",)], "x string") == [want]


def test_model_identifiers(spark):
    xs = ["dtmi:a:b;1", "dtmi:a:b", "dtmi:1a;1", "dtmi:a;0", "x:a;1", None, "dtmi:dtdl:x;1", "dtmi:" + "a" * 200 + ";1"]
    assert column(spark, names.dtmi_faults(F.col("x")), [(x,) for x in xs], "x string") == [None, None, "syntax", "syntax", "syntax", "syntax", "reserved", "length"]


def test_types(spark):
    xs = ["integer", "time", "decimal", "date", "other", None]
    got = column(spark, types.xsd_type(F.concat(F.lit(types.XSD), F.col("x"))), [(x,) for x in xs], "x string")
    assert got == ["BigInt", "String", "Double", "DateTime", "String", "String"]
    got = column(spark, types.cdm_type(F.col("x"), F.array(F.lit("is.dataFormat.date"))), [("GUID",), ("Price",), ("entityId",), ("time",)], "x string")
    assert [(r.type, r.how) for r in got] == [("String", "primitive"), ("Decimal", "semantic"), ("DateTime", "trait"), ("DateTime", "primitive")]
    sets = [["String", "BigInt"], ["Double", "Decimal"], ["Boolean"], [], ["DateTime", "Double"]]
    assert column(spark, types.union_type(F.col("x")), [(x,) for x in sets], "x array<string>") == ["BigInt", "Double", "Boolean", "String", "Double"]
    assert column(spark, types.family_type(F.col("x")), [(x,) for x in sets], "x array<string>") == ["String", "Double", "Boolean", "String", "String"]
    with pytest.raises(Exception, match="unknown type"):
        column(spark, types.cdm_type(F.col("x"), None, strict=True)["type"], [("odd",)], "x string")


def test_registry(spark):
    r = types.default_registry()
    r.add("rdf", "my", "BigInt", convert=lambda c: c.cast("long"))
    assert column(spark, r.type_of("owl", F.col("x")), [("my",), ("none",)], "x string") == ["BigInt", "String"]
    assert column(spark, r.convert("ttl", "my", F.col("x")), [("12",)], "x string") == [12]
    assert r.losing("dtdl") == ["decimal"] and r.table(spark).count() == len(r.rows)
    with pytest.raises(ValueError):
        r.add("rdf", "x", "Odd")


def test_values(spark):
    got = column(spark, values.scaled_value(F.col("v"), F.col("s")), [("7", 2), ("1.5", -1), ("x", 1), (None, 1)], "v string, s int")
    assert got[:2] == [700.0, pytest.approx(0.15)] and all(math.isnan(x) for x in got[2:])
    assert column(spark, values.scaled_text(F.col("v"), F.col("s"), "json_string"), [("7", 2)], "v string, s int") == ['{"scale":2,"value":"7"}']
    assert column(spark, values.success_rate(F.col("a"), F.col("b")), [(0, 0), (3, 1)], "a long, b long") == [100.0, 75.0]
    assert column(spark, values.retry_wait(F.col("n"), F.col("r")), [(1, None), (9, None), (1, 7)], "n int, r int") == [2.0, 60.0, 7.0]
    texts = ["a", "é\n", ""]
    assert column(spark, values.decoded(values.encoded(F.col("x"))), [(x,) for x in texts], "x string") == texts
    assert column(spark, values.decoded(F.col("x")), [("%%",), ("/w==",)], "x string") == [None, None]


def test_urls(spark):
    cases = {"https://a.org/x": None, "http://a.org": "scheme", "https://localhost/": "local", "https://10.1.2.3/": "private", "https://[::1]/": "private", "https://a.org:80/": "port", "https://u@a.org:8443/": None, "": "empty", "https://203.0.113.9/": "private", "https://8.8.8.8/": None}
    assert column(spark, values.url_fault(F.col("x")), [(x,) for x in cases], "x string") == list(cases.values())
    assert column(spark, values.ontology_url_fault(F.col("x")), [("https://www.w3.org/x",), ("https://w3.org.evil.com/",)], "x string") == [None, "domain"]
    assert column(spark, values.loggable_url(F.col("x")), [("https://u:p@a.org/b?c#d",)], "x string") == ["https://a.org/b"]


def test_guards(tmp_path):
    f = tmp_path / "a.ttl"
    f.write_text("x")
    assert guards.check_path(str(f), extensions=(".ttl",), root=str(tmp_path)) == f.resolve()
    (tmp_path / "l.ttl").symlink_to(f)
    for bad in (f"{tmp_path}/../x", "", f"{tmp_path}/l.ttl", f"{tmp_path}/no.ttl", f"{tmp_path}/a.txt"):
        with pytest.raises((ValueError, FileNotFoundError)):
            guards.check_path(bad, extensions=(".ttl",))
    with pytest.raises(TypeError):
        guards.check_prefix(True)
    assert guards.memory_allows(600, 9999)[0] is False and guards.memory_allows(600, 10, force=True)[0] and guards.should_stream(101)


def test_ids_unique_and_in_order(spark):
    df = spark.createDataFrame([("f", x) for x in "cab"] + [("g", "z")], "file string, k string")
    got = {(r.file, r.k): r.id for r in ids.numbered(df, "k", partition=("file",)).collect()}
    assert got == {("f", "a"): "1000000000001", ("f", "b"): "1000000000002", ("f", "c"): "1000000000003", ("g", "z"): "1000000000001"}


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=10))
def test_sanitised_names_are_valid(spark, xs):
    got = column(spark, names.is_valid_name(names.sanitize(F.col("x"))), [(x,) for x in xs] or [("a",)], "x string")
    assert all(got)
