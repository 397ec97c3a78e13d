"""Whole tasks on documents: convert, validate, export, compare, round trip. One plan for any number of files."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdm, checks, compare, dtdl, export, rdf, report, serialize
from ..operators.rdf import Converted
from ..operators.shared import written
from ..sources import cdm as cdm_source
from ..sources import dtdl as dtdl_source
from ..sources import rdf as rdf_source

FORMATS = ("rdf", "dtdl", "cdm")


class NotValid(ValueError):
    """A definition with errors; the first of them are its text."""


def format_of(path: Column) -> Column:
    """The family of a file by its name: business-data suffixes first, then digital twins, then graphs."""
    low = F.lower(path)
    rdf_ext = F.regexp_extract(low, r"\.([a-z0-9-]+)$", 1).isin(*rdf_source.EXTENSIONS)
    return F.when(low.rlike(r"(\.cdm\.json|(^|/)model\.json)$"), "cdm").when(low.rlike(r"\.(json|dtdl)$"), "dtdl").when(rdf_ext, "rdf")


def read_folder(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Documents (file, text) of a folder by family."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    docs = files.select(F.col("path").alias("file"), rdf_source._decoded(F.col("content")).alias("text"), format_of(F.col("path")).alias("family"))
    return {f: docs.where(F.col("family") == f).select("file", "text") for f in FORMATS}


def parsed(docs: DataFrame, family: str, **how: Any) -> Any:
    if family == "rdf":
        return written(rdf_source.graph(rdf_source.documents_to_triples(docs, **how)), "triples")
    return {"dtdl": dtdl_source, "cdm": cdm_source}[family].parse(docs)


def converted(docs: DataFrame, family: str, **how: Any) -> Converted:
    x = parsed(docs, family)
    return {"rdf": rdf, "dtdl": dtdl, "cdm": cdm}[family].convert(x, **how)


def validated(docs: DataFrame, family: str, *, strict: bool = False, **how: Any) -> DataFrame:
    """All issues of the documents."""
    if family == "rdf":
        t = written(rdf_source.documents_to_triples(docs, **how), "triples")
        out = checks.faults(t).unionByName(checks.preflight(rdf_source.graph(t)))
    else:
        out = {"dtdl": dtdl, "cdm": cdm}[family].issues(parsed(docs, family))
    return checks.strict(out) if strict else out


def definition(c: Converted, ontology: DataFrame, *, skip_validation: bool = False, skip_limits: bool = False, profile: str = "service") -> DataFrame:
    """Parts, after the checks; errors raise."""
    found = []
    if not skip_validation:
        found.append(checks.definition_issues(c.entities, c.properties, c.relationships))
    if not skip_limits:
        found.append(checks.limit_issues(c.entities, c.properties, c.relationships, profile))
    if found:
        bad = checks.union(found).where("severity = 'error'").orderBy("file", "code", "uri").limit(5).collect()
        if bad:
            raise NotValid("; ".join(f"{r.file}: {r.code} {r.uri}: {r.message}" for r in bad))
    return serialize.definition_parts(c.entities, c.properties, c.relationships, ontology)


def titled(docs: DataFrame) -> DataFrame:
    """(file, ontology): each file's stem as the name of its ontology."""
    from ..functions import names

    stem = F.regexp_replace(F.substring_index("file", "/", -1), r"\.[^.]*$", "")
    return docs.select("file", names.service_name(stem).alias("ontology")).distinct()


def definition_json(parts: DataFrame) -> DataFrame:
    """(file, json): the definition of each document."""
    item = F.struct("ord", F.struct("path", "payload", "payloadType").alias("part"))
    return parts.groupBy("file").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["part"]).alias("parts")).select("file", F.to_json(F.struct(F.struct("parts").alias("definition"))).alias("json"))


def round_trip(spark: SparkSession, text: str, fmt: str = "turtle") -> dict[str, Any]:
    """Text to definition to text, compared with itself; what goes wrong is a result."""
    try:
        docs = spark.createDataFrame([("given", text)], "file string, text string")
        t = parsed(docs, "rdf", fmt=F.lit(fmt))
        if t.isEmpty():
            raise ValueError("no triples")
        c = rdf.convert(t)
        parts = definition(c, rdf.ontology_names(t), skip_validation=True, skip_limits=True)
        e, p, r = serialize.relations_of(written(parts, "parts"))
        out = export.turtle(export.triples_of(e, p, r, rdf.ontology_names(t))).first().text
        again = parsed(spark.createDataFrame([("again", out)], "file string, text string"), "rdf", fmt=F.lit("turtle"))
        rows = {x.kind: x.asDict() for x in compare.summary(t, again).collect()}
        return {"success": bool(rows["all"]["equal"]), "exported": out, "comparison": rows}
    except Exception as e:
        return {"success": False, "error": f"{type(e).__name__}: {e}"}


def compared(spark: SparkSession, a: str, b: str) -> dict[str, Any]:
    """The semantic difference of two Turtle texts."""
    one, two = (parsed(spark.createDataFrame([("x.ttl", t)], "file string, text string"), "rdf") for t in (a, b))
    rows = {x.kind: x.asDict() for x in compare.summary(one, two).collect()}
    rows["differences"] = [r.asDict() for r in compare.differences(one, two).orderBy("kind", "name").collect()]
    return rows


def exported(spark: SparkSession, text: str) -> str:
    """The Turtle text of a definition document."""
    parts = serialize.parts_of_document(spark, text)
    e, p, r = serialize.relations_of(parts)
    names = serialize.decoded_parts(parts).where("kind = 'platform'").select("file", F.get_json_object("json", "$.metadata.displayName").alias("ontology"))
    return export.turtle(export.triples_of(e, p, r, names)).first().text


def main(argv: list[str] | None = None) -> int:
    """validate, convert, export, compare on local paths; prints JSON or text."""
    import argparse

    ap = argparse.ArgumentParser(prog="sedgeline")
    ap.add_argument("verb", choices=("validate", "convert", "export", "compare"))
    ap.add_argument("paths", nargs="+")
    ap.add_argument("--format", choices=FORMATS)
    ap.add_argument("--strict", action="store_true")
    ap.add_argument("--output")
    ap.add_argument("--skip-validation", action="store_true")
    ap.add_argument("--component-mode", default="skip")
    ap.add_argument("--command-mode", default="skip")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    text = lambda p: open(p, encoding="utf-8").read()
    if a.verb == "compare":
        out = compared(spark, text(a.paths[0]), text(a.paths[1]))
        print(json.dumps(out, indent=2))
        return 0 if out["all"]["equal"] else 1
    if a.verb == "export":
        out = exported(spark, text(a.paths[0]))
    else:
        docs = read_folder(spark, a.paths[0])
        families = [a.format] if a.format else [f for f in FORMATS if not docs[f].isEmpty()]
        if a.verb == "validate":
            found = checks.union([validated(docs[f], f, strict=a.strict) for f in families])
            for r in report.issues_json(found).toLocalIterator():
                print(r.json)
            return int(not found.where("severity = 'error'").isEmpty())
        lines = []
        for f in families:
            how = {"components": a.component_mode, "commands": a.command_mode} if f == "dtdl" else {}
            c = converted(docs[f], f, **how)
            lines += [r.json for r in definition_json(definition(c, titled(docs[f]), skip_validation=a.skip_validation, skip_limits=a.skip_validation)).toLocalIterator()]
        out = "\n".join(lines)
    if a.output:
        with open(a.output, "w", encoding="utf-8") as f:
            f.write(out)
    else:
        print(out)
    return 0
