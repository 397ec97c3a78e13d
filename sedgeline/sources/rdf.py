"""RDF documents as a DataFrame of triples.

N-Triples and N-Quads are read line by line in SQL functions, split at will; Turtle, TriG and N3 of some size are cut where
statements end (`split`); the other syntaxes are read whole, a document a row, by Arrow-batched readers. A document that cannot be read gives a row in `faults` and no triples.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shared import written
from . import markup, split, turtle

# The names that syntaxes go by, and their file extensions.
FORMATS = ("turtle", "xml", "nt", "n3", "trig", "nquads", "trix", "json-ld", "hext", "rdfa", "microdata")
DATASETS = ("trig", "nquads", "trix", "hext")
ALIASES = {
    "turtle": "ttl turtle", "xml": "rdf rdfxml rdf-xml owl xml", "nt": "nt ntriples n-triples", "n3": "n3", "trig": "trig",
    "nquads": "nq nquad nquads", "trix": "trix", "json-ld": "jsonld json_ld json-ld", "hext": "hext hextuples",
    "rdfa": "rdfa html xhtml htm", "microdata": "microdata",
}
EXTENSIONS = {"ttl": "turtle", "turtle": "turtle", "rdf": "xml", "owl": "xml", "xml": "xml", "nt": "nt", "n3": "n3", "trig": "trig", "nq": "nquads", "nquads": "nquads", "trix": "trix", "jsonld": "json-ld", "json-ld": "json-ld", "hext": "hext", "html": "rdfa", "xhtml": "rdfa", "htm": "rdfa", "svg": "rdfa"}
DEFAULT = "turtle"
TRIPLES = "file string, g string, s string, s_kind string, p string, o string, o_kind string, o_datatype string, o_lang string"
COLUMNS = [x.split()[0] for x in TRIPLES.split(", ")]


def _map(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def normalized(fmt: Column) -> Column:
    """The format that an alias stands for; other names stay, in lower case."""
    low = F.lower(F.trim(fmt))
    return F.coalesce(_map({a: f for f, xs in ALIASES.items() for a in xs.split()}, low), F.nullif(low, F.lit("")))


def inferred(path: Column) -> Column:
    """The format of a file by its extension; null if unknown."""
    return _map(EXTENSIONS, F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9-]+)$", 1)))


def resolved(fmt: Column, path: Column) -> Column:
    """What is given, else what the path says, else Turtle; an unsupported format is an error."""
    found = F.coalesce(normalized(fmt), inferred(path), F.lit(DEFAULT))
    return F.when(found.isin(*FORMATS), found).otherwise(F.raise_error(F.concat(F.lit("unsupported RDF format: "), found)))


def resolve_format(fmt: str | None, path: str | None = None) -> str:
    """The same on the driver."""
    low = (fmt or "").strip().lower()
    found = {a: f for f, xs in ALIASES.items() for a in xs.split()}.get(low, low) or None
    found = found or EXTENSIONS.get((path or "").rpartition(".")[2].lower()) or DEFAULT
    if found not in FORMATS:
        raise ValueError(f"unsupported RDF format: {fmt or found}")
    return found


_IRI = r"<([^<>\"{}|^`\x00-\x20]*)>"
_BNODE = r"_:([^\s<>\"]+?)"
_LITERAL = r'"((?:[^"\\]|\\.)*)"(?:\^\^<([^>]*)>|@([A-Za-z]+(?:-[A-Za-z0-9]+)*))?'
_LINE = rf"^\s*(?:{_IRI}|{_BNODE})\s+{_IRI}\s+(?:{_IRI}|{_BNODE}|{_LITERAL})\s*(?:(?:{_IRI}|{_BNODE})\s*)?\.\s*(?:#.*)?$"


def _unescaped(text: Column) -> Column:
    """Escapes of N-Triples; `\\u` by a JSON string, which has the same ones."""
    simple = F.when(~F.contains(text, F.lit("\\")), text)
    long = F.regexp_replace(text, r"\\U0000([0-9A-Fa-f]{4})", r"\\u$1")
    json = F.concat(F.lit('{"x":"'), F.regexp_replace(F.regexp_replace(long, r"\\'", "'"), r"\t", r"\\t"), F.lit('"}'))
    return F.coalesce(simple, F.get_json_object(json, "$.x"), text)


def lines_to_triples(lines: DataFrame, file: str = "file", line: str = "line") -> DataFrame:
    """N-Triples or N-Quads lines (file, line) as triples; `bad` lines are kept with a null predicate by `line_faults`."""
    x = F.col(line)
    part = lambda k: F.regexp_extract(x, _LINE, k)
    rows = lines.where(x.rlike(_LINE))
    s_iri, s_b, p, o_iri, o_b, o_lit, o_type, o_lang, g_iri, g_b = (part(k) for k in range(1, 11))
    is_iri = lambda k: F.regexp_extract(x, _LINE, k) != ""
    literal = (o_iri == "") & (o_b == "") & x.rlike(r'"')
    o_kind = F.when(is_iri(4), "iri").when(is_iri(5), "bnode").otherwise("literal")
    return rows.select(
        F.col(file).alias("file"),
        F.coalesce(F.nullif(g_iri, F.lit("")), F.nullif(g_b, F.lit(""))).alias("g"),
        F.when(is_iri(2), F.concat(F.lit("n"), s_b)).otherwise(_unescaped(s_iri)).alias("s"),
        F.when(is_iri(2), "bnode").otherwise("iri").alias("s_kind"),
        _unescaped(p).alias("p"),
        F.when(literal, _unescaped(o_lit)).when(is_iri(5), F.concat(F.lit("n"), o_b)).otherwise(_unescaped(o_iri)).alias("o"),
        F.when(literal, "literal").otherwise(o_kind).alias("o_kind"),
        F.when(literal & (o_lang == ""), F.coalesce(F.nullif(o_type, F.lit("")), F.lit(turtle.XSD + "string"))).alias("o_datatype"),
        F.when(literal, F.lower(F.nullif(o_lang, F.lit("")))).alias("o_lang"),
    )


def line_faults(lines: DataFrame, file: str = "file", line: str = "line") -> DataFrame:
    """Lines that are neither triples nor blank nor comments."""
    x = F.col(line)
    return lines.where(~x.rlike(_LINE) & ~x.rlike(r"^\s*(#.*)?$")).select(F.col(file).alias("file"), F.concat(F.lit("syntax error: "), F.substring(x, 1, 80)).alias("fault"))


def parse(text: str, fmt: str, base: str = "") -> list[turtle.Quad]:
    """The quads of one document."""
    if fmt == "turtle":
        return list(turtle.read(text, base))
    if fmt == "n3":
        return list(turtle.read(text, base, n3=True))
    if fmt == "trig":
        return list(turtle.read(text, base, graphs=True))
    if fmt in ("nt", "nquads"):
        return [q for line in text.splitlines() for q in _line_quads(line)]
    if fmt == "xml":
        return list(markup.read_xml(text, base))
    if fmt == "trix":
        return list(markup.read_trix(text))
    if fmt == "json-ld":
        return list(markup.read_jsonld(text, base))
    if fmt == "hext":
        return list(markup.read_hext(text))
    return list(markup.read_html(text, base, micro=fmt == "microdata"))


def _line_quads(line: str) -> list[turtle.Quad]:
    if not line.strip() or line.lstrip().startswith("#"):
        return []
    m = re.match(_LINE, line)
    if not m:
        raise ValueError(f"syntax error: {line[:80]}")
    u = turtle.unescape
    s = turtle.iri(u(m[1])) if m[1] is not None else ("n" + m[2], "bnode", None, None)
    o = turtle.iri(u(m[4])) if m[4] is not None else ("n" + m[5], "bnode", None, None) if m[5] is not None else turtle.literal(u(m[6]), m[7], m[8])
    return [(m[9] or m[10], s, u(m[3]), o)]


def documents_to_triples(docs: DataFrame, *, file: str = "file", text: str = "text", fmt: Column | None = None, base: str = "") -> DataFrame:
    """Whole documents (file, text) as triples, with a `fault` column: rows with a fault have no triple.
    Blank nodes carry their document's name, so that no two documents share one."""
    kind = fmt if fmt is not None else resolved(F.lit(None).cast("string"), F.col(file))
    types = pa.schema([(c, pa.string()) for c in [*COLUMNS, "fault"]])

    def run(batches):
        for b in batches:
            out = []
            for name, body, f in zip(*(c.to_pylist() for c in b.columns), strict=True):
                try:
                    if not (body or "").strip():
                        raise ValueError("the content is empty")
                    quads = parse(body, f, base)
                except Exception as e:  # whatever a reader says of a document belongs to that document
                    out.append((name, *[None] * 8, f"{type(e).__name__}: {e}"))
                    continue
                own = lambda n, name=name: f"{name}#{n[0]}" if n[1] == "bnode" else n[0]
                out += [(name, g, own(s), s[1], p, own(o), o[1], o[2], o[3], None) for g, s, p, o in quads]
            cols = list(zip(*out, strict=True)) or [()] * 10
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], schema=types)

    return docs.select(F.col(file).cast("string").alias("file"), F.col(text).alias("text"), kind.alias("fmt")).mapInArrow(run, TRIPLES + ", fault string")


def graph(triples: DataFrame) -> DataFrame:
    """Named graphs merged: a set of triples for each file."""
    rows = triples.where("p is not null") if "fault" in triples.columns else triples
    return rows.select("file", "s", "s_kind", "p", "o", "o_kind", "o_datatype", "o_lang").dropDuplicates()


def _decoded(content: Column) -> Column:
    """UTF-8, and Latin-1 for what is not."""
    return F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1"))


#: Turtle and its kin are cut into parts from this size on; lines are always read as such.
WHOLE_MB = 64
LINES, CUT = ("nt", "nquads"), ("turtle", "trig", "n3")


def read(spark: SparkSession, path: str, fmt: str | None = None, *, recursive: bool = True, base: str = "", whole_mb: float = WHOLE_MB) -> DataFrame:
    """Files of one folder, or one file, as triples with `fault`. Lines of N-Triples and N-Quads, and the statements of larger
    Turtle, TriG and N3 files, are read in as many tasks as their size asks for; other files each by one."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    given = F.lit(fmt).cast("string")
    kind = lambda file: resolved(given, file)
    large = F.col("length") >= F.lit(whole_mb * (1 << 20))
    apart = kind(F.col("path")).isin(*LINES), kind(F.col("path")).isin(*CUT) & large
    shares = listed.select(F.when(apart[0], "lines").when(apart[1], "cut").otherwise("whole").alias("way")).distinct()
    ways = {r["way"] for r in shares.collect()}  # at most three rows
    docs = listed.where(~apart[0] & ~apart[1]).select(F.col("path").alias("file"), _decoded(F.col("content")).alias("text"))
    out = documents_to_triples(docs, fmt=kind(F.col("file")), base=base)
    # The same file has one name as a binary and another as text.
    names = listed.select(F.col("_metadata.file_path").alias("uri"), F.col("path").alias("name"))
    if "lines" in ways:
        records = split.records(spark, path, "turtle", kind(F.col("_metadata.file_path")).isin(*LINES), recursive)
        lines = records.join(names, F.col("file") == F.col("uri")).select(F.col("name").alias("file"), _decoded(F.col("value")).alias("line"))
        out = out.unionByName(_whole_lines(lines, listed.where(apart[0]).select(F.col("path").alias("file"))))
    if "cut" in ways:
        wanted = kind(F.col("_metadata.file_path")).isin(*CUT) & (F.col("_metadata.file_size") >= F.lit(whole_mb * (1 << 20)))
        records = split.records(spark, path, "turtle", wanted, recursive).join(names, F.col("file") == F.col("uri")).select(F.col("name").alias("file"), "block", "value")
        out = out.unionByName(split.read_turtle(records, kind(F.col("file")), base))
    return out


def _whole_lines(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Lines of documents as triples; a document with a line that is none, or without any content, gives a fault alone."""
    bad = line_faults(lines).groupBy("file").agg(F.concat(F.lit("ValueError: "), F.min("fault")).alias("fault"))
    empty = files.join(lines.where(F.trim("line") != "").select("file").distinct(), "file", "left_anti").select("file", F.lit("ValueError: the content is empty").alias("fault"))
    faults = written(bad.unionByName(empty), "faults")
    own = lambda x, kind: F.when(F.col(kind) == "bnode", F.concat("file", F.lit("#"), x)).otherwise(F.col(x)).alias(x)
    triples = lines_to_triples(lines).join(faults.select("file"), "file", "left_anti")
    triples = triples.select("file", "g", own("s", "s_kind"), "s_kind", "p", own("o", "o_kind"), "o_kind", "o_datatype", "o_lang", F.lit(None).cast("string").alias("fault"))
    return triples.unionByName(faults.select("file", *[F.lit(None).cast("string").alias(c) for c in COLUMNS[1:]], "fault"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """N-Triples or N-Quads files, split into as many tasks as their size asks for."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line"))
    return lines_to_triples(lines)
