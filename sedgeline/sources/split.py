"""One large document in many tasks: text cut where statements end, by what a scan of each part would do to any state.

A file is read as records between line feeds (Turtle and its kin) or opening braces (JSON), which the engine splits by bytes. A task knows nothing of what stands before its part, so it works out for each way to enter it (outside of strings, in a
string of either kind) how it is left: in which state, and how many brackets deeper. Put together in order, a row a part,
this gives every part's true entry; parts are then cut at statement ends, and what a cut leaves open is joined with the
heads that follow. Parts are held as pieces of about a megabyte, so a task holds one piece at a time; a single statement is
held whole.

Turtle's prefixes and bases can be set anywhere: all settings of a file, without repeats that change nothing, go along
with each of its pieces, and a piece is read under those before it. Labels of blank nodes are the document's; those
without a label are numbered through the document in order, as in a whole reading.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordered import numbered, running
from ..operators.shared import written
from . import turtle

PIECE = 1 << 20
#: Blocks and settings that go along with the pieces by broadcast; more of them are joined by file.
MOST = 1 << 17
#: Ways to be at a place: outside of strings, and in one.
PLAIN = 0
#: The depth at which a document starts that is one object: no part of it is an element.
NEVER = -(1 << 60)

_LONG_END = {1: re.compile(r'(?:[^"\\]|\\.|"(?!""))*"""', re.S), 2: re.compile(r"(?:[^'\\]|\\.|'(?!''))*'''", re.S)}
_JSON = re.compile(r'"(?:[^"\\]|\\.)*"|"|[\[{]|[\]}]', re.S)
_JSON_END = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
_SETTING = re.compile(r"@prefix|@base|\bprefix\b|\bbase\b", re.I)
_INNER = re.sub(r"\?P<\w+>", "?:", turtle._TOKEN.pattern)
#: The next token that may end a statement, change the depth or open a long string, with all before it.
_STOP = re.compile(rf"""(?:(?>{_INNER}|.)(?<![\[\](){{}}.])(?!(?<="")"|(?<='')'))*+(?:{turtle._TOKEN.pattern}|.|\Z)""", re.X | re.S)


def walk_turtle(text: str, mode: int, depth: int) -> tuple[int, int, list[int]]:
    """From a state at the start to the state at the end, and the places where statements end."""
    at, cuts = 0, []
    if mode:
        end = _LONG_END[mode].match(text) if ('"""' if mode == 1 else "'''") in text else None
        if not end:
            return mode, depth, cuts
        at = end.end()
    for m in _STOP.finditer(text, at):
        kind = m.lastgroup
        if kind is None or kind == "ws" or kind == "iri":
            continue
        value = m[kind]
        if kind == "op":
            if value in "[({":
                depth += 1
            elif value in "])}":
                depth -= 1
                if value == "}" and depth == 0:
                    cuts.append(m.end())
            elif value == "." and depth == 0:
                cuts.append(m.end())
        elif kind == "str" and len(value) == 2 and text[m.end() : m.end() + 1] == value[0]:
            return (1 if value == '""' else 2), depth, cuts  # a long string that this text does not end
        elif kind in ("name", "bnode", "num") and value[-1] == "." and depth == 0:
            cuts.append(m.end())
    return PLAIN, depth, cuts


def walk_json(text: str, mode: int, depth: int) -> tuple[int, int, list[int]]:
    """The same for one array: its elements that are objects or arrays end where the depth is one again."""
    at, cuts = 0, []
    if mode:
        end = _JSON_END.match(text)
        if not end:
            return mode, depth, cuts
        at = end.end()
    for m in _JSON.finditer(text, at):
        c = m[0]
        if c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
            if depth == 1:
                cuts.append(m.end())
        elif c == '"':
            return 1, depth, cuts
    return PLAIN, depth, cuts


#: walk, what ends a record, and the number of ways to enter.
KINDS = {"turtle": (walk_turtle, "\n", 3), "json": (walk_json, "{", 2)}

_PIECES = "file string, block long, seq long, body binary, valid boolean, modes array<int>, depths array<long>, end_modes array<int>, end_depths array<long>"
_FRAGMENTS = "file string, block long, seq long, part int, closes boolean, text string"
_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(x.split()[0], _ARROW[x.split()[1]]) for x in ddl.split(", ")])


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = _schema(ddl)
    cols = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _runs(b: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """The records of a batch (file, block, value) by stretches of the same part."""
    file, block, value = b.columns
    n = len(value)
    changes = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1])).to_numpy(zero_copy_only=False) if n > 1 else np.array([], bool)
    places = [0, *(np.flatnonzero(changes) + 1).tolist(), n] if n else [0]
    for i, j in zip(places, places[1:], strict=False):
        yield (file[i].as_py(), block[i].as_py()), value[i:j]


def _gathered(batches: Iterator[pa.RecordBatch], kind: str, piece: int) -> Iterator[pa.RecordBatch]:
    """Records of one part after the other, as pieces with the state at both ends for each state at the part's start."""
    walk, sep, ways = KINDS[kind]
    held: list[bytes] = []
    part, size, seq, now = None, 0, 0, []

    def close():
        nonlocal held, size, seq, now
        body = b"".join(held)
        text = body.decode("latin-1")  # what matters here is ASCII
        left = {m: walk(text, m, 0) for m in {m for m, _ in now}}
        new = [(left[m][0], d + left[m][1]) for m, d in now]
        try:
            body.decode()
            valid = True
        except UnicodeDecodeError:
            valid = False
        row = (*part, seq, body, valid, [m for m, _ in now], [d for _, d in now], [m for m, _ in new], [d for _, d in new])
        held, size, seq, now = [], 0, seq + 1, new
        return _batch([row], _PIECES)

    for b in batches:
        for (file, block), values in _runs(b):
            sizes = np.cumsum(pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            values = values.to_pylist()
            lead = 0
            if (file, block) != part:
                if held:
                    yield close()
                part, seq, now = (file, block), 0, [(m, 0) for m in range(ways)]
                held, size = [], 0
                if block == 0:  # nothing ends before a file's first record
                    if kind == "json" and not values[0].strip(b"\xef\xbb\xbf \t\r\n"):
                        now = [(m, NEVER) for m in range(ways)]
                    lead = 1
            at, past = 0, lead
            while at < len(values):
                end = min(int(np.searchsorted(sizes, past + piece - size)) + 1, len(values))
                body = sep.encode() + sep.encode().join(values[at:end])
                held.append(body[lead:])
                size += int(sizes[end - 1]) - past
                at, past, lead = end, int(sizes[end - 1]), 0
                if size >= piece:
                    yield close()
    if held:
        yield close()


def _cut(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    walk = KINDS[kind][0]
    for b in batches:
        for file, block, seq, body, valid, mode, depth in zip(*(c.to_pylist() for c in b.columns), strict=True):
            text = body.decode("utf-8" if valid else "latin-1")
            _, _, cuts = walk(text, mode, depth)
            if not cuts:
                rows = [(file, block, seq, 0, False, text)]
            else:
                a, z = cuts[0], cuts[-1]
                rows = [(file, block, seq, 0, True, text[:a]), (file, block, seq, 1, None, text[a:z]), (file, block, seq, 2, False, text[z:])]
            yield _batch([r for r in rows if r[5] or r[4]], _FRAGMENTS)


def units(records: DataFrame, kind: str, piece: int = PIECE) -> DataFrame:
    """`records` (file, block, value binary), a file's blocks in their own order, to stretches of whole statements: (file,
    block, seq, part, text), in this order. What follows a file's last statement is a stretch of its own."""
    held = written(records.mapInArrow(partial(_gathered, kind=kind, piece=piece), _PIECES), "pieces")
    blocks = held.groupBy("file", "block").agg(F.max_by("end_modes", "seq").alias("modes"), F.max_by("end_depths", "seq").alias("depths"), F.bool_and("valid").alias("valid"))
    files = blocks.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "modes", "depths"))).alias("bs"), F.bool_and("valid").alias("valid"))
    none = "CAST(ARRAY() AS array<struct<block:bigint,mode:int,depth:bigint>>)"
    step = "(a, b) -> named_struct('m', b.modes[a.m], 'd', a.d + b.depths[a.m], 'out', concat(a.out, array(named_struct('block', b.block, 'mode', a.m, 'depth', a.d))))"
    entries = files.select("file", F.col("valid").alias("utf8"), F.expr(f"inline(aggregate(bs, named_struct('m', 0, 'd', 0L, 'out', {none}), {step}).out)")).withColumnRenamed("mode", "entry")
    entered = held.drop("valid").join(_along(entries.withColumnRenamed("depth", "base"), "entries"), ["file", "block"])
    entered = entered.select("file", "block", "seq", "body", "utf8", F.expr("modes[entry]").alias("mode"), F.expr("base + depths[entry]").alias("depth"))
    parts = written(entered.mapInArrow(partial(_cut, kind=kind), _FRAGMENTS), "fragments")
    # A statement that a cut leaves open is a tail, pieces without an end and a head, all after the same number of ends.
    open_ = running(parts.where("part <> 1"), ["file"], ["block", "seq", "part"], F.col("closes").cast("long"), "ends")
    place = F.struct("block", "seq", "part")
    joined = open_.groupBy("file", "ends").agg(F.array_sort(F.collect_list(F.struct("block", "seq", "part", "text"))).alias("xs"), F.max(place).alias("at"))
    joined = joined.select("file", "at.block", "at.seq", "at.part", F.array_join(F.transform("xs", lambda x: x["text"]), "").alias("text"))
    return written(parts.where("part = 1").select("file", "block", "seq", "part", "text").unionByName(joined).where(F.col("text").rlike(r"\S")), "units")


def _along(rows: DataFrame, name: str) -> DataFrame:
    """`rows`, written, to be joined with pieces: by broadcast where they are few, so that the pieces stay where they are. A join
    by file would put a file's pieces into one task."""
    rows = written(rows, name)
    return F.broadcast(rows) if rows.count() <= MOST else rows


def records(spark: SparkSession, path: str | list[str], kind: str, where: Column | None = None, recursive: bool = True) -> DataFrame:
    """Files as (file, block, value): a record a row, split by bytes into as many tasks as the session's settings ask for."""
    text = spark.read.option("lineSep", KINDS[kind][1]).option("recursiveFileLookup", str(recursive).lower()).text(path)
    text = text if where is None else text.where(where)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


# ---- Turtle

_SETTINGS = "file string, block long, seq long, part int, k int, name string, source string"
_QUADS = "file string, block long, seq long, part int, g string, s string, s_kind string, s_k long, p string, o string, o_kind string, o_k long, o_datatype string, o_lang string, fresh long, fault string"


def settings_of(text: str) -> list[tuple[str, str]]:
    """The prefixes and bases that a stretch of statements sets, in order: (name, source text)."""
    out = []
    low = text.lower()
    if "prefix" not in low and "base" not in low or not _SETTING.search(text):
        return out
    depth, due, tokens = 0, True, []
    for m in turtle._TOKEN.finditer(text):
        kind, value = m.lastgroup, m[0]
        if kind == "ws":
            continue
        if tokens:
            tokens.append(value)
            if kind == "iri":
                name = tokens[1] if len(tokens) == 3 else ""
                out.append((name, " ".join(tokens) + (" ." if tokens[0].startswith("@") else "")))
                due, tokens = not tokens[0].startswith("@"), []
            elif len(tokens) > 3:
                tokens = []
            continue
        if due and value.lower() in ("@prefix", "@base", "prefix", "base"):
            tokens = [value]
            continue
        due = False
        if kind == "op":
            depth += (value in "[({") - (value in "])}")
            due = depth == 0 and value in ".}"
        elif kind in ("name", "bnode", "num") and value[-1] == "." and depth == 0:
            due = True
    return out


def _settings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for *at, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            rows += [(*at, k, name, source) for k, (name, source) in enumerate(settings_of(text))]
        yield _batch(rows, _SETTINGS)


def _parsed(batches: Iterator[pa.RecordBatch], base: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for file, block, seq, part, text, kind, before in zip(*(c.to_pylist() for c in b.columns), strict=True):
            at = (file, block, seq, part)
            source = "\n".join([s["source"] for s in before or () if (s["block"], s["seq"], s["part"]) < at[1:]] + [text])
            reader = turtle.Reader("", base, graphs=kind == "trig", n3=kind == "n3")
            rows, fault = [], None
            try:
                reader.tokens = reader._split(source)
                reader.read()
                for g, s, p, o in reader.out:
                    rows.append((g, *_node(file, s), p, *_node(file, o), o[2], o[3], None, None))
            except Exception as e:  # whatever a reader says of a document belongs to that document
                rows, fault = [], f"{type(e).__name__}: {e}"
            rows.append((*[None] * 10, reader.count, fault))
            schema = _schema(_QUADS)
            place = [pa.repeat(pa.scalar(x, f.type), len(rows)) for x, f in zip(at, schema, strict=False)]
            cols = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(schema)[len(at) :], strict=True)]
            yield pa.RecordBatch.from_arrays(place + cols, schema=schema)


def _node(file: str, node: turtle.Node) -> tuple[str, str, int | None]:
    """Value, kind, and the number of a blank node without a label."""
    value, kind = node[0], node[1]
    if kind != "bnode":
        return value, kind, None
    fresh = int(value[1:]) if value[0] == "b" else None
    return f"{file}#{value}", kind, fresh


def read_turtle(recs: DataFrame, fmt: Column | None = None, base: str = "", piece: int = PIECE) -> DataFrame:
    """`records` of Turtle, TriG or N3 documents as triples, as `rdf.documents_to_triples` gives them for whole texts: a document
    that cannot be read gives one row with a fault, of its first stretch that fails, and no triples."""
    us = units(recs, "turtle", piece)
    kind = (fmt if fmt is not None else F.lit("turtle")).alias("kind")
    found = us.mapInArrow(_settings, _SETTINGS)
    # A setting that says again what holds already is left out, so that joined documents with one prologue each send one.
    place = [F.col(c) for c in ("block", "seq", "part", "k")]
    last = Window.partitionBy("file", "name").orderBy(*place)
    bases = F.max(F.col("name") == "").over(Window.partitionBy("file"))
    said = F.regexp_extract("source", "<.*>", 0)
    found = written(found.withColumn("again", F.coalesce(F.lag(said).over(last) == said, F.lit(False)) & ~bases).where("not again").drop("again"), "settings")
    few = found.count() <= MOST
    per_file = found.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "seq", "part", "k", "source"))).alias("before"))
    quads = us.join(F.broadcast(per_file) if few else per_file, "file", "left").select("file", "block", "seq", "part", "text", kind, "before").mapInArrow(partial(_parsed, base=base), _QUADS)
    quads = written(quads, "quads")
    bad = quads.where("fault is not null").groupBy("file").agg(F.min_by("fault", F.struct("block", "seq", "part")).alias("fault"))
    counts = running(quads.where("p is null").select("file", "block", "seq", "part", "fresh"), ["file"], ["block", "seq", "part"], F.col("fresh"), "past").drop("fresh")
    name = lambda x: F.when(F.col(f"{x}_k").isNull(), F.col(x)).otherwise(F.concat("file", F.lit("#b"), (F.col("past") + F.col(f"{x}_k")).cast("string"))).alias(x)
    # Only rows with a blank node that has no label ask for its number in the document.
    unlabelled = F.col("s_k").isNotNull() | F.col("o_k").isNotNull()
    fine = quads.where(F.col("p").isNotNull() & ~unlabelled).withColumn("past", F.lit(None).cast("long"))
    fine = fine.unionByName(quads.where(F.col("p").isNotNull() & unlabelled).join(counts, ["file", "block", "seq", "part"]))
    fine = fine.join(_along(bad.select("file"), "faults"), "file", "left_anti")
    none = [F.lit(None).cast("string").alias(c) for c in ("g", "s", "s_kind", "p", "o", "o_kind", "o_datatype", "o_lang")]
    triples = fine.select("file", "g", name("s"), "s_kind", "p", name("o"), "o_kind", "o_datatype", "o_lang", F.lit(None).cast("string").alias("fault"))
    return triples.unionByName(bad.select("file", *none, "fault"))


# ---- JSON

_ELEMENTS = "file string, block long, seq long, part int, k int, element string, fault string, ends boolean"
_BLANK = re.compile(r"[\s,]*")


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read = json.JSONDecoder().raw_decode
    for b in batches:
        for file, block, seq, part, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            at, k, rows = 0, 0, []
            body = text.lstrip("\ufeff \t\r\n")
            whole = body.startswith("{")  # a document that is one object; what is cut from an array starts with a comma
            if body.startswith("["):
                body = body[1:]
            while (at := _BLANK.match(body, at).end()) < len(body):
                last = body[at] == "]" and not body[at + 1 :].strip()
                if not last:
                    try:
                        _, end = read(body, at)
                    except ValueError as e:
                        rows.append((file, block, seq, part, k, None, f"{type(e).__name__}: {e}", False))
                        break
                    rows.append((file, block, seq, part, k, body[at:end], None, False))
                    at, k = end, k + 1
                if last or whole:
                    rows.append((file, block, seq, part, k, None, None, True))
                    break
            yield _batch(rows, _ELEMENTS)


def array_elements(recs: DataFrame, piece: int = PIECE) -> DataFrame:
    """`records` of JSON arrays as (file, number, element, fault): each element's own text, numbered from 0 in its file. A document
    that is one object is its only element. A stretch that cannot be read, and an array without an end, give a row with a
    fault in their place."""
    found = written(units(recs, "json", piece).mapInArrow(_decoded, _ELEMENTS), "elements")
    ends = found.groupBy("file").agg(F.bool_or("ends").alias("whole"), F.max(F.struct("block", "seq", "part", "k")).alias("at"))
    cut = ends.where("not whole").select("file", "at.block", "at.seq", "at.part", (F.col("at.k") + 1).alias("k"), F.lit(None).cast("string").alias("element"), F.lit("ValueError: the array does not end").alias("fault"))
    rows = found.where("not ends").drop("ends").unionByName(cut)
    return numbered(rows, ["file"], ["block", "seq", "part", "k"]).select("file", "number", "element", "fault")


# ---- Chunks of one document as a stream

def chunked(parts: DataFrame, folder: str, order: list[str], size: int) -> DataFrame:
    """A stream over the rows of `parts` in micro-batches of at most so many rows, in order: they are written as files of that
    size, which the stream takes one by one. `chunk` is the number of the file's range and of its place there."""
    parts.repartitionByRange(*order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", size).mode("overwrite").parquet(folder)
    return parts.sparkSession.readStream.schema(parts.schema).option("maxFilesPerTrigger", 1).parquet(folder)
