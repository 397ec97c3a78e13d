"""Turtle, TriG and a subset of N3 as quads: a tokenizer and a recursive-descent reader, without other libraries."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urljoin

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
OWL = "http://www.w3.org/2002/07/owl#"

_TOKEN = re.compile(
    r"""
    (?P<ws>[ \t\r\n]+|\#[^\r\n]*)
  | (?P<iri><[^\x00-\x20<>"{}|^`\\]*(?:\\u[0-9A-Fa-f]{4}[^\x00-\x20<>"{}|^`\\]*|\\U[0-9A-Fa-f]{8}[^\x00-\x20<>"{}|^`\\]*)*>)
  | (?P<long>\"\"\"(?:[^"\\]|\\.|\"(?!\"\"))*\"\"\"|'''(?:[^'\\]|\\.|'(?!''))*''')
  | (?P<str>"(?:[^"\\\n\r]|\\.)*"|'(?:[^'\\\n\r]|\\.)*')
  | (?P<lang>@[a-zA-Z]+(?:-[a-zA-Z0-9]+)*)
  | (?P<bnode>_:[\w·À-￿][\w.·À-￿-]*)
  | (?P<num>(?=[\d.+-])[+-]?(?:\d+\.\d*[eE][+-]?\d+|\.?\d+[eE][+-]?\d+|\d*\.\d+|\d+))
  | (?P<name>(?:[A-Za-z_À-￿][\w.·À-￿-]*)?:(?:[\w:·À-￿.-]|%[0-9A-Fa-f]{2}|\\[-_~.!$&'()*+,;=/?\#@%])*)
  | (?P<word>[A-Za-z]+)
  | (?P<op>\^\^|=>|<=|[.;,()\[\]{}=!^])
    """,
    re.X | re.S,
)
_BLANK = re.compile(r"(?:[ \t\r\n]+|#[^\r\n]*)*")
#: The next token with the white space and comments before it.
_NEXT = re.compile(rf"(?:[ \t\r\n]+|\#[^\r\n]*)*+(?:{_TOKEN.pattern}|(?P<end>\Z))", re.X | re.S)
_ESCAPE = re.compile(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", re.S)
_PLAIN = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}

Node = tuple[str, str, str | None, str | None]  # value, kind, datatype, language
Quad = tuple[str | None, Node, str, Node]


def unescape(text: str) -> str:
    def one(m: re.Match) -> str:
        x = m[1]
        if x[0] in "uU" and len(x) > 1:
            return chr(int(x[1:], 16))
        if x not in _PLAIN:
            raise ValueError(f"bad escape \\{x}")
        return _PLAIN[x]

    return _ESCAPE.sub(one, text) if "\\" in text else text


def iri(value: str) -> Node:
    return value, "iri", None, None


def literal(value: str, datatype: str | None = None, lang: str | None = None) -> Node:
    return value, "literal", datatype or (None if lang else XSD + "string"), lang.lower() if lang else None


class Reader:
    """Reads one document; blank nodes get names of their own, in order of appearance."""

    def __init__(self, text: str, base: str = "", graphs: bool = False, n3: bool = False):
        self.tokens = self._split(text)
        self.at = 0
        self.base, self.graphs, self.n3 = base, graphs, n3
        self.prefixes: dict[str, str] = {}
        self.count = 0
        self.out: list[Quad] = []
        self.graph: str | None = None

    def _split(self, text: str) -> list[tuple[str, str]]:
        out, at = [], 0
        following = _NEXT.scanner(text).match
        while m := following():
            kind = m.lastgroup
            value, at = m[kind], m.end()
            if kind == "end":
                break
            if value[-1] == "." and kind in ("name", "bnode", "num"):  # a final stop ends the statement
                cut = 1 if kind == "num" else len(value) - len(value.rstrip("."))
                value, at = value[:-cut], at - cut
                following = _NEXT.scanner(text, at).match
            out.append((kind, value))
        else:
            at = _BLANK.match(text, at).end()
            raise ValueError(f"syntax error in line {text.count(chr(10), 0, at) + 1}: {text[at : at + 20]!r}")
        out.append(("end", ""))
        return out

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at]

    def take(self) -> tuple[str, str]:
        self.at += 1
        return self.tokens[self.at - 1]

    def want(self, value: str) -> None:
        kind, got = self.take()
        if got != value:
            raise ValueError(f"syntax error: {got!r} where {value!r} is due")

    def fresh(self) -> Node:
        self.count += 1
        return f"b{self.count}", "bnode", None, None

    def emit(self, s: Node, p: str, o: Node) -> None:
        self.out.append((self.graph, s, p, o))

    def resolve(self, token: str) -> str:
        value = unescape(token[1:-1])
        return urljoin(self.base, value) if self.base and not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", value) else value

    def named(self, token: str) -> str:
        prefix, _, local = token.partition(":")
        if prefix not in self.prefixes:
            raise ValueError(f"undeclared prefix {prefix!r}")
        return self.prefixes[prefix] + (re.sub(r"\\(.)", r"\1", local) if "\\" in local else local)

    def read(self) -> list[Quad]:
        while self.peek()[0] != "end":
            self.statement()
        return self.out

    def statement(self) -> None:
        kind, value = self.peek()
        low = value.lower()
        if kind == "lang" and low in ("@prefix", "@base") or kind == "word" and low in ("prefix", "base"):
            self.take()
            if low.endswith("prefix"):
                k, name = self.take()
                if k != "name" or not name.endswith(":"):
                    raise ValueError("syntax error: a prefix name is due")
                self.prefixes[name[:-1]] = self.resolve(self._iri())
            else:
                self.base = self.resolve(self._iri())
            if low.startswith("@"):
                self.want(".")
            return
        if self.graphs and (kind == "word" and low == "graph" or value == "{" or self.tokens[self.at + 1][1] == "{"):
            if kind == "word":
                self.take()
            self.graph = None if self.peek()[1] == "{" else self.node()[0]
            self.want("{")
            while self.peek()[1] != "}":
                self.triples()
                if self.peek()[1] == ".":
                    self.take()
                elif self.peek()[1] != "}":
                    raise ValueError("syntax error in a graph")
            self.take()
            self.graph = None
            return
        self.triples()
        self.want(".")

    def _iri(self) -> str:
        kind, value = self.take()
        if kind != "iri":
            raise ValueError("syntax error: an IRI is due")
        return value

    def triples(self) -> None:
        if self.peek()[1] == "[":
            s = self.node()
            if self.peek()[1] in (".", "}"):
                return
        else:
            s = self.node()
        if s[1] == "literal" and not self.n3:
            raise ValueError("a literal is no subject")
        self.properties(s)

    def properties(self, s: Node) -> None:
        while True:
            kind, value = self.peek()
            if self.n3 and value in ("=", "=>"):
                self.take()
                p = OWL + "sameAs" if value == "=" else "http://www.w3.org/2000/10/swap/log#implies"
            elif kind == "word" and value == "a":
                self.take()
                p = RDF + "type"
            else:
                p, k, _, _ = self.node()
                if k != "iri":
                    raise ValueError("a predicate is an IRI")
            while True:
                self.emit(s, p, self.node())
                if self.peek()[1] != ",":
                    break
                self.take()
            if self.peek()[1] != ";":
                return
            while self.peek()[1] == ";":
                self.take()
            if self.peek()[1] in (".", "]", "}"):
                return

    def node(self) -> Node:
        kind, value = self.take()
        if kind == "iri":
            return iri(self.resolve(value))
        if kind == "name":
            return iri(self.named(value))
        if kind == "bnode":
            return "n" + value[2:], "bnode", None, None
        if kind in ("str", "long"):
            text = unescape(value[3:-3] if kind == "long" else value[1:-1])
            k, v = self.peek()
            if k == "lang":
                self.take()
                return literal(text, lang=v[1:])
            if v == "^^":
                self.take()
                return literal(text, self.node()[0])
            return literal(text)
        if kind == "num":
            return literal(value, XSD + ("double" if "e" in value.lower() else "decimal" if "." in value else "integer"))
        if kind == "word" and value in ("true", "false"):
            return literal(value, XSD + "boolean")
        if value == "[":
            b = self.fresh()
            if self.peek()[1] != "]":
                self.properties(b)
            self.want("]")
            return b
        if value == "(":
            items = []
            while self.peek()[1] != ")":
                items.append(self.node())
            self.take()
            rest: Node = iri(RDF + "nil")
            cells = [self.fresh() for _ in items]
            for k in range(len(items)):
                self.emit(cells[k], RDF + "first", items[k])
                self.emit(cells[k], RDF + "rest", cells[k + 1] if k + 1 < len(cells) else rest)
            return cells[0] if cells else rest
        raise ValueError(f"syntax error at {value!r}")


def read(text: str, base: str = "", graphs: bool = False, n3: bool = False) -> Iterator[Quad]:
    yield from Reader(text, base, graphs, n3).read()
