"""RDF in XML, JSON and HTML as quads: RDF/XML, TriX, JSON-LD (a subset), HexTuples, RDFa and microdata."""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

from .turtle import RDF, XSD, Node, Quad, iri, literal

XML = "{http://www.w3.org/XML/1998/namespace}"
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def _bnode(name: str) -> Node:
    return name, "bnode", None, None


def _safe_xml(text: str) -> ET.Element:
    if "<!ENTITY" in text and re.search(r"<!ENTITY\s+\S+\s+(?:SYSTEM|PUBLIC)", text):
        raise ValueError("external entities are not read")
    return ET.fromstring(text)


class _RdfXml:
    def __init__(self, base: str):
        self.base, self.count, self.out, self.items = base, 0, [], {}

    def fresh(self) -> Node:
        self.count += 1
        return _bnode(f"b{self.count}")

    @staticmethod
    def name(tag: str) -> str:
        return tag[1:].replace("}", "") if tag[0] == "{" else tag

    def emit(self, s: Node, p: str, o: Node) -> None:
        self.out.append((None, s, p, o))

    def subject(self, e: ET.Element, base: str) -> Node:
        a = e.attrib
        if f"{{{RDF}}}about" in a:
            return iri(urljoin(base, a[f"{{{RDF}}}about"]) if base else a[f"{{{RDF}}}about"])
        if f"{{{RDF}}}ID" in a:
            return iri(f"{base}#{a[f'{{{RDF}}}ID']}")
        if f"{{{RDF}}}nodeID" in a:
            return _bnode("n" + a[f"{{{RDF}}}nodeID"])
        return self.fresh()

    def node(self, e: ET.Element, base: str, lang: str | None) -> Node:
        base, lang = e.attrib.get(XML + "base", base), e.attrib.get(XML + "lang", lang) or None
        s = self.subject(e, base)
        if self.name(e.tag) != RDF + "Description":
            self.emit(s, RDF + "type", iri(self.name(e.tag)))
        for k, v in e.attrib.items():
            p = self.name(k)
            if k.startswith(XML) or p in (RDF + "about", RDF + "ID", RDF + "nodeID"):
                continue
            self.emit(s, p, iri(v) if p == RDF + "type" else literal(v, lang=lang))
        item = 0
        for child in e:
            item = self.property(s, child, base, lang, item)
        return s

    def property(self, s: Node, e: ET.Element, base: str, lang: str | None, item: int) -> int:
        base, lang = e.attrib.get(XML + "base", base), e.attrib.get(XML + "lang", lang) or None
        p = self.name(e.tag)
        if p == RDF + "li":
            item += 1
            p = f"{RDF}_{item}"
        a = {self.name(k): v for k, v in e.attrib.items() if not k.startswith(XML)}
        kind = a.get(RDF + "parseType")
        if kind == "Resource":
            o = self.fresh()
            self.emit(s, p, o)
            n = 0
            for child in e:
                n = self.property(o, child, base, lang, n)
        elif kind == "Collection":
            members = [self.node(c, base, lang) for c in e]
            cells = [self.fresh() for _ in members]
            self.emit(s, p, cells[0] if cells else iri(RDF + "nil"))
            for k, m in enumerate(members):
                self.emit(cells[k], RDF + "first", m)
                self.emit(cells[k], RDF + "rest", cells[k + 1] if k + 1 < len(cells) else iri(RDF + "nil"))
        elif kind is not None:
            self.emit(s, p, literal((e.text or "") + "".join(ET.tostring(c, "unicode") for c in e), RDF + "XMLLiteral"))
        elif RDF + "resource" in a:
            self.emit(s, p, iri(urljoin(base, a[RDF + "resource"]) if base else a[RDF + "resource"]))
        elif RDF + "nodeID" in a:
            self.emit(s, p, _bnode("n" + a[RDF + "nodeID"]))
        elif len(e):
            self.emit(s, p, self.node(e[0], base, lang))
        elif more := {k: v for k, v in a.items() if k not in (RDF + "datatype", RDF + "ID")}:
            o = self.fresh()
            self.emit(s, p, o)
            for k, v in more.items():
                self.emit(o, k, literal(v, lang=lang))
        else:
            self.emit(s, p, literal(e.text or "", a.get(RDF + "datatype"), None if RDF + "datatype" in a else lang))
        return item


def read_xml(text: str, base: str = "") -> Iterator[Quad]:
    root = _safe_xml(text)
    r = _RdfXml(root.attrib.get(XML + "base", base))
    lang = root.attrib.get(XML + "lang")
    for e in root if r.name(root.tag) == RDF + "RDF" else [root]:
        r.node(e, r.base, lang)
    yield from r.out


def read_trix(text: str) -> Iterator[Quad]:
    tail = lambda e: e.tag.rsplit("}", 1)[-1]

    def node(e: ET.Element) -> Node:
        value = e.text or ""
        if tail(e) == "uri":
            return iri(value.strip())
        if tail(e) == "id":
            return _bnode("n" + value.strip())
        return literal(value, e.attrib.get("datatype"), e.attrib.get(XML + "lang"))

    for g in _safe_xml(text):
        name = next((e.text.strip() for e in g if tail(e) in ("uri", "id")), None)
        for t in g:
            if tail(t) == "triple":
                s, p, o = map(node, t)
                yield name, s, p[0], o


def read_hext(text: str) -> Iterator[Quad]:
    for line in text.splitlines():
        if line.strip():
            s, p, value, kind, lang, graph = json.loads(line)
            node = lambda x: _bnode("n" + x[2:]) if x.startswith("_:") else iri(x)
            o = iri(value) if kind == "globalId" else _bnode("n" + value.removeprefix("_:")) if kind == "localId" else literal(value, None if lang else kind, lang or None)
            yield graph or None, node(s), p, o


class _JsonLd:
    """Contexts with prefixes, @vocab, @base, term definitions with @id, @type, @container @list; inline only."""

    def __init__(self, base: str):
        self.base, self.count, self.out = base, 0, []

    def fresh(self) -> Node:
        self.count += 1
        return _bnode(f"b{self.count}")

    def context(self, given, ctx: dict) -> dict:
        ctx = dict(ctx)
        for part in given if isinstance(given, list) else [given]:
            if isinstance(part, dict):
                ctx |= part
        return ctx

    def expand(self, name: str, ctx: dict, vocab: bool = True) -> str | None:
        seen = set()
        while isinstance(name, str) and name not in seen:
            seen.add(name)
            term = ctx.get(name)
            if term is not None and vocab and not name.startswith("@"):
                name = term.get("@id", name) if isinstance(term, dict) else term
                continue
            if ":" in name and not name.startswith("_:"):
                prefix, _, local = name.partition(":")
                base = ctx.get(prefix)
                base = base.get("@id") if isinstance(base, dict) else base
                if isinstance(base, str) and not local.startswith("//"):
                    name = (self.expand(base, ctx) or base) + local
                return name
            break
        if not isinstance(name, str):
            return None
        if name.startswith(("@", "_:")):
            return name
        if vocab:
            return ctx["@vocab"] + name if isinstance(ctx.get("@vocab"), str) else None
        base = ctx.get("@base", self.base) or ""
        return urljoin(base, name) if base else name

    def ref(self, name: str, ctx: dict, vocab: bool = False) -> Node:
        full = self.expand(name, ctx, vocab) or self.expand(name, ctx, False)
        return _bnode("n" + full[2:]) if full.startswith("_:") else iri(full)

    def value(self, v, term: dict, ctx: dict, graph) -> Node | None:
        if isinstance(v, dict):
            if "@value" in v:
                return self.scalar(v["@value"], self.expand(v["@type"], ctx) if v.get("@type") else None, v.get("@language"))
            if "@list" in v:
                return self.list_of(v["@list"], term, ctx, graph)
            return self.node(v, ctx, graph)
        kind = term.get("@type")
        if kind in ("@id", "@vocab") and isinstance(v, str):
            return self.ref(v, ctx, kind == "@vocab")
        return self.scalar(v, self.expand(kind, ctx) if kind else None, term.get("@language", ctx.get("@language")))

    def scalar(self, v, datatype, lang) -> Node | None:
        if v is None:
            return None
        if isinstance(v, bool):
            return literal(str(v).lower(), datatype or XSD + "boolean")
        if isinstance(v, int):
            return literal(str(v), datatype or XSD + "integer")
        if isinstance(v, float):
            return literal(repr(v), datatype or XSD + "double")
        return literal(str(v), datatype, None if datatype else lang)

    def list_of(self, items, term, ctx, graph) -> Node:
        nodes = [n for n in (self.value(x, term, ctx, graph) for x in (items if isinstance(items, list) else [items])) if n]
        cells = [self.fresh() for _ in nodes]
        for k, n in enumerate(nodes):
            self.out.append((graph, cells[k], RDF + "first", n))
            self.out.append((graph, cells[k], RDF + "rest", cells[k + 1] if k + 1 < len(cells) else iri(RDF + "nil")))
        return cells[0] if cells else iri(RDF + "nil")

    def node(self, obj: dict, ctx: dict, graph) -> Node:
        if "@context" in obj:
            ctx = self.context(obj["@context"], ctx)
        alias = {k: self.expand(k, ctx) for k in obj}
        key = next((k for k, x in alias.items() if x == "@id"), None)
        s = self.ref(obj[key], ctx) if key else self.fresh()
        for k, v in obj.items():
            p = alias[k]
            if k == "@context" or p in (None, "@id", "@index"):
                continue
            if p == "@graph":
                for x in v if isinstance(v, list) else [v]:
                    self.node(x, ctx, s[0] if len(obj) > 2 and key else graph)
                continue
            if p == "@type":
                for x in v if isinstance(v, list) else [v]:
                    self.out.append((graph, s, RDF + "type", self.ref(x, ctx, True)))
                continue
            if p.startswith("@") or ":" not in p:
                continue
            term = ctx.get(k) if isinstance(ctx.get(k), dict) else {}
            if term.get("@container") == "@list":
                self.out.append((graph, s, p, self.list_of(v, term, ctx, graph)))
                continue
            if term.get("@container") == "@language" and isinstance(v, dict):
                v = [{"@value": y, "@language": lang} for lang, x in v.items() for y in (x if isinstance(x, list) else [x])]
            for x in v if isinstance(v, list) else [v]:
                if (o := self.value(x, term, ctx, graph)) is not None:
                    self.out.append((graph, s, p, o))
        return s


def read_jsonld(text: str, base: str = "") -> Iterator[Quad]:
    data = json.loads(text)
    r = _JsonLd(base)
    for obj in data if isinstance(data, list) else [data]:
        if set(obj) <= {"@context", "@graph"} and "@graph" in obj:
            ctx = r.context(obj.get("@context", {}), {})
            for x in obj["@graph"] if isinstance(obj["@graph"], list) else [obj["@graph"]]:
                r.node(x, ctx, None)
        else:
            r.node(obj, {}, None)
    yield from r.out


class _Html(HTMLParser):
    """RDFa Lite (vocab, prefix, typeof, property, resource, about, rel, content, datatype) or microdata."""

    def __init__(self, base: str, micro: bool):
        super().__init__(convert_charrefs=True)
        self.base, self.micro, self.count, self.out = base, micro, 0, []
        self.stack: list[dict] = [{"tag": "", "subject": iri(base) if base else None, "vocab": "", "prefixes": {"schema": "http://schema.org/", "foaf": "http://xmlns.com/foaf/0.1/", "dc": "http://purl.org/dc/terms/", "owl": "http://www.w3.org/2002/07/owl#", "rdfs": "http://www.w3.org/2000/01/rdf-schema#", "rdf": RDF, "xsd": XSD}, "text": None, "type": ""}]

    def fresh(self) -> Node:
        self.count += 1
        return _bnode(f"b{self.count}")

    def term(self, name: str, top: dict) -> str | None:
        if re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", name):
            return name
        if ":" in name:
            p, _, local = name.partition(":")
            return top["prefixes"][p] + local if p in top["prefixes"] else name
        if self.micro:
            return re.sub(r"[^/#]*$", "", top["type"]) + name if top["type"] else None
        return top["vocab"] + name if top["vocab"] else None

    def link(self, a: dict) -> str | None:
        return next((a[k] for k in ("resource", "href", "src", "data") if a.get(k) is not None), None)

    def handle_starttag(self, tag, attrs) -> None:
        a = {k: v or "" for k, v in attrs}
        top = self.stack[-1]
        now = {"tag": tag, "subject": top["subject"], "vocab": a.get("vocab", top["vocab"]), "prefixes": top["prefixes"], "text": None, "type": top["type"]}
        if "prefix" in a:
            pairs = a["prefix"].split()
            now["prefixes"] = top["prefixes"] | {p.rstrip(":"): u for p, u in zip(pairs[::2], pairs[1::2], strict=False)}
        if self.micro:
            self.item(a, top, now)
        else:
            self.rdfa(a, top, now)
        if tag not in VOID:
            self.stack.append(now)

    def item(self, a: dict, top: dict, now: dict) -> None:
        s = top["subject"]
        if "itemscope" in a:
            o = iri(urljoin(self.base, a["itemid"])) if a.get("itemid") else self.fresh()
            types = a.get("itemtype", "").split()
            for t in types:
                self.out.append((None, o, RDF + "type", iri(t)))
            for name in a.get("itemprop", "").split():
                if s and (p := self.term(name, top)):
                    self.out.append((None, s, p, o))
            now["subject"], now["type"] = o, types[0] if types else top["type"]
        elif a.get("itemprop") and s:
            ps = [p for p in (self.term(x, top) for x in a["itemprop"].split()) if p]
            self.values(ps, s, a, now)

    def rdfa(self, a: dict, top: dict, now: dict) -> None:
        s = iri(urljoin(self.base, a["about"])) if "about" in a else top["subject"]
        ps = [p for p in (self.term(x, now) for x in a.get("property", "").split()) if p]
        rels = [p for p in (self.term(x, now) for x in (a.get("rel", "")).split()) if p]
        link = self.link(a)
        if "typeof" in a:
            o = iri(urljoin(self.base, link)) if link is not None else s if "about" in a else self.fresh()
            for t in a["typeof"].split():
                if full := self.term(t, now):
                    self.out.append((None, o, RDF + "type", iri(full)))
            for p in ps + rels:
                if s:
                    self.out.append((None, s, p, o))
            now["subject"] = o
            return
        now["subject"] = s
        if rels and link is not None and s:
            for p in rels:
                self.out.append((None, s, p, iri(urljoin(self.base, link))))
        if ps and s:
            self.values(ps, s, a, now)
        elif "resource" in a and not rels:
            now["subject"] = iri(urljoin(self.base, a["resource"]))

    def values(self, ps: list[str], s: Node, a: dict, now: dict) -> None:
        kind = self.term(a["datatype"], now) if a.get("datatype") else None
        link = self.link(a)
        fixed = literal(a["content"], kind) if "content" in a else iri(urljoin(self.base, link)) if link is not None else literal(a["datetime"], kind) if "datetime" in a else None
        if fixed:
            self.out += [(None, s, p, fixed) for p in ps]
        else:
            now["text"] = (ps, s, kind, [])

    def handle_data(self, data) -> None:
        for x in self.stack:
            if x["text"]:
                x["text"][3].append(data)

    def handle_endtag(self, tag) -> None:
        if tag in VOID or not any(x["tag"] == tag for x in self.stack[1:]):
            return
        while True:
            x = self.stack.pop()
            if x["text"]:
                ps, s, kind, parts = x["text"]
                self.out += [(None, s, p, literal("".join(parts).strip(), kind)) for p in ps]
            if x["tag"] == tag:
                return


def read_html(text: str, base: str = "", micro: bool = False) -> Iterator[Quad]:
    r = _Html(base, micro)
    r.feed(text)
    r.close()
    for x in list(r.stack[1:]):
        if x["text"]:
            r.handle_endtag(x["tag"])
    yield from r.out
