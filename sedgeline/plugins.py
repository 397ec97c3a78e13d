"""Formats by name: how documents are read, checked and converted, and which files they are."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from .functions import types
from .operators import cdm, checks, dtdl, export, rdf
from .sources import cdm as cdm_source
from .sources import dtdl as dtdl_source
from .sources import rdf as rdf_source

VERSION = (1, 0, 0)
EVENTS = ("register", "unregister", "validate_start", "validate_complete", "convert_start", "convert_complete")


@dataclass
class Format:
    """One format. `parse` takes documents (file, text); `check` and `convert` take what `parse` gives. `rows` reads an iterator
    of documents to an iterator of rows of `schema`, which makes the format a data source of the engine (`datasource`)."""

    name: str
    extensions: tuple[str, ...]
    parse: Callable
    check: Callable | None = None
    convert: Callable | None = None
    export: Callable | None = None
    types: dict[str, str] = field(default_factory=dict)
    description: str = ""
    needs: tuple[str, ...] = ()
    min_version: tuple[int, ...] | None = None
    max_version: tuple[int, ...] | None = None
    setup: Callable[[], None] | None = None
    cleanup: Callable[[], None] | None = None
    rows: Callable | None = None
    schema: str = ""
    arguments: Callable | None = None

    def missing(self) -> list[str]:
        """Modules that it needs and that are not there."""
        return [m for m in self.needs if importlib.util.find_spec(m) is None]

    def fits(self, version: tuple[int, ...] = VERSION) -> bool:
        return not (self.min_version and version < self.min_version) and not (self.max_version and version > self.max_version)

    def info(self) -> dict[str, Any]:
        return {"name": self.name, "extensions": list(self.extensions), "description": self.description, "check": self.check is not None, "convert": self.convert is not None, "export": self.export is not None, "source": self.rows is not None}


class Formats:
    """The registered formats, their extensions, and callbacks of what happens to them."""

    def __init__(self) -> None:
        self.by_name: dict[str, Format] = {}
        self.by_extension: dict[str, str] = {}
        self.hooks: dict[str, list[Callable]] = {e: [] for e in EVENTS}
        self.types = types.Registry()

    def on(self, event: str, f: Callable) -> None:
        self.hooks[event].append(f)

    def off(self, event: str, f: Callable) -> None:
        self.hooks[event].remove(f)

    def tell(self, event: str, *args: Any) -> None:
        for f in list(self.hooks[event]):
            f(*args)

    def register(self, fmt: Format, *, overwrite: bool = False) -> None:
        if fmt.name in self.by_name and not overwrite:
            raise ValueError(f"{fmt.name} is registered")
        if not fmt.fits():
            raise ValueError(f"{fmt.name} does not fit version {VERSION}")
        if gone := fmt.missing():
            raise ImportError(f"{fmt.name} needs {', '.join(gone)}")
        if fmt.setup:
            fmt.setup()
        self.by_name[fmt.name] = fmt
        self.by_extension |= {e.lower(): fmt.name for e in fmt.extensions}
        for s, t in fmt.types.items():
            self.types.add(fmt.name, s, t)
        self.tell("register", fmt)

    def unregister(self, name: str) -> bool:
        fmt = self.by_name.pop(name, None)
        if fmt is None:
            return False
        self.by_extension = {e: n for e, n in self.by_extension.items() if n != name}
        if fmt.cleanup:
            fmt.cleanup()
        self.tell("unregister", fmt)
        return True

    def require(self, name: str) -> Format:
        if name not in self.by_name:
            raise KeyError(f"no format {name}; there are {', '.join(sorted(self.by_name))}")
        return self.by_name[name]

    def of_file(self, path: str) -> Format | None:
        """By the longest registered extension that the path ends in."""
        low = path.lower()
        fits = [e for e in self.by_extension if low.endswith(e)]
        return self.by_name[self.by_extension[max(fits, key=len)]] if fits else None

    def names(self) -> list[str]:
        return sorted(self.by_name)

    def extensions(self) -> list[str]:
        return sorted(self.by_extension)

    def info(self) -> list[dict]:
        return [self.by_name[n].info() for n in self.names()]

    def load_folder(self, folder: str) -> list[str]:
        """Registers what the `formats()` functions of a folder's Python files give; names of the new ones."""
        new = []
        for p in sorted(Path(folder).glob("*.py")):
            spec = importlib.util.spec_from_file_location(f"sedgeline_plugin_{p.stem}", p)
            module = importlib.util.module_from_spec(spec)
            spec.loader.exec_module(module)
            for fmt in module.formats() if hasattr(module, "formats") else ():
                self.register(fmt)
                new.append(fmt.name)
        return new

    def check(self, name: str, parsed: Any) -> Any:
        fmt = self.require(name)
        self.tell("validate_start", fmt)
        out = fmt.check(parsed)
        self.tell("validate_complete", fmt, out)
        return out

    def convert(self, name: str, parsed: Any, **how: Any) -> Any:
        fmt = self.require(name)
        self.tell("convert_start", fmt)
        out = fmt.convert(parsed, **how)
        self.tell("convert_complete", fmt, out)
        return out


def builtin() -> Iterable[Format]:
    yield Format("rdf", tuple(f".{e}" for e in rdf_source.EXTENSIONS), lambda docs, **kw: rdf_source.graph(rdf_source.documents_to_triples(docs, **kw)), checks.preflight, rdf.convert, export.triples_of, types._pairs(types.XSD_TYPES, types.XSD), "RDF graphs in eleven syntaxes")
    yield Format("dtdl", (".dtdl", ".dtdl.json", ".json"), dtdl_source.parse, dtdl.issues, dtdl.convert, None, types._pairs(types.DTDL_TYPES), "digital-twin models")
    yield Format("cdm", (".cdm.json", ".manifest.cdm.json", "model.json"), cdm_source.parse, cdm.issues, cdm.convert, None, types._pairs(types.CDM_PRIMITIVES), "business-data documents")


def default_formats() -> Formats:
    out = Formats()
    for fmt in builtin():
        out.register(fmt)
    return out


_shared: Formats | None = None


def shared_formats() -> Formats:
    """The one registry of this process, made when it is first asked for."""
    global _shared
    if _shared is None:
        _shared = default_formats()
    return _shared
