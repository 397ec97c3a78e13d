"""Plug-in formats as data sources of the engine: `spark.read.format(name)` and `spark.readStream.format(name)`.

A format that can be read this way has `rows`, a function from an iterator of documents (file, text) to an iterator of rows,
and the schema of these rows. It can come from another package, which names a function that gives its formats under the entry
point group `sedgeline.formats`. Files are listed once, where the query is planned, and read in the tasks, a group of files
each, by the file systems that Arrow knows (local and shared folders, HDFS, object stores). As a stream a folder is read
in the order in which its files came; at most `maxFilesPerTrigger` make a micro-batch.
"""

from __future__ import annotations

import fnmatch
import json
import sys
from collections.abc import Iterator
from importlib.metadata import entry_points

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .plugins import Format, Formats

GROUP = "sedgeline.formats"
FILES = 100


def _files(path: str, extensions: tuple[str, ...]) -> list[tuple[int, str]]:
    """(time in ns, path) of the files of a folder, or of one file, that have one of the extensions, the oldest first."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    one = system.get_file_info(root)
    if one.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [one] if one.type == fs.FileType.File else [x for x in system.get_file_info(fs.FileSelector(root, recursive=True)) if x.type == fs.FileType.File]
    wanted = [x for x in found if not x.base_name.startswith(("_", ".")) and any(fnmatch.fnmatch(x.base_name.lower(), f"*{e.lower()}") for e in extensions)]
    return sorted((x.mtime_ns or 0, x.path) for x in wanted)


def _read(path: str, files: list[str]) -> Iterator[tuple[str, str]]:
    from pyarrow import fs

    system = fs.FileSystem.from_uri(path)[0] if "://" in path else fs.LocalFileSystem()
    for f in files:
        with system.open_input_stream(f) as s:
            raw = s.read()
        try:
            yield f, raw.decode()
        except UnicodeDecodeError:
            yield f, raw.decode("latin-1")


class _Group(InputPartition):
    def __init__(self, files: list[str]):
        super().__init__(0)
        self.files = files


class _Reader(DataSourceReader):
    def __init__(self, fmt: Format, path: str, files: int):
        self.fmt, self.path, self.files = fmt, path, files

    def partitions(self) -> list[_Group]:
        all_ = [f for _, f in _files(self.path, self.fmt.extensions)]
        return [_Group(all_[k : k + self.files]) for k in range(0, len(all_), self.files)] or [_Group([])]

    def read(self, partition: _Group) -> Iterator[tuple]:
        yield from self.fmt.rows(_read(self.path, partition.files))


class _StreamReader(DataSourceStreamReader):
    """Offsets are the time and path of the last file taken."""

    def __init__(self, fmt: Format, path: str, files: int, most: int):
        self.fmt, self.path, self.files, self.most = fmt, path, files, most
        self.last: tuple[int, str] = (-1, "")

    def initialOffset(self) -> dict:
        return {"time": -1, "file": ""}

    def _after(self, at: tuple[int, str]) -> list[tuple[int, str]]:
        return [x for x in _files(self.path, self.fmt.extensions) if x > at]

    def latestOffset(self) -> dict:
        new = self._after(self.last)[: self.most]
        self.last = new[-1] if new else self.last
        return {"time": self.last[0], "file": self.last[1]}

    def partitions(self, start: dict, end: dict) -> list[_Group]:
        upto = (end["time"], end["file"])
        # After a restart the engine goes on from the offsets that it has kept.
        self.last = max(self.last, upto)
        files = [f for t, f in self._after((start["time"], start["file"])) if (t, f) <= upto]
        return [_Group(files[k : k + self.files]) for k in range(0, len(files), self.files)] or [_Group([])]

    def read(self, partition: _Group) -> Iterator[tuple]:
        yield from self.fmt.rows(_read(self.path, partition.files))


def source_of(fmt: Format) -> type[DataSource]:
    """The data source of a format. Options: path; files (a task's), maxFilesPerTrigger."""
    if fmt.rows is None or not fmt.schema:
        raise ValueError(f"{fmt.name} has no rows or no schema to be read by")

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return fmt.name

        def schema(self) -> str:
            return fmt.schema

        def _of(self, option: str, default: int) -> int:
            n = int(self.options.get(option, default))
            if n < 1:
                raise ValueError(f"{option} is at least 1")
            return n

        def reader(self, schema) -> _Reader:
            return _Reader(fmt, self.options["path"], self._of("files", FILES))

        def streamReader(self, schema) -> _StreamReader:
            return _StreamReader(fmt, self.options["path"], self._of("files", FILES), self._of("maxFilesPerTrigger", FILES))

    return Source


def register_sources(spark: SparkSession, formats: Formats) -> list[str]:
    """Registers all formats that can be read by rows with the session; their names."""
    able = [formats.by_name[n] for n in formats.names() if formats.by_name[n].rows is not None]
    for fmt in able:
        spark.dataSource.register(source_of(fmt))
    return [fmt.name for fmt in able]


def load_entry_points(formats: Formats, *, group: str = GROUP) -> tuple[list[str], dict[str, str]]:
    """Registers what installed packages offer under the entry point group, by the entry points' names; names of the new formats, and
    what went wrong with an entry point, which keeps none of the others out."""
    new, wrong = [], {}
    for point in sorted(entry_points(group=group), key=lambda p: p.name):
        try:
            made = point.load()
            # The package travels with the query, so that tasks need not have it installed.
            cloudpickle.register_pickle_by_value(sys.modules[point.module.partition(".")[0]])
            for fmt in made():
                formats.register(fmt)
                new.append(fmt.name)
        except Exception as e:  # another package's fault
            wrong[point.name] = f"{type(e).__name__}: {e}"
    return new, wrong


def json_lines(documents: Iterator[tuple[str, str]]) -> Iterator[tuple[str, int, str]]:
    """Rows of documents with a JSON value on each line: (file, line, text). An example of `rows`."""
    for file, text in documents:
        for k, line in enumerate(text.splitlines()):
            if line.strip():
                yield file, k, json.dumps(json.loads(line), sort_keys=True)
