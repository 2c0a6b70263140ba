"""Workbooks as a streaming source: first sheet, chosen columns, one partition a file, all values text.

spark.dataSource.register(XlsxSource) makes `format("xlsx")` available. Options:
path (a file, a folder or a glob), columns (names separated by |; without it those of the first file), positions
(numbers separated by |, used instead of headers), max_rows (per file), exclude (text that a file name must not hold).
Every table also has source_file and row_number. Missing headers give null; a header repeated in a file is named again
as name#2. The files are read element by element, in bounded memory; from the place where a sheet is no XML, each
row that can still be told apart and mended is read by itself, and rows beyond mending are left out.
"""

from __future__ import annotations

import posixpath
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from xml.etree import ElementTree as ET

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from reconspark.sources.files import matching, opened


#: Characters that no XML may hold, and an ampersand that begins no reference.
_FAULTS = re.compile("[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]|&(?!#?\\w+;)")
_ROW = re.compile(r"<(?:\w+:)?row\b[^>]*?(?:/>|>.*?</(?:\w+:)?row\s*>)", re.S)
_PREFIX = re.compile(r"(?<=[<\s/])[A-Za-z]\w*:(?=\w+[\s=/>])")


def column_number(reference: str | None) -> int:
    """1 for A1, 27 for AA3; 0 without letters."""
    letters = re.match("[A-Z]*", reference or "")[0]
    return reduce(lambda n, c: 26 * n + int(c, 36) - 9, letters, 0)


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _first_sheet(book: zipfile.ZipFile) -> str:
    """The part of the first sheet: its relation's target, absolute or seen from xl/ or from the root."""
    sheets = [e.attrib for e in ET.fromstring(book.read("xl/workbook.xml")).iter() if _local(e.tag) == "sheet"]
    if not sheets:
        raise ValueError("the workbook has no sheet")
    ids = {_local(k): v for k, v in sheets[0].items()}
    targets = {e.get("Id"): e.get("Target") for e in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    parts = set(book.namelist())
    places = [posixpath.normpath(posixpath.join(base, targets[ids["id"]])).lstrip("/") for base in ("/xl", "/")]
    return next((p for p in places if p in parts), places[0])


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    found = []
    with book.open("xl/sharedStrings.xml") as f:
        for _, e in ET.iterparse(f):
            if _local(e.tag) == "si":
                found.append("".join(t.text or "" for t in e.iter() if _local(t.tag) == "t"))
                e.clear()
    return found


def _text(cell: ET.Element, shared: list[str]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        return "".join(cell.itertext())
    value = next((e.text for e in cell if _local(e.tag) == "v"), None)
    if kind == "s" and value is not None and value.isdigit() and int(value) < len(shared):
        return shared[int(value)]
    return value


def _cells(row: ET.Element, shared: list[str]) -> dict[int, str | None]:
    cells, at = {}, 0
    for c in row:
        if _local(c.tag) == "c":
            at = column_number(c.get("r")) or at + 1
            cells[at] = _text(c, shared)
    return cells


def _sound_rows(f, shared: list[str]) -> Iterator[tuple[int, dict[int, str | None]]]:
    number, sheet = 0, None
    for event, e in ET.iterparse(f, events=("start", "end")):
        if event == "start":
            sheet = e if _local(e.tag) == "sheetData" else sheet
            continue
        if _local(e.tag) == "row":
            number = int(e.get("r") or number + 1)
            cells = _cells(e, shared)
            sheet.clear()  # drops the finished row, so memory does not grow with the sheet
            yield number, cells


def _mended_rows(f, shared: list[str]) -> Iterator[tuple[int, dict[int, str | None]]]:
    """Rows found by their tags, each read by itself."""
    number, rest = 0, ""
    while chunk := f.read(1 << 20):
        rest += chunk.decode("utf-8", "replace")
        end = 0
        for m in _ROW.finditer(rest):
            end = m.end()
            bare = re.sub("<[^>]*>", lambda t: _PREFIX.sub("", t[0]), m[0])
            try:
                row = ET.fromstring(_FAULTS.sub(lambda x: "&amp;" if x[0] == "&" else "", bare))
            except ET.ParseError:
                continue
            number = int(row.get("r") or number + 1)
            yield number, _cells(row, shared)
        rest = rest[end:]


def sheet_rows(path: str) -> Iterator[tuple[int, dict[int, str | None]]]:
    """(row number, column number -> text) of the first sheet; position counts where the file states no number."""
    with opened(path) as file, zipfile.ZipFile(file) as book:
        shared, place, last = _shared_strings(book), _first_sheet(book), 0
        try:
            with book.open(place) as f:
                for number, cells in _sound_rows(f, shared):
                    last = number
                    yield number, cells
        except ET.ParseError:
            with book.open(place) as f:
                yield from ((number, cells) for number, cells in _mended_rows(f, shared) if number > last)


def header(path: str) -> list[str]:
    """The first row as a dense list, blanks as empty texts, repeated names numbered from #2."""
    for _, cells in sheet_rows(path):
        names, seen = [], {}
        for k in range(1, max(cells, default=0) + 1):
            name = cells.get(k) or ""
            seen[name] = seen.get(name, 0) + 1
            names.append(name if not name or seen[name] == 1 else f"{name}#{seen[name]}")
        return names
    return []


def files_of(path: str, exclude: str = "") -> list[str]:
    """Workbooks of a file, folder or pattern in name order; the suffix may be in any case."""
    names = [(f, posixpath.basename(f)) for f in matching(path)]
    return [f for f, n in names if "xlsx" in n.lower() and not n.startswith("~") and not (exclude and exclude in n)]


@dataclass
class _File(InputPartition):
    path: str


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], names: list[str], positions: list[int]):
        self.options, self.names, self.positions = options, names, positions

    def partitions(self) -> list[InputPartition]:
        return [_File(f) for f in files_of(self.options["path"], self.options.get("exclude", ""))]

    def read(self, partition: _File) -> Iterator[tuple]:
        at, rows, most = list(self.positions), 0, int(self.options.get("max_rows") or 0)
        if not at:
            there = header(partition.path)
            at = [there.index(n) + 1 if n in there else 0 for n in self.names]
        name = posixpath.basename(partition.path)
        for number, cells in sheet_rows(partition.path):
            if number == 1:
                continue
            rows += 1
            yield (*[cells.get(k) for k in at], name, number)
            if most and rows >= most:
                return


class XlsxSource(DataSource):
    """See the module's text."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _names(self) -> list[str]:
        if self.options.get("positions"):
            return [f"c{p}" for p in self.options["positions"].split("|")]
        if self.options.get("columns"):
            return self.options["columns"].split("|")
        files = files_of(self.options["path"], self.options.get("exclude", ""))
        return [n for n in header(files[0]) if n] if files else []

    def schema(self) -> StructType:
        return StructType([*[StructField(n, StringType()) for n in self._names()], StructField("source_file", StringType()), StructField("row_number", LongType())])

    def reader(self, schema: StructType) -> _Reader:
        positions = [int(p) for p in self.options.get("positions", "").split("|") if p]
        return _Reader(dict(self.options), [f.name for f in schema.fields[:-2]], positions)
