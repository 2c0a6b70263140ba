"""SQL dumps in UTF-16: lines of VALUES ('a', 'b''c', ...); as rows of text.

spark.dataSource.register(LineSource) makes `format("lines")` available: line, source_file and row_number of text in any
encoding of fixed units. A file is cut into parts at whole units; a line belongs to the part in which it begins, and each
part reads on until its last line ends. Options: path (a file, a folder or a pattern), encoding, part_bytes.
"""

from __future__ import annotations

import codecs
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from reconspark.functions.text import strip
from reconspark.session import ship
from reconspark.sources.files import matching, opened, size

PART_BYTES, CHUNK_BYTES = 64 << 20, 1 << 20


def _layout(path: str, encoding: str) -> tuple[str, int, int]:
    """Encoding with its byte order, bytes of a unit, and where the text begins after a byte order mark."""
    name = codecs.lookup(encoding).name
    with opened(path) as f:
        mark = f.read(4)
    if name == "utf-16":
        return ("utf-16-be" if mark.startswith(codecs.BOM_UTF16_BE) else "utf-16-le"), 2, 2 if mark[:2] in (codecs.BOM_UTF16_BE, codecs.BOM_UTF16_LE) else 0
    return name, 2 if name.startswith("utf-16") else 1, 3 if name.startswith("utf-8") and mark.startswith(codecs.BOM_UTF8) else 0


def lines(path: str, encoding: str, start: int, end: int) -> Iterator[tuple[int, str]]:
    """(unit at which it begins, text without its end) of the lines that begin in the bytes from `start` to `end`."""
    name, unit, first = _layout(path, encoding)
    kind = {"utf-16-le": "<u2", "utf-16-be": ">u2"}.get(name, "u1")
    with opened(path) as f:
        # A part in the middle begins one unit early: what ends there or later began in the part before.
        at = max(start - unit, first)
        f.seek(at)
        inside, rest = at > first or start > first, b""
        while True:
            chunk = f.read(CHUNK_BYTES)
            data = rest + chunk
            ends = (np.flatnonzero(np.frombuffer(data, kind, len(data) // unit) == 10) + 1) * unit if data else ()
            begin = 0
            for stop in ends:
                if not inside:
                    if at >= end:
                        return
                    yield at // unit, data[begin : stop - unit].decode(name, "replace").removesuffix("\r")
                inside = False
                at, begin = at + int(stop) - begin, int(stop)
            rest = data[begin:]
            if not chunk:
                if rest and not inside and at < end:
                    yield at // unit, rest.decode(name, "replace").removesuffix("\r")
                return


@dataclass
class _Part(InputPartition):
    path: str
    start: int
    end: int


class _Lines(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.encoding = options["path"], options.get("encoding", "UTF-16")
        self.step = max(2, int(options.get("part_bytes", PART_BYTES)) // 2 * 2)

    def partitions(self) -> list[InputPartition]:
        return [_Part(p, at, min(at + self.step, n)) for p in matching(self.path) for n in (size(p),) for at in range(0, n, self.step)]

    def read(self, partition: _Part) -> Iterator[tuple]:
        name = posixpath.basename(partition.path)
        yield from ((line, name, at) for at, line in lines(partition.path, self.encoding, partition.start, partition.end))


class LineSource(DataSource):
    """See the module's text."""

    @classmethod
    def name(cls) -> str:
        return "lines"

    def schema(self) -> str:
        return "line string, source_file string, row_number bigint"

    def reader(self, schema: object) -> _Lines:
        return _Lines(dict(self.options))


def read_dump(spark: SparkSession, path: str, fields: list[str], encoding: str = "UTF-16", max_rows: int | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row for each VALUES line with exactly the given fields: fields, source_file, row_number.

    row_number is the unit of the file at which the line begins: it orders the rows of a file. Other lines and lines of
    another width are left out. Quotes are single and doubled inside; values are trimmed, null is the text NULL.
    """
    ship(spark)
    spark.dataSource.register(LineSource)
    found = spark.read.format("lines").options(path=path, encoding=encoding, part_bytes=str(part_bytes)).load()
    body = found.withColumn("line", strip("line")).where("line like 'VALUES (%'").withColumn("line", F.regexp_replace("line", r"^VALUES \(|\)[;,]?$", ""))
    item = r"\G(?:^|,)\s*(?:'((?:[^']|'')*)'|([^',]*))\s*(?=,|$)"
    values = F.zip_with(F.regexp_extract_all("line", F.lit(item), F.lit(1)), F.regexp_extract_all("line", F.lit(item), F.lit(2)), lambda a, b: F.trim(F.regexp_replace(F.concat(a, b), "''", "'")))
    rows = body.withColumn("v", values).where(F.size("v") == len(fields))
    out = rows.select(*[F.get("v", F.lit(i)).alias(n) for i, n in enumerate(fields)], "source_file", "row_number")
    return out.limit(max_rows) if max_rows else out
