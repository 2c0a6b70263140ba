"""Sinks: ordered CSV with byte order mark, bounded JSON samples, summaries, a manifest, stages that run once."""

from __future__ import annotations

import csv
import hashlib
import json
import os
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str) -> int:
    """The rows in their order as one UTF-8 CSV with byte order mark and header; returns how many.

    Partitions come to the driver one after another, so its memory holds one at a time. For extracts that people open;
    large details are written distributed by write_parts.
    """
    n = 0
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(df.columns)
        for n, row in enumerate(df.toLocalIterator(prefetchPartitions=False), 1):
            out.writerow(row)
    return n


def write_parts(df: DataFrame, path: str, form: str = "parquet") -> None:
    """The rows as a folder of part files, written by the executors."""
    df.write.mode("overwrite").option("header", True).format(form).save(path)


def write_sample(df: DataFrame, path: str, limit: int) -> int:
    """{headers, rows, included_rows, limit} of the first rows; the limit is the feature: a report's embedded sample."""
    rows = [list(r) for r in df.limit(limit).collect()]
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"headers": df.columns, "rows": rows, "included_rows": len(rows), "limit": limit}, f, ensure_ascii=False, default=str)
    return len(rows)


def write_summary(parts: dict[str, DataFrame], path: str) -> dict:
    """Small result tables as one JSON document, each a list of records."""
    found = {k: [r.asDict(recursive=True) for r in df.collect()] for k, df in parts.items()}
    with open(path, "w", encoding="utf-8") as f:
        json.dump(found, f, ensure_ascii=False, default=str, indent=1)
    return found


def manifest(spark: SparkSession, written: dict[str, tuple[str, int, int]]) -> DataFrame:
    """detail, path, row_count, embedded_rows of what was written."""
    return spark.createDataFrame([(k, *v) for k, v in written.items()], "detail string, path string, row_count long, embedded_rows long")


def stage_key(name: str, **made_from: object) -> str:
    """A stage's folder name: its own name and a digest of inputs and parameters, so that others make a stage of their own."""
    said = json.dumps(made_from, sort_keys=True, default=str, ensure_ascii=False)
    return f"{name}-{hashlib.sha256(said.encode()).hexdigest()[:16]}"


def stage(spark: SparkSession, folder: str, name: str, make: Callable[[], DataFrame], rebuild: bool = False, **made_from: object) -> DataFrame:
    """Runs a stage once for each set of inputs and parameters (`made_from`): its Parquet is read again if complete, else
    made and written.
    """
    place = f"{folder}/{stage_key(name, **made_from)}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
    if rebuild or not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        make().write.mode("overwrite").parquet(place)
    return spark.read.parquet(place)


def read_summary(path: str) -> dict[str, list[dict]]:
    """The records of a summary document again, as reports are made from them."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def read_sample(spark: SparkSession, path: str) -> DataFrame:
    """A sample document as a frame of texts; null stays null."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    rows = [tuple(None if v is None else str(v) for v in r) for r in found["rows"]]
    return spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in found["headers"]))


def faults(parts: dict[str, DataFrame]) -> Iterator[tuple[str, str]]:
    """(table, column) of report numbers that are NaN or infinite."""
    from pyspark.sql import functions as F

    for name, df in parts.items():
        numbers = [c for c, t in df.dtypes if t in ("double", "float")]
        if numbers:
            bad = df.agg(*[F.count_if(F.isnan(c) | (F.abs(c) == float("inf"))).alias(c) for c in numbers]).first()
            yield from ((name, c) for c in numbers if bad[c])


def ensure(path: str) -> str:
    """The folder, made if it is not there."""
    os.makedirs(path, exist_ok=True)
    return path
