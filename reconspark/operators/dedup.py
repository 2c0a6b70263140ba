"""Conflict policies for repeated keys, and contiguous runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _one(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = pick(F.struct(F.struct(*order).alias("__o"), F.struct(*rest).alias("__r")))
    return df.groupBy(*keys).agg(best.alias("__b")).select(*keys, *[F.col(f"__b.__r.{c}").alias(c) for c in rest])


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest `order` of each key (first wins). Partial aggregation, no sort; null keys are a group."""
    return _one(df, keys, order, F.min)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest `order` of each key (last wins, replaced and not summed)."""
    return _one(df, keys, order, F.max)


def upsert_sum(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """One row a key with summed measures and row_count."""
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures], F.count(F.lit(1)).alias("row_count"))


def run_length(df: DataFrame, partition: list[str], order: list[str], key: str, aggs: dict[str, Column]) -> DataFrame:
    """Aggregates contiguous runs of `key` inside each partition's row order: partition, key, run_no and `aggs`.

    A key that comes back later starts a new run. Null is a key of its own. The window needs a partition column
    (a file); without one all rows would be one task.
    """
    w = W.partitionBy(*partition).orderBy(*order)
    started = F.when(F.lag(F.struct(key)).over(w).eqNullSafe(F.struct(key)), 0).otherwise(1)
    numbered = df.withColumn("__new", started).withColumn("run_no", F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(*partition, "run_no", key).agg(*[c.alias(n) for n, c in aggs.items()])


def last_run(runs: DataFrame, partition: list[str], key: str) -> DataFrame:
    """Of several runs of one key in a partition, the last one (what replaces the others on load)."""
    return keep_last(runs, [*partition, key], ["run_no"])


def prefer_filled(df: DataFrame, key: str, maxima: list[str], earliest: list[str], latest: list[str], source: str) -> DataFrame:
    """One record a key over several files: maxima, earliest and latest non-blank texts, file count and sorted file list."""
    aggs = [F.max(c).alias(c) for c in maxima]
    aggs += [F.min(F.nullif(c, F.lit(""))).alias(c) for c in earliest] + [F.max(F.nullif(c, F.lit(""))).alias(c) for c in latest]
    return df.groupBy(key).agg(*aggs, F.count(F.lit(1)).alias("file_occurrences"), F.array_join(F.array_sort(F.collect_list(source)), "|").alias("source_files"))
