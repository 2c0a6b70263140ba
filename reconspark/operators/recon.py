"""Two-sided reconciliation: one full outer join, presence flags and ordered outcome labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_sided(left: DataFrame, right: DataFrame, keys: list[str], fill: dict[str, object] | None = None) -> DataFrame:
    """Full outer join with in_left and in_right (never null), joined keys, and `fill` for columns of an absent side.

    One exchange a side, where a left join united with an anti join would need two. Null keys match nothing and
    come out on their own side, as in SQL. Column names other than the keys must differ.
    """
    a = left.withColumn("__l", F.lit(True))
    b = right.withColumn("__r", F.lit(True)).withColumnsRenamed({k: f"__k_{k}" for k in keys})
    on = reduce(lambda x, y: x & y, [a[k] == b[f"__k_{k}"] for k in keys])
    out = a.join(b, on, "full_outer")
    names = [c for c in [*left.columns, *right.columns[:]] if c not in keys]
    cols = [F.coalesce(k, f"__k_{k}").alias(k) for k in keys]
    fill = fill or {}
    for c in dict.fromkeys(names):
        absent = F.col("__l").isNull() if c in left.columns else F.col("__r").isNull()
        cols.append(F.when(absent, F.lit(fill[c])).otherwise(F.col(c)).alias(c) if c in fill else F.col(c))
    return out.select(*cols, F.coalesce("__l", F.lit(False)).alias("in_left"), F.coalesce("__r", F.lit(False)).alias("in_right"))


def classify(cases: list[tuple[Column, str]], default: str) -> Column:
    """The label of the first case that is true; a null comparison is not true and falls on, as in SQL."""
    label = F.when(cases[0][0], cases[0][1])
    return reduce(lambda w, c: w.when(c[0], c[1]), cases[1:], label).otherwise(default)


def within(a: Column | str, b: Column | str, tolerance: float) -> Column:
    """|a - b| <= tolerance; null if either is null."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.abs(a - b) <= F.lit(tolerance)


def exception_rank(ok: list[str], result: str = "result") -> Column:
    """2 for agreeing results, 1 for all others, null results included."""
    return F.when(F.col(result).isin(*ok), 2).otherwise(1)


def exception_first(df: DataFrame, ok: list[str], *keys: str, result: str = "result") -> DataFrame:
    """All rows, ordered with exceptions before agreeing results, then by result and keys."""
    return df.orderBy(exception_rank(ok, result), result, *keys)
