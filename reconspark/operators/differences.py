"""Differences between two copies of a table, field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differences(left: DataFrame, right: DataFrame, key: str, fields: tuple[str, ...], names: tuple[str, str], tolerance: str = "0.01") -> DataFrame:
    """Rows on one side only and values that differ: the key and `difference`.

    Both sides have `key` (already normalised; null keys are no rows) and decimal `fields`. The sides are tagged and
    united, one aggregation by key keeps one struct for each side (the greatest, so that repeated rows collapse the
    same way in any order), and one generated expression compares the structs' fields. `difference` is only_<left>,
    only_<right> or the field's name; a field differs by more than `tolerance` or if null on one side only. An
    aggregation holds two structs a key, so a hot key is combined before the shuffle and never gathered.
    Two empty tables give no rows.
    """

    def side(df: DataFrame, tag: int) -> DataFrame:
        whole = F.struct(*[F.col(f).cast("decimal(38,6)").alias(f) for f in fields])
        return df.select(F.col(key).alias("__k"), F.lit(tag).alias("__side"), whole.alias("__row")).where("__k is not null")

    both = side(left, 0).unionAll(side(right, 1))
    one = both.groupBy("__k").agg(F.max(F.when(F.col("__side") == 0, F.col("__row"))).alias("l"), F.max(F.when(F.col("__side") == 1, F.col("__row"))).alias("r"))

    def differs(f: str) -> Column:
        a, b = F.col(f"l.{f}"), F.col(f"r.{f}")
        return F.coalesce(F.abs(a - b) > F.lit(tolerance).cast("decimal(38,6)"), a.isNull() != b.isNull())

    compared = [F.when(differs(f), F.lit(f)) for f in fields]
    found = F.when(F.col("r").isNull(), F.array(F.lit(f"only_{names[0]}"))).when(F.col("l").isNull(), F.array(F.lit(f"only_{names[1]}"))).otherwise(F.array_compact(F.array(*compared)))
    return one.select(F.col("__k").alias(key), F.explode(found).alias("difference"))


def difference_summary(found: DataFrame) -> DataFrame:
    """How often each difference occurs."""
    return found.groupBy("difference").agg(F.count(F.lit(1)).alias("row_count"))

