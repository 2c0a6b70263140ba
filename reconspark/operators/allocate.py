"""Pro-rata allocation of an amount over the items of its group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pro_rata(shares: DataFrame, items: DataFrame, key: str, amount: str, quantity: str, spread: dict[str, str]) -> DataFrame:
    """Each row of `shares` with each of its items: abs_amount_total, abs_qty_total, item_groups, alloc_rate and, for each
    `spread` item, rate times amount.

    Rows and items meet on `key`; null keys meet nothing. The weight of an item is its |amount| within the key, else its
    |quantity|, else an even split. The totals are aggregated from the items before these meet the shares, so that all
    exchanges are on one key, sums combine before the shuffle and the joined rows are never aggregated.
    """
    totals = items.groupBy(key).agg(F.sum(F.abs(amount)).alias("abs_amount_total"), F.sum(F.abs(quantity)).alias("abs_qty_total"), F.count(F.lit(1)).alias("item_groups"))
    rate = (
        F.when(F.col("abs_amount_total") > 0, F.abs(amount).cast("double") / F.col("abs_amount_total"))
        .when(F.col("abs_qty_total") > 0, F.abs(quantity).cast("double") / F.col("abs_qty_total"))
        .otherwise(F.lit(1.0) / F.col("item_groups"))
    )
    weighted = items.join(totals, key).withColumn("alloc_rate", rate)
    return shares.join(weighted, key).select("*", *[(F.col(a) * F.col("alloc_rate")).alias(n) for n, a in spread.items()])
