"""Columns added to frames in ways that the optimiser keeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame, **exprs: Column) -> DataFrame:
    """Adds columns through a generator, which keeps the optimiser from repeating their expressions in later ones."""
    made = F.array(F.struct(*[e.alias(n) for n, e in exprs.items()]))
    return df.select("*", F.inline(made))
