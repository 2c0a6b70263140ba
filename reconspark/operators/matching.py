"""Similarity of names and vectors, best match per key, and votes by shared records."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


@pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks of two texts, 0 if either is null or empty. For distinct names only: it is quadratic in length."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)])


def cosine(vectors: DataFrame, left: str, right: str, dims: list[str], value: str, other: DataFrame) -> DataFrame:
    """Cosine of every left and right entity that share a dimension: left, right, dot, cosine (0 if a norm is 0).

    Long-form vectors (entity, dims, value); one join on the dimensions, norms joined on afterwards.
    """
    a, b = vectors.select(left, *dims, F.col(value).alias("__x")), other.select(right, *dims, F.col(value).alias("__y"))
    na = a.groupBy(left).agg(F.sum(F.col("__x") * F.col("__x")).alias("__na"))
    nb = b.groupBy(right).agg(F.sum(F.col("__y") * F.col("__y")).alias("__nb"))
    dots = a.join(b, dims).groupBy(left, right).agg(F.sum(F.col("__x") * F.col("__y")).alias("dot"))
    return dots.join(na, left).join(nb, right).select(left, right, "dot", F.coalesce(F.try_divide(F.col("dot"), F.sqrt("__na") * F.sqrt("__nb")), F.lit(0.0)).alias("cosine"))


def best_match(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by a total order. The filter on the row number lets Spark prune before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def graded(score: Column | str, high: float, review: float, labels: tuple[str, str, str] = ("高置信", "待复核", "低置信")) -> Column:
    """Label of a score by two thresholds; null falls to the lowest."""
    score = F.col(score) if isinstance(score, str) else score
    return F.when(score >= high, labels[0]).when(score >= review, labels[1]).otherwise(labels[2])


def bridge_vote(shared: DataFrame, keys: list[str], target: str, votes: str, weight: str, high: float = 0.90, review: float = 0.70) -> DataFrame:
    """For each key the target with most votes (then weight, then name), with its share of all votes and a grade."""
    total = F.sum(votes).over(W.partitionBy(*keys))
    best = best_match(shared.withColumn("total_orders", total), keys, [F.desc(votes), F.desc(weight), F.asc(target)])
    share = F.try_divide(F.col(votes).cast("double"), F.col("total_orders"))
    return best.withColumn("bridge_share", share).withColumn("bridge_status", graded("bridge_share", high, review))
