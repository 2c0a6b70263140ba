"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reconspark.session import ship


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table, a file or a folder of part files."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
