"""The chain's steps as queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reconspark.plans.chain import Chain, fixture_chain
from reconspark.plans.recon_sql import ORACLES


def _step(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, d: str) -> DataFrame:
        return getattr(fixture_chain(spark, d), name)

    query.__name__ = name
    query.__doc__ = getattr(Chain, name).__doc__
    return query


QUERIES = {name: _step(name) for name in ORACLES}
