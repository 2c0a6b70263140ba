"""Every query with an oracle, run by Spark and by DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from reconspark.plans import cleaning, cleaning_sql, raw, raw_sql, recon, recon_sql, single, single_sql

QUERIES = cleaning.QUERIES | raw.QUERIES | recon.QUERIES | single.QUERIES
ORACLES = cleaning_sql.ORACLES | raw_sql.ORACLES | recon_sql.ORACLES | single_sql.ORACLES


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for f in glob.glob(f"{tiny}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(row):
    return tuple(round(x, 6) + 0.0 if isinstance(x, float) and not math.isnan(x) else x for x in row)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, tiny, duck, name):
    want = duck.execute(ORACLES[name]).fetchall()
    columns = [c[0] for c in duck.description]
    df = QUERIES[name](spark, tiny)
    assert sorted(df.columns) == sorted(columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(map(plain, got), key=str) == sorted(map(plain, want), key=str)


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 3
    assert set(entry.oracle_sql()) <= set(entry.queries())
