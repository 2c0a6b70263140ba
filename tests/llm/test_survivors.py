"""Field-wise survivors against a brute-force choice, with hot groups, nulls and ties."""

import random
from collections import defaultdict
from datetime import datetime


from reconspark.llm.queries import p2_found
from reconspark.llm.survivors import by_field, survivors

SCHEMA = "row_id long, k string, a string, n double, trust int, at timestamp_ntz, x string"


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        if r[1] is not None:
            groups[r[1]].append(r)
    out = set()
    for g in groups.values():
        if len(g) < 2:
            continue
        for name, i in (("a", 2), ("n", 3)):
            full = [r for r in g if not (r[i] is None or r[i] != r[i] or (isinstance(r[i], str) and r[i].strip() in ("", "-")))]
            if full:
                best = max(full, key=lambda r: (-(r[4] if r[4] is not None else 2**60), r[5] or datetime(1, 1, 1), r[0]))
                out.add((min(r[0] for r in g), name, best[0]))
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else rng.choice([f"k{j}" for j in range(120)] + [None])
        rows.append((i, key, rng.choice(["x", "", None, "-", " "]), rng.choice([1.0, None, float("nan")]), rng.choice([1, 2, None]), rng.choice([datetime(2026, 1, d) for d in (1, 2)] + [None]), "clash"))
    df = spark.createDataFrame(rows, SCHEMA)
    for part_rows in (3, 50, 10**9):
        found = survivors(df, "k", "row_id", ("a", "n"), "trust", "at", part_rows=part_rows)
        assert {tuple(r) for r in by_field(found, ("a", "n")).collect()} == brute(rows)
    assert survivors(df.limit(0), "k", "row_id", ("a",), "trust", "at").count() == 0


def test_query_against_sql(spark, tiny):
    import duckdb

    from reconspark.llm.sql import ORACLES

    con = duckdb.connect()
    for t in ("wdt_orders_file", "export_file"):
        con.execute(f"create view {t} as select * from '{tiny}/{t}.parquet'")
    want = {tuple(r) for r in con.execute(ORACLES["p2_found"]).fetchall()}
    assert {tuple(r) for r in p2_found(spark, tiny).select("group_row_id", "field_name", "value_row_id").collect()} == want
    assert len(want) > 50
