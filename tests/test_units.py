"""Unit conversion: worked cases, bad rows, and a brute-force reader over the test table."""

import re
import unicodedata
from decimal import ROUND_HALF_UP, Decimal

from reconspark.operators.units import MEASURES, PACKS, to_base_units

SPECS = [
    ("S1", "P1", "20克/支，5支/盒，24盒/箱", "g"), ("S2", "P2", "每箱10盒，每盒8罐，每罐330毫升", "ml"), ("S3", "P3", "净含量:2000mL；规格:20桶/箱，计量单位：箱", "ml"),
    ("S4", "P4", "1箱=6瓶，每瓶2L 默认单位瓶", "ml"), ("S5", "P5", "6个×24板/箱（按板计）", "pc"), ("S6", "P6", None, "g"), (None, None, "", None),
    ("S7", "P7", "1kg/支，6支/盒，16盒/箱", "g"), ("S8", "P8", "1LX8桶X20盒/箱", "ml"), ("S9", "P9", "2斤/袋，2.5袋/盒", "g"), ("S10", "P10", "9" * 300 + "g/袋，" + "9" * 300 + "袋/箱", "g"),
]
CASES = [
    ("S1", "箱", 1.0, 2400000), ("s1 ", "整箱", 2.0, 4800000), ("SKU:P1", "4盒装箱", 1.0, 400000), ("S1", "箱（10盒装）", 0.5, 500000), ("S1", "g", 5.0, None),
    ("S1", "G", 5.0, 5000), ("S1", "市斤", 1.0, 500000), ("S1", "lb", 0.27, 122470), ("S1", "ml", 5.0, None), ("S1", "", 5.0, None), ("S1", "桶", 5.0, None),
    ("S2", "罐(250毫升)", 2.0, 500000), ("S2", "0.3L", 1.0, 300000), ("S2", "ctn", 1.0, 26400000), ("S3", None, 1.0, 40000000), ("S4", " ", 1.0, 2000000), ("S4", "N/A", 1.0, 2000000),
    ("S5", "板", 2.0, 12000), ("S5", "打", 1.0, 12000), ("S5", "", 1.0, 6000), ("S6", "kg", 0.0005, 500), ("S6", "箱", 1.0, None), ("nope", "kg", 1.0, None),
    ("S1", "mg", 0.5, 1), ("S1", "mg", -0.5, -1), ("S1", "kg", None, None), ("S1", "kg", float("nan"), None), (None, "kg", 1.0, None), ("S1", "x" * 40000, 1.0, None),
    ("S7", "箱", 1.0, 96000000), ("S7", "盒", 1.0, 6000000), ("S8", "整箱", 2.0, 320000000), ("S8", "桶", 1.0, 1000000), ("S9", "盒", 1.0, 2500000), ("S9", "袋", 1.0, 1000000), ("S10", "箱", 1.0, None), ("S10", "kg", 1.0, 1000000),
    ("S1", "kg", 1e300, None), ("S1", "kg", float("inf"), None), ("S1", "9" * 400 + "kg", 1.0, None), ("S1", "lb", 0.0000011, 0),
]


def test_cases(spark):
    specs = spark.createDataFrame(SPECS, "sap_code string, product_code string, spec_text string, base_unit string")
    rows = spark.createDataFrame([(i, *c[:3], "clash") for i, c in enumerate(CASES)], "row_id long, material_key string, unit string, quantity double, alias string")
    got = {r.row_id: r.milli_quantity for r in to_base_units(rows, specs).collect()}
    assert got == {i: c[3] for i, c in enumerate(CASES) if c[3] is not None}
    assert to_base_units(rows.limit(0), specs).count() == 0
    assert to_base_units(rows, specs.limit(0)).count() == 0


def brute(unit, spec, base):
    """Milli base units of one `unit`, by plain string handling."""
    measure = {a: (b, Decimal(f)) for _, b, f, names in MEASURES for a in names}
    pack = {a: u for u, names in PACKS for a in names}
    text = re.sub(r"\s", "", unicodedata.normalize("NFKC", spec.replace("㎖", "ml").replace("㎏", "kg"))).lower()
    text = re.sub(r"[x×*](?=\d)", ",", text)
    count = re.search(r"(?:计量单位:|默认单位|\(按)(.)", text)
    text = re.split(r",计量单位|默认单位|\(按", text)[0]
    levels = re.findall(r"(\d+(?:\.\d+)?)([a-z克毫升千厘公]+|[个只箱盒袋包罐瓶桶块支板])", text)
    levels = [x for x in levels if x != ("1", "箱")]
    if levels[0][1] not in measure:
        levels.reverse()
    amount, sizes = Decimal(levels[0][0]) * measure[levels[0][1]][1], {}
    for n, u in levels[1:]:
        sizes[u] = amount
        amount *= int(n)
    sizes["箱"] = amount
    u = re.sub(r"\s", "", unicodedata.normalize("NFKC", unit or "").replace("㎖", "ml").replace("㎏", "kg")).lower()
    n = Decimal(1)
    if u == "":
        u = count[1] if count else "?"
    elif m := re.search(r"(\d+(?:\.\d+)?)([^\d/()装]+)", u):
        n, u = Decimal(m[1]), m[2]
    elif len(u) > 1 and u.endswith("装"):
        u = u[:-1]
    if u in measure:
        return n * measure[u][1] if measure[u][0] == base else None
    return n * sizes[pack[u]] if pack.get(u) in sizes else None


def test_against_brute_force(spark, tiny):
    rows, specs = spark.read.parquet(f"{tiny}/wdt_order_item_stage.parquet"), spark.read.parquet(f"{tiny}/material_spec.parquet")
    by = {}
    for s in specs.collect():
        by[s.sap_code] = by[f"SKU:{s.product_code}"] = s
    want = {}
    for r in rows.collect():
        s = by.get((r.material_key or "").strip().upper())
        if s and r.quantity is not None and r.unit != s.base_unit and (one := brute(r.unit, s.spec_text, s.base_unit)) is not None:
            want[r.row_id] = int((Decimal(repr(r.quantity)) * one * 1000).to_integral_value(ROUND_HALF_UP))
    assert len(want) > 300
    assert {r.row_id: r.milli_quantity for r in to_base_units(rows, specs).collect()} == want
