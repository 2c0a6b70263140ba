"""Customer-shop maps against brute force over all pairs with difflib."""

import difflib
import re
import unicodedata

from pyspark.sql import functions as F

from reconspark.functions.business import NAME_NOISE, PLATFORM_TOKENS, PLATFORM_WORDS, SHOP_NOISE
from reconspark.operators import mapping
from reconspark.plans import single


def normal(text):
    bare = re.sub("|".join(NAME_NOISE), "", unicodedata.normalize("NFKC", text or "").lower())
    return re.sub(r"[\s()（）\-—_·.,，。/]+", "", bare)


def shop_normal(text):
    return re.sub("|".join(SHOP_NOISE), "", normal(text))


def ratio(a, b):
    return difflib.SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def word(text):
    return next((w for w in PLATFORM_WORDS if w in text), "")


def token(text):
    return next((p for t, p in PLATFORM_TOKENS if t in (text or "")), "")


def brute_map(customers, shops):
    out = {}
    for code, name in customers:
        a = normal(" ".join(re.findall(r"[（(]([^）)]+)[）)]", name)) or name)
        best = []
        for platform, shop in shops:
            b = normal(shop)
            score = max(ratio(a, b), 0.85) if a and b and (a in b or b in a) else ratio(a, b)
            p, q = word(name), word(platform + shop)
            score += (0.12 if p == q else -0.20) if p and q else 0.0
            best.append((-round(score, 6), platform, shop))
        score, platform, shop = min(best)
        status = "自动高置信" if -score >= 0.72 else "自动待复核" if -score >= 0.48 else "未映射"
        out[code] = (-score, status, *(("", "") if status == "未映射" else (platform, shop)))
    return out


def test_customer_map_on_the_tables(spark, tiny):
    customers = [(r.customer_code, r.customer_name or "") for r in spark.read.parquet(f"{tiny}/customer_shop_map.parquet").where("customer_code is not null").collect()]
    shops = {(r.platform or "", r.shop) for r in spark.read.parquet(f"{tiny}/huice_detail.parquet").where("shop <> ''").select("platform", "shop").distinct().collect()}
    got = {r.customer_code: (r.match_score, r.mapping_status, r.mapped_platform, r.mapped_shop) for r in single.customer_shop_candidates(spark, tiny).collect()}
    assert got == brute_map(customers, shops) and len(got) > 20


def test_customer_map_edges(spark):
    closes = spark.createDataFrame([("C1", "xyz"), ("C2", "天猫 qqq"), ("C3", None), ("C4", "甲乙（京东丙丁）"), ("C4", "甲乙（京东丙丁）"), (None, "甲")], "customer_code string, customer_name string")
    bills = spark.createDataFrame([("天猫", "甲甲店"), ("京东", "丙丁"), (None, "丁丙"), ("淘宝", ""), ("x", None)], "platform string, shop string")
    got = {r.customer_code: (r.match_score, r.mapping_status, r.mapped_platform, r.mapped_shop) for r in mapping.customer_shop_map(closes, bills).collect()}
    assert got == brute_map([("C1", "xyz"), ("C2", "天猫 qqq"), ("C3", ""), ("C4", "甲乙（京东丙丁）")], [("天猫", "甲甲店"), ("京东", "丙丁"), ("", "丁丙")])
    assert mapping.customer_shop_map(closes.limit(0), bills).count() == 0 and mapping.customer_shop_map(closes, bills.limit(0)).count() == 0


def test_shop_map_against_all_pairs(spark, tiny):
    vectors = {(r.customer_code, r.shop): r.cosine for r in single.vector_cosine(spark, tiny).collect()}
    customers = {(r.customer_code, r.customer_name) for r in single.views(spark, tiny)["fx_shop_map"].collect()}
    shops = {r.shop for r in single.views(spark, tiny)["fx_item"].select("shop").distinct().collect()}
    want = {}
    for code, name in customers:
        scored = []
        for shop in shops:
            p, q = token(name), token(shop)
            score = 0.5 * vectors.get((code, shop), 0.0) + 0.3 * round(ratio(shop_normal(name), shop_normal(shop)), 6) + 0.2 * (0.4 if not p or not q else float(p == q))
            scored.append((-round(score, 6), shop))
        want[code] = min(scored)
    got = {r.customer_code: (-r.total_score, r.shop) for r in single.shop_map(spark, tiny).collect()}
    assert set(got) == set(want) and len(got) > 10
    assert all(got[c][1] == shop and abs(got[c][0] - score) < 2e-6 for c, (score, shop) in want.items())


def test_name_ratio_rows(spark, tiny):
    rows = single.name_ratio(spark, tiny).join(spark.read.parquet(f"{tiny}/wdt_oms_shop_map.parquet").select("customer_code", "wdt_shop", F.col("customer_name").alias("raw")), ["customer_code", "wdt_shop"]).collect()
    assert rows
    for r in rows:
        assert r.customer == shop_normal(r.raw) and r.shop == shop_normal(r.wdt_shop) and abs(r.name_score - ratio(r.customer, r.shop)) < 1e-12
