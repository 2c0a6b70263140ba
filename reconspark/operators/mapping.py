"""Customers mapped to shops by name, platform and what they bought: candidates, scores and the best of each customer.

Names are compared once for each pair of different normalised texts that share a character, since the ratio of all others is
0; for these, one shop of each platform stands for all others of that platform. No pair beyond that is ever formed, and the
best candidate is the same as over all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reconspark.functions import business as B
from reconspark.operators.matching import best_match, cosine, graded, sequence_ratio


def name_ratios(left: DataFrame, right: DataFrame) -> DataFrame:
    """a, b, ratio of every two different-sided texts (`left.a`, `right.b`) that share a character; blank texts share none."""
    letters = lambda df, c: df.where(F.col(c) != "").select(c).distinct().select(c, F.explode(F.array_distinct(F.split(c, ""))).alias("__c"))
    pairs = letters(left, "a").join(letters(right, "b"), "__c").select("a", "b").distinct()
    return pairs.withColumn("ratio", sequence_ratio("a", "b"))


def _with_stand_ins(customers: DataFrame, shops: DataFrame, near: DataFrame, platform: str, order: list[str], key: str) -> DataFrame:
    """`near` (key and the columns of `shops`) united with one shop of each platform, the first by `order`, for every customer.

    There are as many stand-ins as platforms, a fixed list of words, which bounds what is broadcast.
    """
    first = best_match(shops, [platform], [F.asc(c) for c in order])
    stand = customers.select(key).withColumn("__all", F.lit(1)).join(F.broadcast(first.withColumn("__all", F.lit(1))), "__all").drop("__all")
    return near.unionByName(stand).distinct()


def customer_candidates(closes: DataFrame, bills: DataFrame) -> DataFrame:
    """customer_code, customer_name, platform, shop, match_score of the pairs that can be a customer's best.

    The score is the ratio of the normalised names (0.85 at least if one contains the other), plus 0.12 for the same
    platform and less 0.20 for another; a bracketed part of the customer's name stands for the whole.
    """
    customers = closes.where("customer_code is not null").groupBy("customer_code").agg(F.coalesce(F.min("customer_name"), F.lit("")).alias("customer_name"))
    inner = B.inside_brackets("customer_name")
    customers = customers.withColumns({"a": B.normalize_name(F.when(inner != "", inner).otherwise(F.col("customer_name"))), "cp": B.platform_word("customer_name")})
    shops = bills.where("shop <> ''").select(F.coalesce("platform", F.lit("")).alias("platform"), "shop").distinct()
    shops = shops.withColumns({"b": B.normalize_name("shop"), "sp": B.platform_word(F.concat("platform", "shop"))})
    ratios = name_ratios(customers, shops)
    near = customers.select("customer_code", "a").join(ratios.select("a", "b"), "a").join(shops, "b").select("customer_code", *shops.columns)
    pairs = _with_stand_ins(customers, shops, near, "sp", ["platform", "shop"], "customer_code")
    pairs = pairs.join(customers, "customer_code").join(ratios, ["a", "b"], "left")
    contained = (F.col("a") != "") & (F.col("b") != "") & (F.contains("a", "b") | F.contains("b", "a"))
    name = F.greatest(F.coalesce("ratio", F.lit(0.0)), F.when(contained, 0.85).otherwise(0.0))
    bonus = F.when((F.col("cp") == "") | (F.col("sp") == ""), 0.0).when(F.col("cp") == F.col("sp"), 0.12).otherwise(-0.20)
    return pairs.select("customer_code", "customer_name", "platform", "shop", F.round(name + bonus, 6).alias("match_score"))


def customer_shop_map(closes: DataFrame, bills: DataFrame) -> DataFrame:
    """The best bill shop of each customer, graded; below the last grade the shop is blank. Ties fall to the smaller name."""
    best = best_match(customer_candidates(closes, bills), ["customer_code"], [F.desc("match_score"), F.asc("platform"), F.asc("shop")])
    status = graded("match_score", 0.72, 0.48, ("自动高置信", "自动待复核", "未映射"))
    keep = lambda c: F.when(F.col("mapping_status") == "未映射", "").otherwise(F.col(c))
    return best.withColumn("mapping_status", status).select("customer_code", "customer_name", keep("platform").alias("mapped_platform"), keep("shop").alias("mapped_shop"), "match_score", "mapping_status")


def shop_vectors(items: DataFrame, closes: DataFrame, amount: Column | None = None, share: Column | None = None) -> DataFrame:
    """shop, customer_code, cosine of every shop and customer that share a month and item; daily closes only."""
    amount, share = F.col("amount") if amount is None else amount, F.col("share_amount") if share is None else share
    w = items.groupBy("shop", F.col("ship_month").alias("month"), F.col("material_key").alias("item")).agg(F.sum(amount.cast("double")).alias("x"))
    o = closes.where("business_type = 'Y005' and customer_code is not null").groupBy("customer_code", F.col("outbound_month").alias("month"), F.col("item_code").alias("item")).agg(F.sum(share.cast("double")).alias("x"))
    return cosine(w, "shop", "customer_code", ["month", "item"], "x", o).select("shop", "customer_code", "cosine")


def shop_candidates(customers: DataFrame, shops: DataFrame, vectors: DataFrame) -> DataFrame:
    """customer_code, customer_name, shop, vector_score, name_score, platform_score, total_score of the pairs that can be a
    customer's best: what they bought (half), name (three tenths) and platform (a fifth).

    `customers` has customer_code and customer_name, `shops` shop, `vectors` shop, customer_code and cosine.
    """
    customers = customers.select("customer_code", "customer_name").distinct().withColumns({"a": B.normalize_shop("customer_name"), "cp": B.platform_token(F.coalesce("customer_name", F.lit("")))})
    shops = shops.select("shop").distinct().withColumns({"b": B.normalize_shop("shop"), "sp": B.platform_token("shop")})
    ratios = name_ratios(customers, shops)
    near = customers.select("customer_code", "a").join(ratios.select("a", "b"), "a").join(shops, "b").select("customer_code", *shops.columns)
    bought = vectors.select("customer_code", "shop").join(shops, "shop").select("customer_code", *shops.columns)
    pairs = _with_stand_ins(customers, shops, near.unionByName(bought), "sp", ["shop"], "customer_code")
    pairs = pairs.join(customers, "customer_code").join(ratios, ["a", "b"], "left").join(vectors, ["customer_code", "shop"], "left")
    platform = F.when((F.col("cp") == "") | (F.col("sp") == ""), 0.4).when(F.col("cp") == F.col("sp"), 1.0).otherwise(0.0)
    scored = pairs.select("customer_code", "customer_name", "shop", F.coalesce("cosine", F.lit(0.0)).alias("vector_score"), F.round(F.coalesce("ratio", F.lit(0.0)), 6).alias("name_score"), platform.alias("platform_score"))
    return scored.withColumn("total_score", F.round(F.col("vector_score") * 0.5 + F.col("name_score") * 0.3 + F.col("platform_score") * 0.2, 6))


def best_shops(candidates: DataFrame) -> DataFrame:
    """The best candidate of each customer, graded; ties fall to the smaller name."""
    best = best_match(candidates, ["customer_code"], [F.desc("total_score"), F.asc("shop")])
    return best.withColumn("mapping_status", graded("total_score", 0.72, 0.55))


def shop_map(items: DataFrame, closes: DataFrame, span: tuple[str, str] | None = None) -> DataFrame:
    """The best order shop (wdt_shop) of each customer of the daily closes; `span` limits the items and the customers by month."""
    within = lambda df, c: df if span is None else df.where(F.col(c).between(*span))
    items = within(items, "ship_month")
    customers = within(closes, "outbound_month").where("business_type = 'Y005' and customer_code is not null")
    found = best_shops(shop_candidates(customers, items.where("shop <> ''"), shop_vectors(items, closes)))
    return found.withColumnRenamed("shop", "wdt_shop")
