"""Queries of the training-data problems tagged llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconspark.functions.text import typed_key
from reconspark.llm.bpe import token_counts, token_ids
from reconspark.llm.linkage import links, stores
from reconspark.llm.mixing import mixture, shares
from reconspark.llm.names import Words, learned_words
from reconspark.llm.reading import reading_levels
from reconspark.llm.survivors import by_field, survivors
from reconspark.llm.variants import parsed_names, spelling_classes, spelling_pairs
from reconspark.session import staged
from reconspark.sources.tables import table

ORDER_FIELDS = ("shop", "platform_order_no", "order_status", "payment_time", "ship_time", "receivable_amount")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Which row's value survives for each field of each order that was exported more than once."""
    files = table(spark, d, "export_file").select("source_file", "trust_rank", "exported_at").dropDuplicates(["source_file"])
    rows = table(spark, d, "wdt_orders_file").select("row_id", "source_file", typed_key("order_no").alias("k"), *ORDER_FIELDS).join(files, "source_file", "left")
    return by_field(survivors(rows, "k", "row_id", ORDER_FIELDS, "trust_rank", "exported_at"), ORDER_FIELDS)


def _words(spark: SparkSession, d: str) -> Words:
    """Platforms and cities as the bills and profiles write them."""
    profiles = table(spark, d, "shop_profile")
    said = table(spark, d, "huice_detail").select("shop", "platform").unionAll(profiles.where("profile_side <> 'oms'").select("entity_key", "platform_text"))
    return learned_words(said, profiles.select("city_text"))


def p3_links(spark: SparkSession, d: str) -> DataFrame:
    """Confidence of every candidate pair of customers, bill shops and order shops."""
    return links(table(spark, d, "shop_profile"), table(spark, d, "customer_shop_map"), table(spark, d, "huice_detail").select("shop", "platform"), _words(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The bill shop and the order shop of each customer that runs a store."""
    return stores(p3_links(spark, d)).select("customer_code", "profile_side", "shop")


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    """The class of each shop text and how many other texts are linked with it."""
    shops = table(spark, d, "huice_detail").select("shop").unionAll(table(spark, d, "wdt_orders_file").select("shop"))
    shops = shops.where("shop is not null").groupBy("shop").agg(F.count(F.lit(1)).alias("n"))
    profiles = table(spark, d, "shop_profile").where("profile_side <> 'oms' and nick is not null").select(F.col("entity_key").alias("shop"), F.lower("nick").alias("said"))
    words = _words(spark, d)
    nicknames = parsed_names(profiles, words=words).where("brand <> ''").select(F.col("said").alias("nick"), "brand")
    return spelling_classes(shops, nicknames, words)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of spellings of one store."""
    return spelling_pairs(p5_classes(spark, d))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return token_ids(table(spark, d, "documents"))


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return staged(token_counts(table(spark, d, "documents"), ("doc_id", "source")), "token-counts")


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The mixture of all sources at their target shares, one row for each copy of a document."""
    return mixture(_sizes(spark, d), table(spark, d, "mix_target"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share that each source really reached, beside its target."""
    sizes, targets = _sizes(spark, d), table(spark, d, "mix_target")
    return shares(sizes, targets, mixture(sizes, targets))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Reading level of every document with at least two sentences of prose."""
    return reading_levels(table(spark, d, "documents"), table(spark, d, "reading_label")).select("doc_id", "reading_level")


QUERIES = {f.__name__: f for f in (p2_found, p3_found, p3_links, p5_found, p5_classes, p8_ids, p9_mixture, p9_shares, p10_found)}
