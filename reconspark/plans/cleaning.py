"""Queries of the general cleaning problems over the reconciliation tables (p1, p4, p6, p7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconspark.functions.numbers import exact, parse_amount
from reconspark.functions.text import trimmed_key, typed_key
from reconspark.operators.differences import difference_summary, differences
from reconspark.operators.moments import estimate_zones, instants
from reconspark.operators.orphans import orphan_report, orphans
from reconspark.operators.units import to_base_units
from reconspark.sources.tables import table

AMOUNTS = ("wdt_amount", "bill_receivable", "bill_cash")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every readable ship_time, business_date and period_end as UTC milliseconds."""
    files = table(spark, d, "export_file")
    orders = instants(table(spark, d, "wdt_orders_file"), files, "row_id", ("ship_time",), "wdt_orders_file", "payment_time")
    bills = instants(table(spark, d, "huice_detail"), files, "row_id", ("business_date", "period_end"), "huice_detail")
    return orders.unionByName(bills)


def p1_zones(spark: SparkSession, d: str) -> DataFrame:
    """The zone estimated for each file from its rows alone, beside the declared one."""
    files = table(spark, d, "export_file")
    names = files.select("source_file", "exported_at", "date_order", F.col("tz_name").alias("declared")).dropDuplicates(["source_file"])
    texts = table(spark, d, "wdt_orders_file").select("source_file", F.col("ship_time").alias("t"), F.col("payment_time").alias("e"))
    bills = table(spark, d, "huice_detail")
    for field in ("business_date", "period_end"):
        texts = texts.unionAll(bills.select("source_file", F.col(field).alias("t"), F.lit(None).cast("string")))
    rows = texts.join(names, "source_file")
    found = estimate_zones(rows, "source_file", "t", "exported_at", "date_order", "e")
    return found.join(names.select("source_file", "declared"), "source_file")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Keys on one side only and differing amounts of the reconciliation and its exported copy."""
    left, right = _recon_sides(spark, d)
    return differences(left, right, "platform_order_no", AMOUNTS, ("recon", "copy"))


def _recon_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    left = table(spark, d, "v4_order_bill_recon").select(typed_key("platform_order_no").alias("platform_order_no"), *[exact(a).alias(a) for a in AMOUNTS])
    right = table(spark, d, "v4_order_bill_copy").select(typed_key("platform_order_no").alias("platform_order_no"), *[parse_amount(a).alias(a) for a in AMOUNTS])
    return left, right


def p4_summary(spark: SparkSession, d: str) -> DataFrame:
    """How many keys each kind of difference has."""
    return difference_summary(p4_found(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Item quantities in thousandths of the base unit of their material."""
    return to_base_units(table(spark, d, "wdt_order_item_stage"), table(spark, d, "material_spec"))


def _references(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    files = table(spark, d, "export_file").select("source_file", "file_month").dropDuplicates(["source_file"])
    bill, amount, item, product = (table(spark, d, t) for t in ("huice_detail", "huice_current_amount", "wdt_order_item_stage", "wdt_product_sap"))
    named = (("huice_detail.reconcile_id", bill, "reconcile_id"), ("huice_current_amount.reconcile_id", amount, "reconcile_id"), ("wdt_order_item_stage.material_key", item, "material_key"))
    refs, targets = None, None
    for field, df, key in named:
        part = df.select(F.lit(field).alias("ref_field"), F.col("row_id"), F.col("source_file"), trimmed_key(key).alias("k"))
        refs = part if refs is None else refs.unionByName(part)
    products = product.select(F.explode(F.array(trimmed_key("sap_code"), F.concat(F.lit("SKU:"), trimmed_key("product_code")))).alias("k"))
    for field, df in ((named[0][0], amount.select(trimmed_key("reconcile_id").alias("k"))), (named[1][0], bill.select(trimmed_key("reconcile_id").alias("k"))), (named[2][0], products)):
        part = df.select(F.lit(field).alias("ref_field"), "k")
        targets = part if targets is None else targets.unionByName(part)
    tag = F.create_map(*[F.lit(x) for i, (f, _, _) in enumerate(named) for x in (f, f"{i}|")])
    key = F.concat(tag[F.col("ref_field")], F.col("k"))
    refs = refs.join(files, "source_file", "left").select("ref_field", "row_id", "file_month", key.alias("ref_key"))
    return refs, targets.select("ref_field", key.alias("target_key"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows that refer to a bill, an amount or a material that does not exist."""
    refs, targets = _references(spark, d)
    return orphans(refs, targets, ["file_month"]).select("ref_field", "row_id", "file_month")


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """References and orphans per field and file month."""
    return orphan_report(*_references(spark, d), ["ref_field", "file_month"])


QUERIES = {f.__name__: f for f in (p1_found, p1_zones, p4_found, p4_summary, p6_found, p7_found, p7_report)}
