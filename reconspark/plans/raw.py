"""Queries of the ingestion: each guard, conflict policy and derived field over raw inputs as text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconspark.functions.text import trimmed_key
from reconspark.operators.dedup import keep_first
from reconspark.operators.recon import classify, within
from reconspark.plans import ingest
from reconspark.plans.chain import Chain, Scope
from reconspark.plans.fixtures import views
from reconspark.plans.raw_fixtures import raw_views
from reconspark.sources.tables import table

#: Of the raw fixtures: months are twenty years later than in the star schema, amounts whole.
RAW_SCOPE = Scope(money=0.01, count=0.000001, start="2016-01-01", end="2018-07-01", year="2017", span=("2015-12", "2018-06"))


def _made(make: Callable[[DataFrame], DataFrame], name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: make(raw_views(spark, d)[name])


def _chain(spark: SparkSession, d: str) -> Chain:
    r = raw_views(spark, d)
    tables = {
        "fx_order_file": ingest.order_files(r["lines"]), "fx_order_line": ingest.order_lines(r["lines"]), "fx_item": ingest.items(r["lines"]), "fx_product": ingest.products(r["lines"]), "fx_bill": ingest.bills(r["bill_rows"]),
        "fx_current": ingest.current_amounts(r["bill_rows"]), "fx_summary": ingest.summaries(r["summary_rows"]), "fx_sap": ingest.invoices(r["invoice_rows"]), "fx_oms": ingest.closes(r["dump_rows"]),
    }
    return Chain(spark, tables, RAW_SCOPE)


def raw_item_months(spark: SparkSession, d: str) -> DataFrame:
    """Raw item lines through guards, code resolution and the span of months to sums by month and material."""
    rows = _chain(spark, d).item_resolved
    return rows.groupBy("ship_month", "material_code").agg(F.sum("quantity").alias("quantity"), F.sum("amount").alias("amount"), F.sum("line_count").alias("line_count"))


def raw_bill_months(spark: SparkSession, d: str) -> DataFrame:
    """Raw bills joined with their current amounts, by shop and month within the span."""
    chain = _chain(spark, d)
    later = chain.bill_current.withColumn("bill_month", F.concat((F.substring("bill_month", 1, 4).cast("int") + 20).cast("string"), F.substring("bill_month", 5, 3)))
    return chain.spanned(later, "bill_month").groupBy("bill_month", "shop").agg(F.count(F.lit(1)).alias("bill_rows"), F.sum("current_receivable").alias("bill_receivable"), F.sum("current_cash").alias("bill_cash"))


def bill_current_join(spark: SparkSession, d: str) -> DataFrame:
    """Bill details with the current amounts that another table holds: the first record of each id on both sides, by shop."""
    key = trimmed_key("reconcile_id").alias("k")
    bills = keep_first(table(spark, d, "huice_detail").select(key, "row_id", "shop").where("k is not null"), ["k"], ["row_id"])
    amounts = table(spark, d, "huice_current_amount").select(key, "row_id", "current_receivable", "current_cash").where("k is not null")
    amounts = keep_first(amounts, ["k"], ["row_id"]).select("k", *[F.col(c).cast("decimal(18,4)").alias(c) for c in ("current_receivable", "current_cash")])
    sums = [F.sum(c).cast("double").alias(c) for c in ("current_receivable", "current_cash")]
    return bills.join(amounts, "k").groupBy("shop").agg(F.count(F.lit(1)).alias("bill_rows"), *sums)


def tolerance_boundary(spark: SparkSession, d: str) -> DataFrame:
    """Amounts and quantities in doubles at, under and over the tolerances of a cent and a millionth, by outcome."""
    v = views(spark, d)["fx_line"]
    amount, qty = F.col("cents").cast("double") / 100, F.col("qty").cast("double")
    rows = v.select(amount.alias("a"), (amount + (F.col("ln") - 3).cast("double") / 200).alias("b"), qty.alias("p"), (qty + F.when(F.col("pk") % 3 == 0, 0.0).when(F.col("pk") % 3 == 1, 5e-7).otherwise(1.5e-6)).alias("q"), "ln")
    same = within("p", "q", Scope.count)
    result = classify([(same & within("a", "b", Scope.money), "数量金额一致"), (same, "数量一致金额差异")], "数量金额差异")
    return rows.groupBy("ln", result.alias("result")).agg(F.count(F.lit(1)).alias("row_count"))


QUERIES = {
    "ingest_orders": _made(ingest.order_files, "lines"), "ingest_order_lines": _made(ingest.order_lines, "lines"), "ingest_items": _made(ingest.items, "lines"), "ingest_products": _made(ingest.products, "lines"),
    "ingest_bills": _made(ingest.bills, "bill_rows"), "ingest_current": _made(ingest.current_amounts, "bill_rows"), "ingest_summaries": _made(ingest.summaries, "summary_rows"), "ingest_invoices": _made(ingest.invoices, "invoice_rows"),
    "ingest_closes": _made(ingest.closes, "dump_rows"), **{f.__name__: f for f in (raw_item_months, raw_bill_months, bill_current_join, tolerance_boundary)},
}
