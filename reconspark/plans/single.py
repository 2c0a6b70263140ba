"""Queries that prove one operator each, on raw tables, fixture views and the chain's steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reconspark.functions import business as B
from reconspark.functions.numbers import parse_number
from reconspark.operators import dedup, mapping, rollup
from reconspark.operators.matching import best_match, cosine, sequence_ratio
from reconspark.operators.recon import exception_first, exception_rank, within
from reconspark.plans import reports
from reconspark.plans.chain import Chain, fixture_chain
from reconspark.plans.fixtures import views
from reconspark.sources.tables import table

LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


def scan_parse_number(spark: SparkSession, d: str) -> DataFrame:
    """Amounts read from text with separators, blanks and placeholders; '1d' is no number."""
    return views(spark, d)["fx_text"].select("ok", parse_number("number_text").alias("amount"))


def month_extract(spark: SparkSession, d: str) -> DataFrame:
    """Months from date texts and from file names."""
    return views(spark, d)["fx_text"].select("ok", B.month_of("month_text").alias("month"), B.month_of_file("file_name", "none").alias("file_month"))


def surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    """Blank platform keys replaced by prefix and own number."""
    return views(spark, d)["fx_order_file"].select("order_no", "source_file", B.surrogate("platform_order_no", "__WDT__", "order_no").alias("order_key"), F.when(F.col("platform_order_no") == "", 0).otherwise(1).alias("matchable"))


def business_month(spark: SparkSession, d: str) -> DataFrame:
    """Month of the business date, else of the period's end."""
    return fixture_chain(spark, d).bill.select("reconcile_id", "bill_month", B.next_day("period_end").alias("reconcile_date"))


def net_measures(spark: SparkSession, d: str) -> DataFrame:
    """Net and current receivable and cash of each bill record."""
    return fixture_chain(spark, d).bill.select("reconcile_id", "net_receivable", "net_cash", "current_receivable", "current_cash", "computed_difference")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *LINE_ORDER)


def keep_first(spark: SparkSession, d: str) -> DataFrame:
    """First of the lines with one order and line number."""
    return dedup.keep_first(_lines(spark, d), ["l_orderkey", "l_linenumber"], LINE_ORDER).drop("l_shipdate")


def keep_last(spark: SparkSession, d: str) -> DataFrame:
    """Last of the lines with one order and line number."""
    return dedup.keep_last(_lines(spark, d), ["l_orderkey", "l_linenumber"], LINE_ORDER).drop("l_shipdate")


def upsert_sum(spark: SparkSession, d: str) -> DataFrame:
    """Quantities of repeated keys summed."""
    return dedup.upsert_sum(_lines(spark, d).withColumn("l_quantity", F.col("l_quantity").cast("long")), ["l_orderkey", "l_linenumber"], ["l_quantity"])


def run_length_orders(spark: SparkSession, d: str) -> DataFrame:
    """Contiguous runs of one event type in each user's event order."""
    events = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    return dedup.run_length(events, ["user_id"], ["ts", "event_id"], "event_type", {"first_event": F.min("event_id"), "events": F.count(F.lit(1))})


def last_runs(spark: SparkSession, d: str) -> DataFrame:
    """Of several runs of an event type, the user's last one."""
    return dedup.last_run(run_length_orders(spark, d), ["user_id"], "event_type")


def semi_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Orders that some bill proves, by shop."""
    c = fixture_chain(spark, d)
    bills = c.bill.where("platform_order_no <> ''").select("platform_order_no")
    return c.order_dedup.join(bills, "platform_order_no", "left_semi").groupBy("shop").agg(F.count(F.lit(1)).alias("orders"), F.sum("receivable").alias("receivable"))


def anti_uninvoiced(spark: SparkSession, d: str) -> DataFrame:
    """Order management rows without invoice, by business type, blank documents included."""
    v = views(spark, d)
    rows = v["fx_oms"].join(v["fx_sap"].select(F.col("oms_sales_no").alias("document_no")), "document_no", "left_anti")
    return rows.groupBy("business_type").agg(F.count(F.lit(1)).alias("row_count"), F.sum("share_amount").alias("share_amount"))


def theta_tolerance_join(spark: SparkSession, d: str) -> DataFrame:
    """Items and closes of one day and code whose amounts agree within the tolerance, by month."""
    v = views(spark, d)
    o = v["fx_oms"].select(F.col("outbound_date").alias("ship_date"), F.col("item_code").alias("material_key"), "share_amount")
    pairs = v["fx_item"].join(o, ["ship_date", "material_key"]).where(within("amount", "share_amount", 1))
    return pairs.groupBy("ship_month").agg(F.count(F.lit(1)).alias("pairs"), F.sum("amount").alias("amount"))


def cross_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Every customer with every shop of the same platform; both are short lists of distinct names."""
    v = views(spark, d)
    shops = v["fx_item"].select("shop").distinct().withColumn("platform", B.platform_token("shop"))
    customers = v["fx_shop_map"].select("customer_code", B.platform_token("wdt_shop").alias("platform"))
    return customers.join(shops, "platform").select("customer_code", "shop", "platform")


def expr_join_codes(spark: SparkSession, d: str) -> DataFrame:
    """Product codes joined on a part of the material key, by what came of it."""
    c = fixture_chain(spark, d)
    items = c.v["fx_item"].withColumn("product_code", F.substring("material_key", 5, 100)).join(c.product_code_best.select("product_code", "sap_code"), "product_code", "left")
    kind = F.when(~F.col("material_key").ilike("SKU:%"), "code").when(F.col("sap_code").isNull(), "unknown product").otherwise("resolved product")
    return items.groupBy(kind.alias("code_kind")).agg(F.count(F.lit(1)).alias("row_count"), F.sum("quantity").alias("quantity"))


def top_shop(spark: SparkSession, d: str) -> DataFrame:
    """Each material's best selling shop."""
    sums = views(spark, d)["fx_item"].groupBy("material_key", "shop").agg(F.sum("amount").alias("amount"))
    return best_match(sums, ["material_key"], [F.desc("amount"), F.asc("shop")])


def partition_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals of a whole partition beside each row."""
    w = W.partitionBy("ship_month", "shop")
    items = views(spark, d)["fx_item"].groupBy("ship_month", "shop", "material_key").agg(F.sum("amount").alias("amount"), F.sum("quantity").alias("quantity"))
    return items.select("*", F.sum(F.abs("amount")).over(w).alias("abs_amount_total"), F.sum(F.abs("quantity")).over(w).alias("abs_qty_total"), F.count(F.lit(1)).over(w).alias("item_groups"))


def topk_abs_diff(spark: SparkSession, d: str) -> DataFrame:
    """The twenty greatest differences between orders and bills."""
    rows = fixture_chain(spark, d).order_bill_recon.where("amount_difference is not null").select("platform_order_no", "amount_difference", "result")
    return rows.orderBy(F.desc(F.abs("amount_difference")), "platform_order_no").limit(20)


def exception_order(spark: SparkSession, d: str) -> DataFrame:
    """The whole order-bill reconciliation with exceptions before agreeing results, and the rank that orders it."""
    ok = ["单号金额一致"]
    rows = fixture_chain(spark, d).order_bill_recon.select("platform_order_no", "result", exception_rank(ok).alias("exception_rank"))
    return exception_first(rows, ok, "platform_order_no")


def labelled_union(spark: SparkSession, d: str) -> DataFrame:
    """Totals of three relations under their labels."""
    v = views(spark, d)
    total = lambda df, q, a: df.agg(F.sum(q).alias("quantity"), F.sum(a).alias("amount"))
    return rollup.labelled_union({"WDT": total(v["fx_item"], "quantity", "amount"), **{f"OMS_{t}": total(v["fx_oms"].where(F.col("business_type") == t), "item_num", "share_amount") for t in ("Y005", "Y001")}})


def vector_cosine(spark: SparkSession, d: str) -> DataFrame:
    """Cosine of shops and customers over their months and items."""
    v = views(spark, d)
    w = v["fx_item"].groupBy("shop", F.col("ship_month").alias("month"), F.col("material_key").alias("item")).agg(F.sum(F.col("amount").cast("double") / 100).alias("x"))
    o = v["fx_oms"].where("business_type = 'Y005' and customer_code is not null").groupBy("customer_code", F.col("outbound_month").alias("month"), F.col("item_code").alias("item")).agg(F.sum(F.col("share_amount").cast("double") / 100).alias("x"))
    return cosine(w, "shop", "customer_code", ["month", "item"], "x", o).select("shop", "customer_code", F.round("cosine", 6).alias("cosine"))


def platform_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Platform named in each bill's shop text."""
    shops = table(spark, d, "huice_detail").select("shop").where("shop is not null").distinct()
    return shops.select("shop", B.platform_token("shop").alias("platform"), B.platform_word("shop").alias("word"))


def two_level_max_sum(spark: SparkSession, d: str) -> DataFrame:
    """Sum over orders of each order's greatest amount, which undoes repeated files."""
    orders = views(spark, d)["fx_order_file"].groupBy("shop", "order_no").agg(F.max("receivable").alias("m"))
    return orders.groupBy("shop").agg(F.sum("m").alias("receivable"))


def composite_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Distinct composite keys; a key with a null part is not counted."""
    key = F.concat("outbound_month", F.lit("|"), "customer_code")
    return views(spark, d)["fx_oms"].groupBy("business_type").agg(F.countDistinct(key).alias("month_customers"), F.countDistinct("document_no").alias("documents"))


def status_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Order-bill outcomes with counts and sums."""
    return rollup.status_rollup(fixture_chain(spark, d).flow_order_bill, ["order_qty", "order_amount", "bill_receivable", "bill_cash"])


def result_share(spark: SparkSession, d: str) -> DataFrame:
    """Share of each order-bill outcome and a total row."""
    return rollup.result_share(fixture_chain(spark, d).flow_order_bill)


def result_disposition(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of each order-bill outcome, and how grave it is."""
    counts = fixture_chain(spark, d).flow_order_bill.groupBy("result").agg(F.count(F.lit(1)).alias("row_count"))
    what = rollup.disposition("result", ["单号应收金额一致", "单号实收金额一致"], ["单号一致金额差异"], ["仅订单", "仅账单"])
    return counts.select("result", "row_count", what.alias("disposition"), rollup.severity("result").alias("severity"))


def safe_ratios(spark: SparkSession, d: str) -> DataFrame:
    """Ratios that are null, or 0, where the denominator is 0 or near it."""
    items = views(spark, d)["fx_item"].groupBy("order_no").agg(F.sum("amount").alias("amount"), F.sum("quantity").alias("quantity"))
    price = F.try_divide(F.col("amount").cast("double"), F.col("quantity"))
    return items.select("order_no", price.alias("price_or_null"), F.coalesce(price, F.lit(0.0)).alias("price_or_zero"), F.when(F.abs("amount") > 0, F.col("quantity").cast("double") / F.col("amount")).alias("per_cent"))


def period_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Orders by month, quarter and year."""
    orders = table(spark, d, "orders").select(F.col("o_orderdate").cast("timestamp").alias("day"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    return rollup.labelled_union({g: rollup.period_rollup(orders, "day", g, ["cents"]) for g in ("month", "quarter", "year")}, "grain")


def chain_controls(c: Chain) -> DataFrame:
    """Control totals of the full chain as metric and value."""
    c.settle("order_platform", "bill_platform", "sap_key")
    matched = F.col("result").isin("单号金额一致", "单号一致金额差异")
    n = F.count(F.lit(1))
    parts = [
        c.order_platform.agg(n.alias("platform_orders"), F.sum("order_amount").alias("order_amount")),
        c.bill_platform.agg(n.alias("bill_orders"), F.sum("bill_receivable").alias("bill_receivable"), F.sum("bill_cash").alias("bill_cash")),
        c.order_bill_recon.where(matched).agg(n.alias("matched_orders"), F.sum("order_amount").alias("matched_order_amount"), F.sum("bill_receivable").alias("matched_bill_amount")),
        c.bill_summary_recon.agg(n.alias("summary_groups"), F.count_if(F.col("result") == "一致").alias("summary_consistent_groups")),
        c.sap.agg(F.sum("invoice_qty").alias("sap_quantity"), F.sum("tax_amount").alias("sap_amount"), F.sum("row_count").alias("sap_rows")),
        c.v["fx_oms"].agg(F.sum("item_num").alias("oms_quantity"), F.sum("share_amount").alias("oms_amount"), n.alias("oms_rows")),
        c.oms_sap_recon.agg(F.sum("sap_qty").alias("key_sap_quantity"), F.sum("oms_qty").alias("key_oms_quantity"), F.sum("sap_amount").alias("key_sap_amount"), F.sum("oms_amount").alias("key_oms_amount"), F.count_if(F.col("result") == "数量金额一致").alias("exact_keys"), n.alias("total_keys")),
        c.v["fx_oms"].join(c.sap_key.select(F.col("oms_sales_no").alias("document_no")), "document_no", "left_anti").agg(F.sum("item_num").alias("pool_quantity"), F.sum("share_amount").alias("pool_amount"), n.alias("pool_rows")),
        c.v["fx_customer_map"].agg(n.alias("mapped_customers"), F.count_if(F.col("mapping_status") == "高置信").alias("high_confidence"), F.count_if(F.col("mapped_shop") == "").alias("unmapped")),
    ]
    return _tall(parts)


def recon_controls(spark: SparkSession, d: str) -> DataFrame:
    """Control totals of the full chain as metric and value."""
    return chain_controls(fixture_chain(spark, d))


def _tall(parts: list[DataFrame]) -> DataFrame:
    out = None
    for p in parts:
        one = rollup.tall(p)
        out = one if out is None else out.unionAll(one)
    return out


def chain_flow_controls(c: Chain) -> DataFrame:
    """Control totals of the period flow as metric and value."""
    c.settle("flow_shop_bill", "flow_oms_month", "flow_sap_month", "flow_billed_items")
    s = lambda **k: [F.sum(v).alias(n) for n, v in k.items()]
    mapped = F.coalesce("customer_code", F.lit("")) != ""
    return _tall([
        c.flow_order_bill.agg(F.count_if(F.col("order_count") > 0).alias("orders"), F.count_if(F.col("bill_rows") > 0).alias("bill_orders")),
        c.flow_monthly.agg(*s(order_qty="order_qty", order_amount="order_amount", sap_full_qty="sap_full_qty", sap_full_amount="sap_full_amount")),
        c.flow_shop_bill.agg(*s(bill_records="bill_records", bill_success_amount="bill_success_amount", bill_receivable="bill_receivable", bill_cash="bill_cash")),
        c.flow_oms_month.agg(*s(close_docs="oms_docs", close_qty="oms_qty", close_amount="oms_amount")),
        c.flow_sap_month.agg(*s(sap_assisted_qty="sap_qty", sap_assisted_amount="sap_amount")),
        c.flow_billed_items.agg(*s(billed_qty="order_bill_qty")),
        c.flow_shop_map.agg(F.sum(F.when(mapped, F.col("bill_receivable"))).alias("mapped_bill_amount"), F.sum(F.when(~mapped, F.col("bill_receivable"))).alias("unmapped_bill_amount")),
    ])


def flow_controls(spark: SparkSession, d: str) -> DataFrame:
    """Control totals of the period flow as metric and value."""
    return chain_flow_controls(fixture_chain(spark, d))


def chain_display_metrics(c: Chain) -> DataFrame:
    """Figures shown above the flow report, with coverage ratios, as metric and value."""
    r = F.col("result")
    order = c.flow_order_bill.agg(F.count(F.lit(1)).alias("order_groups"), F.count_if(r.isin("单号应收金额一致", "单号实收金额一致", "单号一致金额差异")).alias("order_key_matches"), F.count_if(r.isin("单号应收金额一致", "单号实收金额一致")).alias("order_amount_exact"))
    order = order.select("*", F.try_divide("order_key_matches", "order_groups").alias("order_key_coverage"))
    bill = c.flow_bill_oms.agg(F.count_if(r == "成功金额一致").alias("bill_exact_groups"), F.count(F.lit(1)).alias("bill_total_groups"), F.sum(F.abs("success_difference")).alias("bill_abs_success_difference"))
    grade = F.col("mapping_status")
    graded_sums = c.flow_shop_map.agg(*[F.sum(F.when(grade == label, F.col("bill_receivable"))).alias(f"mapping_{n}") for n, label in (("high", "高置信"), ("review", "待复核"), ("low", "低置信"), ("none", "未映射"))])
    common = r.isin("数量一致", "数量差异")
    qty = c.flow_qty_recon.agg(F.count_if(common).alias("qty_common_groups"), F.count_if(r == "数量一致").alias("qty_exact_groups"), F.sum(F.when(common, F.abs("qty_difference"))).alias("qty_abs_difference"), F.sum(F.when(r == "数量一致", F.col("oms_qty"))).alias("qty_exact"))
    return _tall([order, bill, graded_sums, qty])


def flow_display_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Figures shown above the flow report, with coverage ratios, as metric and value."""
    return chain_display_metrics(fixture_chain(spark, d))


def detail_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Row count of each exported detail."""
    c = fixture_chain(spark, d)
    names = ("flow_order_bill", "flow_bill_oms", "flow_qty_recon", "flow_field_map", "flow_shop_map")
    return rollup.labelled_union({n: getattr(c, n).agg(F.count(F.lit(1)).alias("row_count")) for n in names}, "detail")


def name_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Customer names against the shop names of the earlier mapping: normalised texts and block ratio."""
    pairs = table(spark, d, "wdt_oms_shop_map").select("customer_code", "customer_name", "wdt_shop").where("customer_name is not null and wdt_shop is not null")
    return pairs.select("customer_code", "wdt_shop", B.normalize_shop("customer_name").alias("customer"), B.normalize_shop("wdt_shop").alias("shop")).withColumn("name_score", sequence_ratio("customer", "shop"))


def customer_shop_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Best bill shop of each customer by name ratio, containment and platform, graded; below the last grade it is blanked."""
    return mapping.customer_shop_map(table(spark, d, "customer_shop_map"), table(spark, d, "huice_detail"))


def shop_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Customers against order shops: purchase profile (half), name (three tenths) and platform (a fifth)."""
    v = views(spark, d)
    return mapping.shop_candidates(v["fx_shop_map"], v["fx_item"], vector_cosine(spark, d))


def shop_map(spark: SparkSession, d: str) -> DataFrame:
    """The best candidate of each customer, graded."""
    return mapping.best_shops(shop_candidates(spark, d))


def mapping_averages(spark: SparkSession, d: str) -> DataFrame:
    """Customers and mean score of each grade of the shop map."""
    out = reports.mapping_averages(views(spark, d)["fx_shop_map"])
    return out.withColumn("avg_score", F.round("avg_score", 9))


def top_mappings(spark: SparkSession, d: str) -> DataFrame:
    """The thirty best scored mappings of customers to shops."""
    return reports.top_mappings(views(spark, d)["fx_shop_map"].select("customer_code", "wdt_shop", "total_score"))


def ranked_sales_days(spark: SparkSession, d: str) -> DataFrame:
    """The sample of the daily sales reconciliation: four ranks of results, then the greatest differences, at most 20,000 rows."""
    detail = next(x for x in reports.FAMILIES["items"] if x.step == "sales_day_recon")
    return reports.sample(fixture_chain(spark, d), detail).select("ship_date", "shop", "material_code", "customer_code", "amount_difference", "result")


def monthly_sheet(spark: SparkSession, d: str) -> DataFrame:
    """The months of the flow with a total row."""
    return reports.monthly_sheet(fixture_chain(spark, d))


def waterfall(spark: SparkSession, d: str) -> DataFrame:
    """Tiers of matching from the strictest to the loosest, with what each covers."""
    chain = fixture_chain(spark, d)
    chain.settle("order_platform", "sales_day_recon")
    return reports.waterfall(chain)


def report_registry(spark: SparkSession, d: str) -> DataFrame:
    """Every table that is handed out, with its family, place and sample limit."""
    return reports.registry(fixture_chain(spark, d))


def report_parameters(spark: SparkSession, d: str) -> DataFrame:
    """What the figures of the full report rest on."""
    return reports.parameters(fixture_chain(spark, d))


def report_columns(spark: SparkSession, d: str) -> DataFrame:
    """Names under which a report shows the columns of the shop map of the flow, in order."""
    detail = next(x for x in reports.FAMILIES["flow"] if x.step == "flow_shop_map")
    chain = fixture_chain(spark, d)
    shown = reports.displayed(reports.step(chain, detail.step), detail.omit)
    return spark.createDataFrame(list(enumerate(shown.columns, 1)), "place int, shown string")


_OWN = (
    scan_parse_number, month_extract, surrogate_key, business_month, net_measures, keep_first, keep_last, upsert_sum, run_length_orders, last_runs, semi_evidence, anti_uninvoiced, theta_tolerance_join,
    cross_candidates, expr_join_codes, top_shop, partition_totals, topk_abs_diff, exception_order, labelled_union, vector_cosine, platform_tokens, two_level_max_sum, composite_distinct, status_rollup,
    result_share, result_disposition, safe_ratios, period_rollup, recon_controls, flow_controls, flow_display_metrics, detail_manifest, name_ratio, customer_shop_candidates, shop_candidates, shop_map,
    mapping_averages, top_mappings, ranked_sales_days, monthly_sheet, waterfall, report_registry, report_parameters, report_columns,
)
QUERIES = {f.__name__: f for f in _OWN}
