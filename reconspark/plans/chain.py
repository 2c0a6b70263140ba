"""The reconciliation chain over its input views: orders, bills, order management, invoices, and what joins them.

Each step is a lazily built DataFrame; Catalyst and adaptive execution choose the joins. The tables come from
plans/ingest.py (raw inputs) or plans/fixtures.py (views for tests); amounts may be whole cents, doubles or decimals.
Tolerances and periods are the Scope's.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconspark.functions import business as B
from reconspark.operators.allocate import pro_rata
from reconspark.operators.dedup import prefer_filled, upsert_sum
from reconspark.operators.matching import best_match, bridge_vote
from reconspark.operators.recon import classify, two_sided, within
from reconspark.plans.fixtures import views
from reconspark.session import staged

METRICS = ("success_count", "success_amount", "mismatch_count", "mismatch_receivable", "mismatch_cash", "single_ar_count", "single_ar_amount", "single_cash_count", "single_cash_amount")
#: Order types and the business types they must meet.
TYPE_PAIRS = (("网店销售", "Y005"), ("分销订单", "Y051"), ("样品发货", "Z003"), ("退货损失", "Z004"), ("赠品", "Z001"), ("线下订单", "Z006"))


def _sums(**cols: str) -> list:
    return [F.sum(c).alias(n) for n, c in cols.items()]


def _zero(c: str):
    return F.coalesce(c, F.lit(0))


@dataclass(frozen=True)
class Scope:
    """Tolerances in the unit of the tables, the half-open period of the flow, and the span of months of the item steps.

    `year` and `months` name the summary files of the flow: the first of 1月 to `months`月 in a name, in that year.
    """

    money: float = 0.01
    count: float = 0.000001
    start: str = "2026-01-01"
    end: str = "2026-07-01"
    year: str = "2026"
    months: int = 6
    span: tuple[str, str] | None = ("2025-12", "2026-06")

    @property
    def flow_months(self) -> tuple[str, str]:
        """First and last month of the period."""
        return self.start[:7], (date.fromisoformat(self.end) - timedelta(days=1)).isoformat()[:7]


#: Of the fixture views: whole cents and quantities, all months.
FIXTURE_SCOPE = Scope(money=1, count=0, start="1996-01-01", end="1998-07-01", year="1997", span=None)


def fixture_chain(spark: SparkSession, d: str) -> Chain:
    """The chain over the fixture views of a data folder."""
    return Chain(spark, views(spark, d), FIXTURE_SCOPE)


class Chain:
    """All steps over one dict of tables: fx_order_file, fx_bill, fx_item, fx_product, fx_oms, fx_sap, fx_summary,
    fx_shop_map, fx_customer_map and, where they differ from what those hold, fx_order_line (items of an order without
    the guard on month and shop) and fx_current (current amounts of bills by reconcile_id).
    """

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame], scope: Scope):
        self.spark, self.v, self.scope = spark, tables, scope
        self.money, self.count, self._settled = scope.money, scope.count, set()

    def spanned(self, df: DataFrame, month: str) -> DataFrame:
        """The rows within the scope's span of months, all without one."""
        return df if self.scope.span is None else df.where(F.col(month).between(*self.scope.span))

    def settle(self, *names: str) -> None:
        """Stages steps that several later steps read, each once a chain, so that they are computed once."""
        for name in names:
            if name not in self._settled:
                self._settled.add(name)
                self.__dict__[name] = staged(getattr(self, name), name.replace("_", "-"))

    # Orders and bills

    @cached_property
    def order_dedup(self) -> DataFrame:
        """One record an order over overlapping files."""
        return prefer_filled(self.v["fx_order_file"], "order_no", ["platform_order_no", "shop", "receivable", "allocated", "quantity", "line_count"], ["trade_time", "payment_time"], ["ship_time"], "source_file")

    def _order_platform(self, orders: DataFrame) -> DataFrame:
        keyed = orders.withColumn("key", B.surrogate("platform_order_no", "__WDT__", "order_no")).withColumn("own", (F.col("platform_order_no") != "").cast("int"))
        month = B.business_month("payment_time", "trade_time")
        return keyed.groupBy(F.col("key").alias("platform_order_no")).agg(
            F.max("own").alias("matchable"), F.min("shop").alias("order_shop"), F.min(month).alias("order_month"), F.min(F.substring("ship_time", 1, 7)).alias("ship_month"), F.count(F.lit(1)).alias("order_count"),
            *_sums(order_amount="receivable", allocated_amount="allocated", order_qty="quantity"), F.array_join(F.array_sort(F.collect_list("order_no")), "|").alias("internal_orders"),
        )

    @cached_property
    def order_platform(self) -> DataFrame:
        """Orders by platform order; blank keys stay apart."""
        return self._order_platform(self.order_dedup)

    @cached_property
    def bill(self) -> DataFrame:
        """Bill records with derived measures: net with prior periods, current without."""
        ar, neg, cash, back = "ar", "neg_ar", "receipts", "refunds"
        df = self.v["fx_bill"].withColumns({
            "net_receivable": F.col(ar) + F.col("prior_ar") - F.col(neg) - F.col("prior_neg_ar"), "net_cash": F.col(cash) + F.col("prior_receipts") - F.col(back) - F.col("prior_refunds"),
            "current_receivable": F.col(ar) - F.col(neg), "current_cash": F.col(cash) - F.col(back), "bill_month": B.business_month("business_date", "period_end"),
        })
        return df.withColumn("computed_difference", F.col("net_receivable") - F.col("net_cash"))

    @cached_property
    def bill_current(self) -> DataFrame:
        """Bill records with their current amounts, which the table fx_current has by reconcile_id where there is one."""
        if "fx_current" not in self.v:
            return self.bill
        return self.bill.drop("current_receivable", "current_cash").join(self.v["fx_current"].select("reconcile_id", "current_receivable", "current_cash"), "reconcile_id")

    def _bill_platform(self, bills: DataFrame, receivable: str, cash: str) -> DataFrame:
        keyed = bills.withColumn("key", B.surrogate("platform_order_no", "__HC__", "reconcile_id"))
        return keyed.groupBy(F.col("key").alias("platform_order_no")).agg(
            F.min("platform").alias("platform"), F.min("shop").alias("bill_shop"), F.count(F.lit(1)).alias("bill_rows"), *_sums(bill_receivable=receivable, bill_cash=cash),
            F.min("bill_month").alias("bill_month"), F.array_join(F.array_sort(F.collect_list("reconcile_id")), "|").alias("reconcile_ids"),
        )

    @cached_property
    def bill_platform(self) -> DataFrame:
        """Bills by platform order."""
        return self._bill_platform(self.bill, "net_receivable", "net_cash")

    @cached_property
    def order_bill_recon(self) -> DataFrame:
        """Orders against bills, four outcomes and one for blank keys."""
        both = two_sided(self.order_platform, self.bill_platform, ["platform_order_no"], {"order_shop": "", "order_month": "", "order_count": 0, "order_amount": 0, "allocated_amount": 0, "order_qty": 0, "internal_orders": "", "matchable": 1})
        result = classify([
            (~F.col("in_left"), "仅惠策"), (~F.col("in_right") & (F.col("matchable") == 0), "旺店通原始单号为空"), (~F.col("in_right"), "仅旺店通"), (within("order_amount", "bill_receivable", self.money), "单号金额一致"),
        ], "单号一致金额差异")
        return both.select("platform_order_no", "matchable", "order_shop", "platform", "bill_shop", "order_month", "bill_month", "order_count", "bill_rows", "order_amount", "allocated_amount", "bill_receivable", "bill_cash", (F.col("order_amount") - F.col("bill_receivable")).alias("amount_difference"), "order_qty", "internal_orders", "reconcile_ids", result.alias("result"))

    # Summaries

    @cached_property
    def bill_rebuilt_summary(self) -> DataFrame:
        """The shop summary rebuilt from bill records by conditional sums, dated the day after the period's end."""
        ok, off = F.col("reconcile_result").contains("成功"), F.col("reconcile_result").contains("不一致")
        ar_only = (F.abs("net_receivable") > 0) & (F.abs("net_cash") == 0)
        cash_only = (F.abs("net_cash") > 0) & (F.abs("net_receivable") == 0)
        count = lambda c: F.count_if(c)
        total = lambda c, m: F.sum(F.when(c, F.col(m)).otherwise(0))
        aggs = (count(ok), total(ok, "net_receivable"), count(off), total(off, "net_receivable"), total(off, "net_cash"), count(ar_only), total(ar_only, "net_receivable"), count(cash_only), total(cash_only, "net_cash"))
        return self.bill.groupBy(B.next_day("period_end").alias("reconcile_date"), "platform", "shop").agg(*[a.alias(m) for a, m in zip(aggs, METRICS, strict=True)])

    @cached_property
    def bill_summary_recon(self) -> DataFrame:
        """Given against rebuilt summary in nine metrics; a summary without records is a difference, as null comparisons are."""
        keys = ["reconcile_date", "platform", "shop"]
        given = self.v["fx_summary"].groupBy(*keys).agg(*[F.sum(m).alias(f"source_{m}") for m in METRICS])
        both = two_sided(given, self.bill_rebuilt_summary.withColumnsRenamed({m: f"rebuilt_{m}" for m in METRICS}), keys, {f"source_{m}": 0 for m in METRICS})
        same = None
        for m in METRICS:
            ok = within(f"source_{m}", f"rebuilt_{m}", self.count if m.endswith("count") else self.money)
            same = ok if same is None else same & ok
        columns = [x for m in METRICS for x in (F.col(f"source_{m}"), F.col(f"rebuilt_{m}"), (F.col(f"source_{m}") - F.col(f"rebuilt_{m}")).alias(f"diff_{m}"))]
        return both.select(*keys, *columns, classify([(~F.col("in_left"), "仅明细重建"), (same, "一致")], "差异").alias("result"))

    @cached_property
    def bill_internal_recon(self) -> DataFrame:
        """Bill records against shop summaries by month and shop; receivable and cash must both agree."""
        keys = ["month", "platform", "shop"]
        detail = self.bill.groupBy(F.substring("period_end", 1, 7).alias("month"), "platform", "shop").agg(F.count(F.lit(1)).alias("detail_rows"), *_sums(detail_receivable="net_receivable", detail_cash="net_cash"))
        given = self.v["fx_summary"].groupBy(F.substring("reconcile_date", 1, 7).alias("month"), "platform", "shop").agg(*[F.sum(m).alias(m) for m in METRICS])
        both = two_sided(detail, given, keys, {c: 0 for c in ("detail_rows", "detail_receivable", "detail_cash", *METRICS)})
        receivable = F.col("detail_receivable") - (F.col("success_amount") + F.col("mismatch_receivable") + F.col("single_ar_amount"))
        cash = F.col("detail_cash") - (F.col("success_amount") + F.col("mismatch_cash") + F.col("single_cash_amount"))
        result = classify([(~F.col("in_left"), "仅店铺汇总"), (~F.col("in_right"), "仅明细重建"), ((F.abs(receivable) <= self.money) & (F.abs(cash) <= self.money), "金额一致")], "金额差异")
        return both.select(*keys, "detail_rows", "detail_receivable", "detail_cash", *METRICS, receivable.alias("receivable_difference"), cash.alias("cash_difference"), result.alias("result"))

    # Order management and invoices

    @cached_property
    def sap(self) -> DataFrame:
        """Invoice lines with repeated keys summed."""
        return upsert_sum(self.v["fx_sap"], ["file_month", "oms_sales_no", "material_code", "sales_unit", "sap_invoice_no"], ["invoice_qty", "tax_amount"])

    @cached_property
    def sap_key(self) -> DataFrame:
        """Invoices by document, material and unit, with the list of invoice numbers."""
        return self.sap.groupBy("oms_sales_no", "material_code", "sales_unit").agg(
            *_sums(sap_qty="invoice_qty", sap_amount="tax_amount", sap_rows="row_count"), F.min("file_month").alias("file_month"), F.array_join(F.array_sort(F.collect_set("sap_invoice_no")), ",").alias("sap_invoice_nos")
        )

    def _oms_key(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("document_no").alias("oms_sales_no"), F.col("item_code").alias("material_code"), F.col("sale_unit").alias("sales_unit")).agg(
            *_sums(oms_qty="item_num", oms_amount="share_amount"), F.count(F.lit(1)).alias("oms_rows"), F.min("outbound_month").alias("outbound_month"), F.min("customer_code").alias("customer_code"), F.min("customer_name").alias("customer_name")
        )

    @cached_property
    def oms_sap_recon(self) -> DataFrame:
        """Invoices against order management by line key; its own side only for documents that have invoices."""
        keys = ["oms_sales_no", "material_code", "sales_unit"]
        documents = self.sap_key.select("oms_sales_no").distinct()
        oms = self._oms_key(self.v["fx_oms"]).drop("customer_code", "customer_name").join(documents, "oms_sales_no", "left_semi")
        both = two_sided(self.sap_key, oms, keys, {"file_month": "", "sap_invoice_nos": "", "sap_rows": 0, "sap_qty": 0, "sap_amount": 0})
        same_qty = within("oms_qty", "sap_qty", self.count)
        result = classify([(~F.col("in_right"), "仅SAP"), (~F.col("in_left"), "仅OMS"), (same_qty & within("oms_amount", "sap_amount", self.money), "数量金额一致"), (same_qty, "数量一致金额差异")], "数量金额差异")
        return both.select(*keys, "file_month", "outbound_month", "sap_invoice_nos", "sap_rows", "oms_rows", "sap_qty", "oms_qty", (F.col("oms_qty") - F.col("sap_qty")).alias("quantity_difference"), "sap_amount", "oms_amount", (F.col("oms_amount") - F.col("sap_amount")).alias("amount_difference"), result.alias("result"))

    @cached_property
    def uninvoiced_pool_recon(self) -> DataFrame:
        """Order management without invoice, by month and mapped shop, against the shop's bills."""
        documents = self.sap_key.select(F.col("oms_sales_no").alias("document_no")).where("document_no <> ''").distinct()
        pool = self.v["fx_oms"].join(documents, "document_no", "left_anti").join(self.v["fx_customer_map"].select("customer_code", "mapped_platform", "mapped_shop", "mapping_status", "match_score"), "customer_code", "left")
        pool = pool.groupBy("outbound_month", "mapped_platform", "mapped_shop", "mapping_status", "match_score", "customer_code").agg(F.min("customer_name").alias("customer_name"), *_sums(oms_qty="item_num", oms_amount="share_amount"), F.count(F.lit(1)).alias("oms_rows"))
        bills = self.bill.groupBy(F.col("bill_month").alias("outbound_month"), F.col("platform").alias("mapped_platform"), F.col("shop").alias("mapped_shop")).agg(*_sums(bill_receivable="net_receivable", bill_cash="net_cash"), F.count(F.lit(1)).alias("bill_rows"))
        both = pool.join(bills, ["outbound_month", "mapped_platform", "mapped_shop"], "left")
        result = classify([(F.col("mapped_shop").isNull() | (F.col("mapped_shop") == ""), "店铺未映射"), (F.col("bill_rows").isNull(), "仅OMS"), (within("oms_amount", "bill_receivable", self.money), "金额一致")], "金额差异")
        return both.select("outbound_month", "mapped_platform", "mapped_shop", "customer_code", "customer_name", "mapping_status", "match_score", "oms_rows", "oms_qty", "oms_amount", _zero("bill_rows").alias("bill_rows"), _zero("bill_receivable").alias("bill_receivable"), _zero("bill_cash").alias("bill_cash"), (F.col("oms_amount") - _zero("bill_receivable")).alias("amount_difference"), result.alias("result"))

    # Items

    @cached_property
    def product_code_best(self) -> DataFrame:
        """The SAP code that a product code appears with most often."""
        counted = self.v["fx_product"].groupBy("product_code", "sap_code").agg(F.sum("occurrences").alias("n"))
        return best_match(counted, ["product_code"], [F.desc("n"), F.asc("sap_code")])

    @cached_property
    def item_resolved(self) -> DataFrame:
        """Items with product codes replaced by their best SAP code, rolled up."""
        items = self.spanned(self.v["fx_item"], "ship_month").withColumn("product_code", F.substring("material_key", 5, 100))
        joined = items.join(self.product_code_best.select("product_code", F.col("sap_code").alias("best")), "product_code", "left")
        material = F.when(F.col("material_key").ilike("SKU:%"), F.coalesce("best", "material_key")).otherwise(F.col("material_key"))
        return joined.groupBy("ship_date", "ship_month", "shop", material.alias("material_code"), "unit", "order_type").agg(*_sums(quantity="quantity", amount="amount"), F.count(F.lit(1)).alias("line_count"))

    def _item_recon(self, grain: str, sales_only: bool = False) -> DataFrame:
        """Order items against daily closes at a grain, through the customer-shop map (which may fan out)."""
        month = grain == "ship_month"
        items = self.item_resolved if month else self.item_resolved.where("ship_date <> ''")
        items = items.where("order_type = '网店销售'") if sales_only else items
        w = items.groupBy(grain, "shop", "material_code").agg(*_sums(order_qty="quantity", order_amount="amount", order_lines="line_count"))
        shop_map = self.v["fx_shop_map"]
        w = w.join(shop_map.withColumnsRenamed({"wdt_shop": "shop"}), "shop", "left")
        o = self.v["fx_oms"].where("business_type = 'Y005'").groupBy(F.col("outbound_month" if month else "outbound_date").alias(grain), "customer_code", F.col("item_code").alias("material_code")).agg(
            F.min("customer_name").alias("o_name"), *_sums(oms_qty="item_num", oms_amount="share_amount"), F.countDistinct("document_no").alias("oms_docs"), F.count(F.lit(1)).alias("oms_lines")
        )
        o = o.join(shop_map.select("customer_code", F.col("wdt_shop").alias("o_shop"), F.col("total_score").alias("o_score"), F.col("mapping_status").alias("o_status")), "customer_code")
        both = two_sided(w, o, [grain, "customer_code", "material_code"], {"order_qty": 0, "order_amount": 0, "order_lines": 0})
        pick = lambda a, b: F.when(F.col("in_left"), F.col(a)).otherwise(F.col(b)).alias(a)
        both_same = within("oms_qty", "order_qty", self.count), within("oms_amount", "order_amount", self.money)
        cases = [(~F.col("in_left"), "仅OMS"), (~F.col("in_right"), "仅旺店通"), (both_same[0] & both_same[1], "数量金额一致")]
        cases += [(both_same[1], "金额一致数量差异")] if sales_only else []
        result = classify([*cases, (both_same[0], "数量一致金额差异")], "数量金额差异")
        return both.select(grain, pick("shop", "o_shop"), "customer_code", pick("customer_name", "o_name"), "material_code", "order_qty", "order_amount", "order_lines", "oms_qty", "oms_amount", "oms_docs", "oms_lines", pick("total_score", "o_score"), pick("mapping_status", "o_status"), (_zero("oms_qty") - F.col("order_qty")).alias("qty_difference"), (_zero("oms_amount") - F.col("order_amount")).alias("amount_difference"), result.alias("result"))

    @cached_property
    def item_month_recon(self) -> DataFrame:
        """Items by month."""
        return self._item_recon("ship_month")

    @cached_property
    def item_day_recon(self) -> DataFrame:
        """Items by day."""
        return self._item_recon("ship_date")

    @cached_property
    def sales_day_recon(self) -> DataFrame:
        """Sold items by day; equal amounts are tested before equal quantities."""
        return self._item_recon("ship_date", sales_only=True)

    @cached_property
    def shop_month_recon(self) -> DataFrame:
        """The monthly item reconciliation rolled up by shop, judged on the sums."""
        groups = ["ship_month", "shop", "customer_code", "customer_name", "mapping_status", "total_score"]
        rolled = self.item_month_recon.groupBy(*groups).agg(*[F.sum(c).alias(c) for c in ("order_qty", "oms_qty", "qty_difference", "order_amount", "oms_amount", "amount_difference")], F.count_if(F.col("result") == "数量金额一致").alias("exact_item_groups"), F.count(F.lit(1)).alias("item_groups"))
        same_qty = F.abs("qty_difference") <= self.count
        return rolled.withColumn("result", classify([(same_qty & (F.abs("amount_difference") <= self.money), "店铺月度数量金额一致"), (same_qty, "店铺月度数量一致金额差异")], "店铺月度差异"))

    @cached_property
    def order_type_coverage(self) -> DataFrame:
        """How much of each order type has an exactly equal counterpart of the business type it must meet."""
        pairs = self.spark.createDataFrame(TYPE_PAIRS, "order_type string, business_type string")
        w = self.item_resolved.where("ship_date <> ''").groupBy(F.col("ship_date").alias("day"), "order_type", F.col("material_code").alias("item")).agg(*_sums(qty="quantity", amount="amount"))
        w = staged(w, "order-types")
        o = self.v["fx_oms"].groupBy(F.col("outbound_date").alias("day"), "business_type", F.col("item_code").alias("item")).agg(*_sums(o_qty="item_num", o_amount="share_amount"))
        exact = pairs.join(w, "order_type").join(o, ["business_type", "day", "item"]).where(within("o_qty", "qty", self.count) & within("o_amount", "amount", self.money))
        exact = exact.groupBy("order_type", "business_type").agg(F.count("item").alias("exact_groups"), *_sums(exact_qty="qty", exact_amount="amount"))
        totals = w.groupBy("order_type").agg(*_sums(order_qty="qty", order_amount="amount"))
        out = pairs.join(totals, "order_type").join(exact, ["order_type", "business_type"], "left").fillna(0, ["exact_groups", "exact_qty", "exact_amount"])
        return out.select("order_type", "business_type", "order_qty", "order_amount", "exact_groups", "exact_qty", "exact_amount", F.try_divide("exact_qty", "order_qty").alias("qty_coverage"), F.when(F.abs("order_amount") > 0, F.try_divide("exact_amount", "order_amount")).alias("amount_coverage"))

    @cached_property
    def sales_controls(self) -> DataFrame:
        """Linked, exact and covered groups of the sales reconciliation in one row."""
        near_amount, near_qty = F.abs("amount_difference") <= self.money, F.abs("qty_difference") <= self.count
        linked = F.col("oms_qty").isNotNull()
        out = self.sales_day_recon.where("order_qty > 0").agg(
            F.count(F.lit(1)).alias("order_groups"), *_sums(order_qty="order_qty", order_amount="order_amount"), F.count_if(linked).alias("linked_groups"), F.count_if(linked & near_amount).alias("amount_exact_groups"),
            F.sum(F.when(near_amount, F.col("order_amount")).otherwise(0)).alias("amount_exact"), F.sum(F.when(near_qty, F.col("order_qty")).otherwise(0)).alias("qty_exact"),
        )
        return out.select("*", F.try_divide("amount_exact", "order_amount").alias("amount_coverage"), F.try_divide("qty_exact", "order_qty").alias("qty_coverage"))

    # Bridge and allocation

    @cached_property
    def bill_order_month(self) -> DataFrame:
        """Current bill amounts by month, shop and platform order."""
        return self.spanned(self.bill_current, "bill_month").where("platform_order_no <> ''").groupBy("bill_month", "platform", F.col("shop").alias("bill_shop"), "platform_order_no").agg(*_sums(bill_receivable="current_receivable", bill_cash="current_cash"), F.count(F.lit(1)).alias("bill_rows"))

    @cached_property
    def order_item(self) -> DataFrame:
        """Items by order, material and unit, with codes resolved."""
        items = self.v.get("fx_order_line", self.v["fx_item"]).withColumn("product_code", F.substring("material_key", 5, 100)).join(self.product_code_best.select("product_code", F.col("sap_code").alias("best")), "product_code", "left")
        material = F.when(F.col("material_key").ilike("SKU:%"), F.coalesce("best", "material_key")).otherwise(F.col("material_key"))
        return items.groupBy("order_no", material.alias("material_code"), "unit").agg(*_sums(item_qty="quantity", item_amount="amount"), F.count(F.lit(1)).alias("item_lines"))

    @cached_property
    def platform_order_item(self) -> DataFrame:
        """Items by platform order."""
        orders = self.order_dedup.where("platform_order_no <> ''").select("order_no", "platform_order_no", F.substring("ship_time", 1, 7).alias("ship_month"), F.col("shop").alias("order_shop"))
        return self.spanned(orders, "ship_month").join(self.order_item, "order_no").groupBy("platform_order_no", "ship_month", "order_shop", "material_code", "unit").agg(*[F.sum(c).alias(c) for c in ("item_qty", "item_amount", "item_lines")])

    @cached_property
    def shop_bridge(self) -> DataFrame:
        """For each bill shop the order shop that shares most orders, with its share of the votes."""
        shared = self.bill_order_month.join(self.platform_order_item, "platform_order_no").groupBy("platform", "bill_shop", "order_shop").agg(F.countDistinct("platform_order_no").alias("matched_orders"), F.sum(F.abs("bill_receivable")).alias("matched_receivable"))
        return bridge_vote(shared, ["platform", "bill_shop"], "order_shop", "matched_orders", "matched_receivable").select("platform", "bill_shop", "order_shop", "matched_orders", "total_orders", "bridge_share", "bridge_status")

    @cached_property
    def bill_customer_map(self) -> DataFrame:
        """The bridge chained with the customer map; both grades decide."""
        m = self.v["fx_shop_map"].select(F.col("wdt_shop").alias("order_shop"), "customer_code", "customer_name", F.col("total_score").alias("map_score"), F.col("mapping_status").alias("map_status"))
        final = classify([((F.col("bridge_status") == "高置信") & (F.col("map_status") == "高置信"), "高置信"), (F.col("customer_code").isNotNull() & (F.col("bridge_status") != "低置信") & (F.col("map_status") != "低置信"), "待复核")], "低置信")
        return self.shop_bridge.join(m, "order_shop", "left").select("platform", "bill_shop", "order_shop", "customer_code", "customer_name", "map_score", "bridge_share", "bridge_status", "map_status", final.alias("final_status"))

    @cached_property
    def bill_item_alloc(self) -> DataFrame:
        """Bill amounts of each order spread over its items by amount, else quantity, else evenly."""
        return pro_rata(self.bill_order_month, self.platform_order_item, "platform_order_no", "item_amount", "item_qty", {"allocated_receivable": "bill_receivable", "allocated_cash": "bill_cash"})

    @cached_property
    def bill_material_month(self) -> DataFrame:
        """Allocated bills by month, shop and material, with the mapped customer."""
        self.settle("platform_order_item", "bill_order_month")
        m = self.bill_customer_map.select("platform", "bill_shop", "order_shop", "customer_code", "customer_name", "final_status")
        joined = self.bill_item_alloc.join(m, ["platform", "bill_shop", "order_shop"], "left")
        return joined.groupBy("bill_month", "platform", "bill_shop", "material_code").agg(
            F.min("customer_code").alias("customer_code"), F.min("customer_name").alias("customer_name"), F.min("final_status").alias("mapping_status"), F.round(F.sum("allocated_receivable"), 4).alias("bill_receivable"), F.round(F.sum("allocated_cash"), 4).alias("bill_cash"),
            F.sum("item_qty").alias("bridge_qty"), F.countDistinct("platform_order_no").alias("mapped_orders"), F.sum("bill_rows").alias("bill_rows"),
        )

    @cached_property
    def bill_oms_item_recon(self) -> DataFrame:
        """Allocated bills against daily closes by month, customer and material; receivable is tested before cash."""
        keys = ["bill_month", "customer_code", "material_code"]
        o = self.v["fx_oms"].where("business_type = 'Y005'").groupBy(F.col("outbound_month").alias("bill_month"), "customer_code", F.col("item_code").alias("material_code")).agg(F.min("customer_name").alias("o_name"), *_sums(oms_qty="item_num", oms_amount="share_amount"), F.countDistinct("document_no").alias("oms_docs"))
        fill = {"platform": "", "bill_shop": "", "mapping_status": "未映射OMS", "bill_receivable": 0.0, "bill_cash": 0.0, "bridge_qty": 0, "mapped_orders": 0, "bill_rows": 0, "oms_qty": 0, "oms_amount": 0, "oms_docs": 0}
        both = two_sided(self.bill_material_month, o, keys, fill)
        result = classify([(~F.col("in_left"), "仅OMS"), (~F.col("in_right"), "仅惠策"), (within("oms_amount", "bill_receivable", self.money), "应收金额一致"), (within("oms_amount", "bill_cash", self.money), "实收金额一致")], "金额差异")
        return both.select("bill_month", "platform", "bill_shop", "customer_code", F.when(F.col("in_left"), F.col("customer_name")).otherwise(F.col("o_name")).alias("customer_name"), "mapping_status", "material_code", "bill_receivable", "bill_cash", "bridge_qty", "mapped_orders", "bill_rows", "oms_qty", "oms_amount", "oms_docs", F.round(F.col("oms_amount") - F.col("bill_receivable"), 4).alias("receivable_difference"), F.round(F.col("oms_amount") - F.col("bill_cash"), 4).alias("cash_difference"), result.alias("result"))

    @cached_property
    def bill_oms_shop_recon(self) -> DataFrame:
        """The same rolled up by shop and month, judged on the summed differences."""
        groups = ["bill_month", "platform", "bill_shop", "customer_code", "customer_name", "mapping_status"]
        whole = ("bridge_qty", "oms_qty", "oms_amount", "mapped_orders", "bill_rows", "oms_docs")
        rolled = self.bill_oms_item_recon.groupBy(*groups).agg(*[F.sum(F.col(c).cast("decimal(28,4)")).cast("double").alias(c) for c in ("bill_receivable", "bill_cash", "receivable_difference", "cash_difference")], *[F.sum(c).alias(c) for c in whole])
        return rolled.withColumn("result", classify([(F.abs("receivable_difference") <= self.money, "店铺月度应收一致"), (F.abs("cash_difference") <= self.money, "店铺月度实收一致")], "店铺月度差异"))

    @cached_property
    def bridge_coverage(self) -> DataFrame:
        """How many order-months and how much of their amounts reach an item; the maximum per order undoes the fan-out."""
        keys = ["bill_month", "platform", "bill_shop", "platform_order_no"]
        mapped = self.bill_item_alloc.groupBy(*keys).agg(F.max("bill_receivable").alias("r"), F.max("bill_cash").alias("c"))
        a = self.bill_order_month.agg(F.count(F.lit(1)).alias("order_months"), *_sums(receivable="bill_receivable", cash="bill_cash"))
        b = mapped.agg(F.count(F.lit(1)).alias("mapped_order_months"), *_sums(mapped_receivable="r", mapped_cash="c"))
        one = a.crossJoin(b)
        return one.select("*", *[F.coalesce(F.try_divide(x, y), F.lit(0.0)).alias(n) for n, x, y in (("order_mapping_rate", "mapped_order_months", "order_months"), ("receivable_mapping_rate", "mapped_receivable", "receivable"), ("cash_mapping_rate", "mapped_cash", "cash"))])

    # The period flow

    def _in_period(self, df: DataFrame, date) -> DataFrame:
        return df.where((date >= F.lit(self.scope.start)) & (date < F.lit(self.scope.end)))

    @cached_property
    def flow_order_bill(self) -> DataFrame:
        """Orders against current bills within the period, six outcomes: receivable, then cash."""
        orders = self._order_platform(self._in_period(self.order_dedup, F.col("ship_time"))).drop("order_month")
        bills = self._bill_platform(self._in_period(self.bill_current, F.coalesce(F.nullif("business_date", F.lit("")), "period_end")), "current_receivable", "current_cash")
        fill = {"order_shop": "", "ship_month": "", "order_count": 0, "order_amount": 0, "allocated_amount": 0, "order_qty": 0, "internal_orders": "", "matchable": 1, "bill_rows": 0, "bill_receivable": 0, "bill_cash": 0, "reconcile_ids": ""}
        both = two_sided(orders, bills, ["platform_order_no"], fill)
        result = classify([
            (~F.col("in_left"), "仅账单"), (~F.col("in_right") & (F.col("matchable") == 0), "旺店通原始单号为空"), (~F.col("in_right"), "仅订单"),
            (within("order_amount", "bill_receivable", self.money), "单号应收金额一致"), (within("order_amount", "bill_cash", self.money), "单号实收金额一致"),
        ], "单号一致金额差异")
        return both.select("platform_order_no", "matchable", "order_shop", "platform", "bill_shop", "ship_month", "bill_month", "order_count", "bill_rows", "order_qty", "order_amount", "allocated_amount", "bill_receivable", "bill_cash", (F.col("order_amount") - F.col("bill_receivable")).alias("receivable_difference"), (F.col("order_amount") - F.col("bill_cash")).alias("cash_difference"), "internal_orders", "reconcile_ids", result.alias("result"))

    @cached_property
    def flow_shop_bill(self) -> DataFrame:
        """Shop summaries by the month that their file name states first."""
        month = B.first_month("source_file", self.scope.year, self.scope.months)
        s = self.v["fx_summary"].withColumn("bill_month", month).where("bill_month is not null")
        return s.groupBy("bill_month", "platform", F.col("shop").alias("bill_shop")).agg(
            F.sum(F.col("success_count") + F.col("mismatch_count") + F.col("single_ar_count") + F.col("single_cash_count")).alias("bill_records"), *_sums(success_count="success_count", bill_success_amount="success_amount"),
            F.sum(F.col("success_amount") + F.col("mismatch_receivable") + F.col("single_ar_amount")).alias("bill_receivable"), F.sum(F.col("success_amount") + F.col("mismatch_cash") + F.col("single_cash_amount")).alias("bill_cash"), F.count(F.lit(1)).alias("source_rows"),
        )

    @cached_property
    def flow_shop_map(self) -> DataFrame:
        """The customer of each billed shop: by the order bridge, else by the same shop name. The bridge's grade masks the other's."""
        m = self.bill_customer_map.select("platform", "bill_shop", F.col("customer_code").alias("m_code"), F.col("customer_name").alias("m_name"), "final_status")
        direct = self.v["fx_shop_map"].select(F.col("same_name").alias("bill_shop"), F.col("customer_code").alias("d_code"), F.col("customer_name").alias("d_name"), F.col("mapping_status").alias("d_status"))
        both = self.flow_shop_bill.join(m, ["platform", "bill_shop"], "left").join(direct, "bill_shop", "left")
        status = F.coalesce("final_status", F.when(F.col("d_code").isNotNull(), F.col("d_status")).otherwise("未映射"))
        source = classify([(F.col("m_code").isNotNull(), "订单桥接映射"), (F.col("d_code").isNotNull(), "同名店铺映射")], "未映射")
        return both.select("bill_month", "platform", "bill_shop", F.coalesce("m_code", "d_code").alias("customer_code"), F.coalesce("m_name", "d_name").alias("customer_name"), status.alias("mapping_status"), source.alias("mapping_source"), "bill_records", "success_count", "bill_success_amount", "bill_receivable", "bill_cash", "source_rows")

    @cached_property
    def _month_close(self) -> DataFrame:
        return self._in_period(self.v["fx_oms"].where("business_type = 'Y001'"), F.col("outbound_date"))

    @cached_property
    def flow_oms_month(self) -> DataFrame:
        """Month closes by customer."""
        return self._month_close.groupBy("outbound_month", "customer_code").agg(F.min("customer_name").alias("customer_name"), F.countDistinct("document_no").alias("oms_docs"), *_sums(oms_qty="item_num", oms_amount="share_amount"), F.count(F.lit(1)).alias("oms_lines"))

    @cached_property
    def flow_field_map(self) -> DataFrame:
        """Invoices and month closes filling each other's gaps by line key; only the invoice side is limited by period."""
        keys = ["oms_sales_no", "material_code", "sales_unit"]
        r = self.oms_sap_recon.withColumnsRenamed({"outbound_month": "r_month", "oms_qty": "r_qty", "oms_amount": "r_amount", "oms_rows": "r_rows", "result": "source_result"})
        fill = {"file_month": "", "sap_invoice_nos": "", "sap_rows": 0, "sap_qty": 0, "sap_amount": 0, "source_result": "仅OMS"}
        both = two_sided(r, self._oms_key(self._month_close), keys, fill)
        own = ~F.col("in_left")
        month = F.coalesce("outbound_month", "file_month")
        both = both.where(own | month.between(*self.scope.flow_months))
        either = lambda close, other: F.coalesce(close, other)
        result = classify([(own, "仅OMS月结"), (~F.col("in_right"), "SAP补数量金额"), (F.col("source_result") == "数量金额一致", "双向字段一致"), (F.abs("quantity_difference") <= self.count, "数量一致金额差异")], "数量金额差异")
        diff = lambda d, close: F.when(own, F.col(close)).otherwise(F.col(d)).alias(d)
        return both.select(*keys, "file_month", "outbound_month", "sap_invoice_nos", "customer_code", "customer_name", "sap_rows", F.when(own, F.col("oms_rows")).otherwise(F.col("r_rows")).alias("oms_rows"), "sap_qty", either("oms_qty", "r_qty").alias("oms_qty"), diff("quantity_difference", "oms_qty"), "sap_amount", either("oms_amount", "r_amount").alias("oms_amount"), diff("amount_difference", "oms_amount"), either("oms_qty", "sap_qty").alias("mapped_qty"), either("oms_amount", "sap_amount").alias("mapped_amount"), result.alias("mapping_result"), "source_result")

    @cached_property
    def flow_sap_month(self) -> DataFrame:
        """Invoices mapped to a customer, by month."""
        return self.flow_field_map.where("customer_code <> ''").groupBy("outbound_month", "customer_code").agg(F.min("customer_name").alias("customer_name"), F.countDistinct("oms_sales_no").alias("mapped_docs"), *_sums(sap_qty="sap_qty", sap_amount="sap_amount", mapped_oms_qty="oms_qty", mapped_oms_amount="oms_amount"), F.count_if(F.col("mapping_result") == "双向字段一致").alias("exact_keys"), F.count(F.lit(1)).alias("mapped_keys"))

    @cached_property
    def flow_bill_oms(self) -> DataFrame:
        """Billed shops against month closes, helped by invoices; outcomes in a fixed order of preference."""
        keys = ["bill_month", "customer_code"]
        closes = self.flow_oms_month.drop("oms_lines").withColumnsRenamed({"outbound_month": "bill_month", "customer_name": "o_name"})
        fill = {"platform": "", "bill_shop": "", "mapping_status": "OMS侧未对应", "mapping_source": "OMS客户", "bill_records": 0, "success_count": 0, "bill_success_amount": 0, "bill_receivable": 0, "bill_cash": 0, "oms_docs": 0, "oms_qty": 0, "oms_amount": 0}
        both = two_sided(self.flow_shop_map.drop("source_rows"), closes, keys, fill)
        invoices = self.flow_sap_month.select(F.col("outbound_month").alias("bill_month"), "customer_code", F.col("sap_qty").alias("s_qty"), F.col("sap_amount").alias("s_amount"))
        both = both.join(invoices, keys, "left").withColumns({"sap_assisted_qty": _zero("s_qty"), "sap_assisted_amount": _zero("s_amount")})
        result = classify([
            (~F.col("in_left"), "仅OMS月结"), (F.col("customer_code").isNull() | (F.col("customer_code") == ""), "店铺未映射"), (~F.col("in_right"), "仅账单"),
            (within("oms_amount", "bill_success_amount", self.money), "成功金额一致"), (within("oms_amount", "bill_receivable", self.money), "应收金额一致"), (within("oms_amount", "bill_cash", self.money), "实收金额一致"),
            (within("sap_assisted_amount", "bill_success_amount", self.money), "SAP辅助金额一致"),
        ], "金额差异")
        return both.select("bill_month", "platform", "bill_shop", "customer_code", F.when(F.col("in_left"), F.col("customer_name")).otherwise(F.col("o_name")).alias("customer_name"), "mapping_status", "mapping_source", "bill_records", "success_count", "bill_success_amount", "bill_receivable", "bill_cash", "oms_docs", "oms_qty", "oms_amount", "sap_assisted_qty", "sap_assisted_amount", *[(F.col("oms_amount") - F.col(c)).alias(n) for n, c in (("success_difference", "bill_success_amount"), ("receivable_difference", "bill_receivable"), ("cash_difference", "bill_cash"))], (F.col("sap_assisted_amount") - F.col("bill_success_amount")).alias("sap_success_difference"), result.alias("result"))

    @cached_property
    def flow_billed_items(self) -> DataFrame:
        """Items of orders that some bill of the period proves."""
        bills = self._in_period(self.bill, F.coalesce(F.nullif("business_date", F.lit("")), "period_end")).where("platform_order_no <> ''").select("platform_order_no")
        orders = self._in_period(self.order_dedup, F.col("ship_time")).where("platform_order_no <> ''").join(bills, "platform_order_no", "left_semi")
        return orders.join(self.order_item, "order_no").groupBy(F.substring("ship_time", 1, 7).alias("ship_month"), F.col("shop").alias("order_shop"), "material_code", "unit").agg(F.countDistinct("platform_order_no").alias("billed_orders"), *_sums(order_bill_qty="item_qty", item_amount="item_amount"), F.count(F.lit(1)).alias("item_groups"))

    @cached_property
    def flow_qty_recon(self) -> DataFrame:
        """Billed quantities against month closes by month, customer and material."""
        m = self.v["fx_shop_map"].select(F.col("wdt_shop").alias("order_shop"), "customer_code", "customer_name", "mapping_status")
        w = self.flow_billed_items.join(m, "order_shop", "left").groupBy("ship_month", "order_shop", "customer_code", "customer_name", "mapping_status", "material_code").agg(*[F.sum(c).alias(c) for c in ("billed_orders", "order_bill_qty", "item_amount")])
        o = self._month_close.groupBy(F.col("outbound_month").alias("ship_month"), "customer_code", F.col("item_code").alias("material_code")).agg(F.min("customer_name").alias("o_name"), *_sums(oms_qty="item_num", oms_amount="share_amount"), F.countDistinct("document_no").alias("oms_docs"))
        back = m.select("customer_code", F.col("order_shop").alias("o_shop"), F.col("mapping_status").alias("o_status"))
        both = two_sided(w, o, ["ship_month", "customer_code", "material_code"], {"billed_orders": 0, "order_bill_qty": 0, "item_amount": 0, "oms_qty": 0, "oms_amount": 0, "oms_docs": 0}).join(back, "customer_code", "left")
        own = F.col("in_left")
        pick = lambda a, b: F.when(own, F.col(a)).otherwise(F.col(b)).alias(a)
        result = classify([(~own, "仅OMS月结数量"), (F.col("customer_code").isNull(), "店铺未映射"), (~F.col("in_right"), "仅订单账单数量"), (within("oms_qty", "order_bill_qty", self.count), "数量一致")], "数量差异")
        return both.select("ship_month", pick("order_shop", "o_shop"), "customer_code", pick("customer_name", "o_name"), pick("mapping_status", "o_status"), "material_code", "billed_orders", "order_bill_qty", "item_amount", "oms_qty", "oms_amount", "oms_docs", (F.col("oms_qty") - F.col("order_bill_qty")).alias("qty_difference"), result.alias("result"))

    @cached_property
    def flow_monthly(self) -> DataFrame:
        """One row a month of orders with bills, closes and invoices beside them."""
        between = lambda df, c: df.where(F.col(c).between(*self.scope.flow_months))
        w = between(self.item_resolved, "ship_month").groupBy(F.col("ship_month").alias("month")).agg(*_sums(order_qty="quantity", order_amount="amount"))
        h = self.flow_shop_bill.groupBy(F.col("bill_month").alias("month")).agg(*[F.sum(c).alias(c) for c in ("bill_records", "bill_success_amount", "bill_receivable", "bill_cash")])
        o = self.flow_oms_month.groupBy(F.col("outbound_month").alias("month")).agg(*_sums(oms_qty="oms_qty", oms_amount="oms_amount"))
        s = self.flow_sap_month.groupBy(F.col("outbound_month").alias("month")).agg(*_sums(sap_qty="sap_qty", sap_amount="sap_amount"))
        full = between(self.sap, "file_month").groupBy(F.col("file_month").alias("month")).agg(*_sums(sap_full_qty="invoice_qty", sap_full_amount="tax_amount"))
        out = w.join(h, "month", "left").join(o, "month", "left").join(s, "month", "left").join(full, "month", "left")
        closer = F.when(F.abs(F.col("oms_amount") - F.col("bill_receivable")) <= F.abs(F.col("oms_amount") - F.col("bill_cash")), "应收更接近").otherwise("实收更接近")
        return out.select("*", (F.col("sap_full_amount") - F.col("oms_amount")).alias("sap_full_difference"), closer.alias("closer"))
