"""What is handed out: details with their order and sample limits, control totals, parameters, and report tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reconspark.operators import rollup
from reconspark.plans.chain import Chain


@dataclass(frozen=True)
class Detail:
    """A detail table: the chain's step, ranks of results (others come first with rank 1), order keys, and sample limit.

    Keys begin with - for descending. `sample_ranks` and `sample_keys` order the sample where it differs; without a sample
    `limit` is 0, and None is a sample of all rows.
    """

    step: str
    ranks: dict[str, int]
    keys: tuple[str, ...]
    limit: int | None
    result: str = "result"
    sample_ranks: dict[str, int] | None = None
    sample_keys: tuple[str, ...] | None = None
    omit: tuple[str, ...] = ()


_EXACT = {"数量金额一致": 2}
#: The details of each family, their orders and sample limits.
FAMILIES = {
    "full": (
        Detail("order_bill_recon", {"单号金额一致": 2}, ("result", "platform_order_no"), 50_000),
        Detail("bill_summary_recon", {}, ("-result", "reconcile_date", "platform", "shop"), 200_000),
        Detail("oms_sap_recon", _EXACT, ("result", "oms_sales_no", "material_code"), 200_000),
        Detail("uninvoiced_pool_recon", {"金额一致": 2}, ("result", "outbound_month", "mapped_shop"), 200_000),
        Detail("customer_map", {}, ("mapping_status", "customer_code"), 200_000, "mapping_status"),
    ),
    "items": (
        Detail("shop_map", {}, ("-total_score",), None, "mapping_status"),
        Detail("item_month_recon", _EXACT, ("result", "ship_month", "shop", "material_code"), 0),
        Detail("item_day_recon", _EXACT, ("result", "ship_date", "shop", "material_code"), 0),
        Detail(
            "sales_day_recon", {"数量金额一致": 3, "金额一致数量差异": 2}, ("result", "ship_date", "shop", "material_code"), 20_000,
            sample_ranks={"数量金额一致": 4, "金额一致数量差异": 3, "数量一致金额差异": 2}, sample_keys=("-|amount_difference", "ship_date", "shop", "material_code", "customer_code"),
        ),
        Detail("order_type_coverage", {}, ("-order_amount",), None, "order_type"),
        Detail("shop_month_recon", {}, ("result", "ship_month", "shop"), None),
    ),
    "bridge": (
        Detail("bill_oms_item_recon", {"应收金额一致": 3, "实收金额一致": 2}, ("result", "bill_month", "bill_shop", "material_code"), 20_000),
        Detail("bill_oms_shop_recon", {"店铺月度应收一致": 2, "店铺月度实收一致": 2}, ("result", "bill_month", "bill_shop"), None),
        Detail("bill_customer_map", {}, ("final_status", "platform", "bill_shop"), None, "final_status"),
        Detail("bill_internal_recon", {"金额一致": 2}, ("result", "month", "platform", "shop"), None),
        Detail("bill_material_month", {}, ("bill_month", "platform", "bill_shop", "material_code"), None, "mapping_status"),
    ),
    "flow": (
        Detail("flow_order_bill", {"单号应收金额一致": 3, "单号实收金额一致": 3}, ("result", "platform_order_no"), 15_000),
        Detail("flow_bill_oms", {"成功金额一致": 3, "应收金额一致": 3, "实收金额一致": 3, "SAP辅助金额一致": 3}, ("result", "bill_month", "bill_shop"), 20_000, omit=("mapping_status", "mapping_source")),
        Detail("flow_qty_recon", {"数量一致": 3}, ("result", "ship_month", "order_shop", "material_code"), 20_000, omit=("mapping_status",)),
        Detail("flow_field_map", {"双向字段一致": 2}, ("mapping_result", "outbound_month", "oms_sales_no", "material_code"), 20_000, "mapping_result"),
        Detail("flow_shop_map", {}, ("mapping_status", "bill_month", "platform", "bill_shop"), 20_000, "mapping_status", omit=("mapping_status", "mapping_source")),
    ),
}

#: What the columns of the flow's details are called beside their names.
LABELS = {
    "platform_order_no": "平台订单号", "matchable": "可匹配标识", "order_shop": "旺店通店铺", "platform": "平台", "bill_shop": "惠策店铺", "ship_month": "发货月份", "bill_month": "账单月份", "order_count": "内部订单数", "bill_rows": "惠策明细行数",
    "order_qty": "旺店通数量", "order_amount": "旺店通金额", "allocated_amount": "旺店通分摊金额", "bill_receivable": "惠策本期应收", "bill_cash": "惠策本期实收", "receivable_difference": "应收差异", "cash_difference": "实收差异",
    "internal_orders": "旺店通内部单号", "reconcile_ids": "惠策对账流水号", "result": "核对结果", "customer_code": "OMS客户编码", "customer_name": "OMS客户名称", "mapping_status": "映射置信度", "mapping_source": "映射来源",
    "bill_records": "账单记录数", "success_count": "成功记录数", "bill_success_amount": "对账成功金额", "oms_docs": "OMS单据数", "oms_qty": "OMS数量", "oms_amount": "OMS金额", "sap_assisted_qty": "SAP辅助数量", "sap_assisted_amount": "SAP辅助金额",
    "success_difference": "成功金额差异", "sap_success_difference": "SAP辅助成功差异", "source_rows": "源文件行数", "material_code": "物料编码", "billed_orders": "账单证据订单数", "order_bill_qty": "订单账单数量", "item_amount": "旺店通商品金额",
    "qty_difference": "数量差异", "oms_sales_no": "OMS销售单号", "sales_unit": "销售单位", "file_month": "SAP文件月份", "outbound_month": "OMS出库月份", "sap_invoice_nos": "SAP发票号", "sap_rows": "SAP行数", "oms_rows": "OMS行数", "sap_qty": "SAP数量",
    "quantity_difference": "数量差异", "sap_amount": "SAP金额", "amount_difference": "金额差异", "mapped_qty": "映射数量", "mapped_amount": "映射金额", "mapping_result": "映射结果", "source_result": "源核对结果",
}

#: The parameters that a full report states beside its tolerances.
STATED = {
    "order_bill_amount_tolerance": "0.01", "bill_summary_amount_tolerance": "0.01", "oms_sap_line_amount_tolerance": "0.01", "oms_sap_total_amount_tolerance": "2.0", "sap_filter": "发票类型描述=标准发票（2C)",
    "oms_sap_key": "OMS.document_no=SAP.OMS销售单号；再加物料编码+销售单位", "order_bill_key": "旺店通.原始单号=惠策.平台订单号",
}


def step(chain: Chain, name: str) -> DataFrame:
    """A step of the chain, or one of the maps that it was given."""
    given = {"customer_map": "fx_customer_map", "shop_map": "fx_shop_map"}
    return chain.v[given[name]] if name in given else getattr(chain, name)


def _order(detail: Detail, ranks: dict[str, int], keys: tuple[str, ...]) -> list[Column]:
    rank = F.lit(1)
    for label, r in ranks.items():
        rank = F.when(F.col(detail.result) == label, r).otherwise(rank)
    # Nulls come first ascending and last descending.
    by = [F.desc_nulls_last(F.abs(k[2:]) if k.startswith("-|") else k[1:]) if k.startswith("-") else F.asc_nulls_first(k) for k in keys]
    return ([F.asc(rank)] if ranks else []) + by


def ordered(chain: Chain, detail: Detail) -> DataFrame:
    """All rows of a detail in the order in which they are handed out."""
    return step(chain, detail.step).orderBy(*_order(detail, detail.ranks, detail.keys))


def sample(chain: Chain, detail: Detail) -> DataFrame | None:
    """The rows that a workbook embeds, in their own order, at most `limit`: the limit is the sample's feature. None without."""
    if detail.limit == 0:
        return None
    rows = step(chain, detail.step).orderBy(*_order(detail, detail.sample_ranks or detail.ranks, detail.sample_keys or detail.keys))
    return rows if detail.limit is None else rows.limit(detail.limit)


def displayed(df: DataFrame, omit: tuple[str, ...] = ()) -> DataFrame:
    """The table as a report shows it: omitted columns gone, names with their label on a second line, NaN as null."""
    kinds = dict(df.dtypes)
    clean = lambda c: F.when(~F.isnan(c), F.col(c)) if kinds[c] in ("double", "float") else F.col(c)
    return df.select(*[clean(c).alias(f"{c}\n{LABELS[c]}" if c in LABELS else c) for c in df.columns if c not in omit])


def registry(chain: Chain) -> DataFrame:
    """family, place, detail, sample_limit (null: all rows, 0: no sample): every table that is handed out, in order."""
    rows = [(family, i, d.step, d.limit) for family, details in FAMILIES.items() for i, d in enumerate(details, 1)]
    return chain.spark.createDataFrame(rows, "family string, place int, detail string, sample_limit int")


def parameters(chain: Chain) -> DataFrame:
    """name, value of what the figures of a full report rest on; the total tolerance is stated and applied nowhere."""
    s = chain.scope
    scope = {"date_scope": "" if s.span is None else f"{s.span[0]}至{s.span[1]}", "money_tolerance": str(s.money), "count_tolerance": str(s.count), "period_start": s.start, "period_end": s.end}
    return chain.spark.createDataFrame(list({**STATED, **scope}.items()), "name string, value string")


def mapping_averages(mapped: DataFrame) -> DataFrame:
    """Customers and mean score of each grade of a map."""
    return mapped.groupBy("mapping_status").agg(F.count(F.lit(1)).alias("customers"), (F.sum("total_score") / F.count(F.lit(1))).alias("avg_score"))


def top_mappings(mapped: DataFrame, most: int = 30) -> DataFrame:
    """The `most` best scored mappings; ties fall to the smaller code."""
    return mapped.orderBy(F.desc("total_score"), "customer_code").limit(most)


MONTHLY = ("order_qty", "order_amount", "bill_records", "bill_success_amount", "bill_receivable", "bill_cash", "oms_qty", "oms_amount", "sap_qty", "sap_amount", "sap_full_qty", "sap_full_amount", "sap_full_difference")


def monthly_sheet(chain: Chain, total_label: str = "合计") -> DataFrame:
    """The months of the flow and a last row with the sums of all columns."""
    months = chain.flow_monthly.select("month", *MONTHLY)
    return months.unionByName(months.agg(F.lit(total_label).alias("month"), *[F.sum(c).alias(c) for c in MONTHLY]))


def waterfall(chain: Chain) -> DataFrame:
    """tier, link, groups, quantity, amount, covered (share of its side), treatment: from the strictest to the loosest match.

    1 orders and bills by number with equal amount; 2 items and daily closes with equal amount; 3 the same with equal
    quantity; 4 order types other than sales, judged by type; 5 invoices and month closes with both equal; 6 the rest.
    """
    money, count = chain.money, chain.count
    orders = chain.order_bill_recon.where("result = '单号金额一致'").agg(F.count(F.lit(1)).alias("g"), F.sum("order_count").cast("double").alias("q"), F.sum("order_amount").cast("double").alias("a"))
    sales = chain.sales_day_recon.where("order_qty > 0")
    near_amount, near_qty, linked = F.abs("amount_difference") <= money, F.abs("qty_difference") <= count, F.col("oms_qty").isNotNull()
    total = lambda c, x: F.sum(F.when(c, F.col(x))).cast("double")
    item = sales.agg(
        F.count_if(linked & near_amount).alias("g2"), total(near_amount, "order_amount").alias("a2"), F.sum("order_amount").cast("double").alias("all_a"), F.count_if(linked & near_qty).alias("g3"),
        total(near_qty, "order_qty").alias("q3"), F.sum("order_qty").cast("double").alias("all_q"),
    )
    exact = F.col("result") == "数量金额一致"
    invoices = chain.oms_sap_recon.agg(F.count_if(exact).alias("g5"), total(exact, "sap_qty").alias("q5"), total(exact, "sap_amount").alias("a5"), F.sum("sap_amount").cast("double").alias("all_s"))
    placed = chain.order_platform.agg(F.sum("order_count").cast("double").alias("all_o"))
    one = orders.crossJoin(item).crossJoin(invoices).crossJoin(placed)  # four single rows
    null = F.lit(None).cast("double")
    tiers = (
        (1, "旺店通→惠策", F.col("g"), F.col("q"), F.col("a"), F.try_divide("q", "all_o"), "匹配后剔除"), (2, "旺店通→OMS日结", F.col("g2"), null, F.col("a2"), F.try_divide("a2", "all_a"), "匹配后剔除"),
        (3, "旺店通→OMS日结", F.col("g3"), F.col("q3"), null, F.try_divide("q3", "all_q"), "作为数量辅助结论"), (4, "非网店订单→OMS业务类型", F.lit(None).cast("bigint"), null, null, null, "按类型分别剔除"),
        (5, "OMS月结→SAP", F.col("g5"), F.col("q5"), F.col("a5"), F.try_divide("a5", "all_s"), "匹配后剔除"), (6, "剩余总体", F.lit(None).cast("bigint"), null, null, null, "列入差异明细"),
    )
    rows = [F.struct(F.lit(t).alias("tier"), F.lit(link).alias("link"), g.alias("groups"), q.alias("quantity"), a.alias("amount"), c.alias("covered"), F.lit(what).alias("treatment")) for t, link, g, q, a, c, what in tiers]
    return one.select(F.inline(F.array(*rows)))


def status_tables(chain: Chain, family: str) -> dict[str, DataFrame]:
    """For each detail of a family its outcomes with counts and the sums of its amounts and quantities."""
    found = {}
    for d in FAMILIES[family]:
        df = step(chain, d.step)
        measures = [c for c, t in df.dtypes if t != "string" and any(w in c for w in ("amount", "qty", "receivable", "cash"))]
        found[d.step] = rollup.status_rollup(df, measures, d.result)
    return found
