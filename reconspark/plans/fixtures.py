"""Inputs of the reconciliation plans as views over the star-schema tables.

Each view is one SQL text that Spark and DuckDB read alike. Amounts are whole cents and quantities whole numbers, so
that sums are exact in any order; the engine itself takes doubles or decimals as well. They are definitions of test
inputs only; all operators are in the DataFrame plans.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from reconspark.sources.tables import table

_IX = "case when o_custkey % 20 < 8 then o_custkey % 20 when o_custkey % 20 < 14 then (o_custkey % 20 + case when o_orderkey % 5 = 0 then 1 else 0 end) % 20 else (o_custkey % 20 + o_orderkey % 3) % 20 end"
_TOKEN = "case {x} % 4 when 0 then '天猫' when 1 then '京东' when 2 then '抖音' else '拼多多' end"
_SHOP = _TOKEN + " || 'SHOP' || lpad(cast({x} as string), 2, '0')"


def _sum(x: str) -> str:
    return f"cast(sum({x}) as bigint)"


VIEWS = {
    "fx_line": f"""
        select l_orderkey as ok, l_partkey as pk, l_linenumber as ln, o_custkey as ck, cast({_IX} as bigint) as ix, cast(l_quantity as bigint) as qty,
            cast(round(l_extendedprice * 100) as bigint) as cents, substr(cast(l_shipdate as string), 1, 10) as ship_date,
            substr(cast(o_orderdate as string), 1, 10) as order_date, l_returnflag as unit, substr(o_orderpriority, 1, 1) as pr
        from lineitem join orders on l_orderkey = o_orderkey""",
    "fx_order_file": f"""
        select cast(ok as string) as order_no, f.source_file, case when ok % 97 = 0 or (ok % 31 = 0 and f.n = 2) then '' else 'P' || cast(ok as string) end as platform_order_no,
            {_SHOP.format(x='ix')} as shop, min(order_date) as trade_time, case when ok % 4 = 0 then '' else min(order_date) end as payment_time, min(ship_date) as ship_time,
            {_sum('cents')} as receivable, {_sum('cents - cents / 20 * f.n')} as allocated, {_sum('qty')} as quantity, count(*) as line_count
        from fx_line cross join (select 1 as n, 'a.xlsx' as source_file union all select 2, 'b.xlsx') f
        where f.n = 1 or ok % 3 = 0 group by ok, ix, f.n, f.source_file""".replace("cents / 20 * f.n", "cast(floor(cents / 20) as bigint) * f.n"),
    "fx_bill": f"""
        select 'R' || cast(ok as string) as reconcile_id, case when ok % 101 = 0 then '' else 'P' || cast(ok as string) end as platform_order_no,
            'PF' || cast(ck % 4 as string) as platform, 'BSHOP' || lpad(cast(ck % 20 as string), 2, '0') as shop,
            case when ok % 7 = 0 then '' else min(order_date) end as business_date, min(substr(cast(last_day(cast(order_date as date)) as string), 1, 10)) as period_end,
            {_sum('cents')} + case ok % 10 when 6 then 500 when 7 then 950 else 0 end as ar, case when ok % 11 = 0 then 100 else 0 end as prior_ar,
            case when ok % 13 = 0 then 50 else 0 end as neg_ar, 0 as prior_neg_ar, case when ok % 17 = 0 then 0 else {_sum('cents')} - case ok % 10 when 6 then 300 else 0 end end as receipts,
            case when ok % 11 = 0 then 100 else 0 end as prior_receipts, case when ok % 13 = 0 then 50 else 0 end as refunds, 0 as prior_refunds,
            case when ok % 10 in (6, 7) then '金额不一致' else '对账成功' end as reconcile_result
        from fx_line where ok % 10 <> 8 group by ok, ck""",
    "fx_item": """
        select cast(ok as string) as order_no, ship_date, substr(ship_date, 1, 7) as ship_month, """ + _SHOP.format(x="ix") + """ as shop,
            case when pk % 10 = 0 then 'SKU:P' || cast(pk as string) else 'M' || cast(pk as string) end as material_key, unit,
            case when ix < 4 or pr in ('1', '2') then '网店销售' when pr = '3' then '分销订单' when pr = '4' then '样品发货' else '赠品' end as order_type,
            case when ok % 178 = 0 then 0 else qty end as quantity, case when ok % 89 = 0 then 0 else cents end as amount, ix, ln, ok, ck, pk
        from fx_line""",
    "fx_product": """
        select 'P' || cast(pk as string) as product_code, 'M' || cast(case when ln = 3 then pk + 1 else pk end as string) as sap_code, count(*) as occurrences
        from fx_line where pk % 10 = 0 and pk % 70 <> 0 group by pk, case when ln = 3 then pk + 1 else pk end""",
    "fx_oms": """
        select case when ok % 53 = 0 then '' else 'D' || cast(ok as string) end as document_no, case when ln = 7 then 'N' else 'M' end || cast(pk as string) as item_code, unit as sale_unit,
            case when ck % 41 = 0 then null when ck % 7 = 0 then 'C' || cast(20 + ck % 5 as string) else 'C' || lpad(cast(ix as string), 2, '0') end as customer_code,
            case when ck % 41 = 0 then null when ck % 7 = 0 then '线下客户' || cast(20 + ck % 5 as string) else '客户' || lpad(cast(ix as string), 2, '0') end as customer_name,
            case when order_type = '网店销售' then case when ix < 4 or ok % 2 = 0 then 'Y005' else 'Y001' end when order_type = '分销订单' then 'Y051' when order_type = '样品发货' then 'Z003' else 'Z001' end as business_type,
            ship_date as outbound_date, ship_month as outbound_month, quantity + case when ln in (2, 4) then 1 else 0 end as item_num, amount + case when ln in (3, 4) then 100 else 0 end as share_amount
        from fx_item where ln <> 6""",
    "fx_sap": """
        select substr(ship_date, 1, 7) as file_month, 'D' || cast(ok as string) as oms_sales_no, case when ln = 7 then 'X' else 'M' end || cast(pk as string) as material_code, unit as sales_unit,
            'I' || cast(ok % 1000 as string) as sap_invoice_no, qty + case when ln = 5 then 1 else 0 end as invoice_qty, cents + case ln when 4 then 200 when 5 then 700 else 0 end as tax_amount
        from fx_line where ln <> 6 and ok % 5 <> 0""",
    "fx_summary": f"""
        select cast(cast(cast(period_end as date) + interval '1' day as date) as string) as reconcile_date, platform, shop,
            {_sum("case when reconcile_result like '%成功%' then 1 else 0 end")} as success_count, {_sum("case when reconcile_result like '%成功%' then ar + prior_ar - neg_ar else 0 end")} as success_amount,
            {_sum("case when reconcile_result like '%不一致%' then 1 else 0 end")} as mismatch_count, {_sum("case when reconcile_result like '%不一致%' then ar + prior_ar - neg_ar else 0 end")} as mismatch_receivable,
            {_sum("case when reconcile_result like '%不一致%' then receipts + prior_receipts - refunds else 0 end")} + case when shop = 'BSHOP03' then 7 else 0 end as mismatch_cash,
            {_sum("case when ar + prior_ar - neg_ar <> 0 and receipts + prior_receipts - refunds = 0 then 1 else 0 end")} as single_ar_count,
            {_sum("case when ar + prior_ar - neg_ar <> 0 and receipts + prior_receipts - refunds = 0 then ar + prior_ar - neg_ar else 0 end")} as single_ar_amount,
            cast(0 as bigint) as single_cash_count, cast(0 as bigint) as single_cash_amount, '汇总' || cast(cast(substr(period_end, 6, 2) as int) as string) || '月.xlsx' as source_file
        from fx_bill where not (shop = 'BSHOP05' and platform = 'PF1') group by period_end, platform, shop
        union all select '2001-02-30', 'PF9', 'BSHOP99', 1, 100, 0, 0, 0, 0, 0, 0, 0, '汇总2月.xlsx'""",
    "fx_shop_map": f"""
        select 'C' || lpad(cast(c as string), 2, '0') as customer_code, case when c < 20 then '客户' else '线下客户' end || lpad(cast(c as string), 2, '0') as customer_name,
            {_SHOP.format(x='(c % 20)')} as wdt_shop, 'BSHOP' || lpad(cast(c % 20 as string), 2, '0') as same_name, cast((c * 37) % 100 as double) / 100 as total_score,
            case when (c * 37) % 100 >= 72 then '高置信' when (c * 37) % 100 >= 55 then '待复核' else '低置信' end as mapping_status
        from (select distinct c_custkey % 25 as c from customer) where c % 9 <> 8""",
    "fx_customer_map": """
        select customer_code, 'PF' || cast(cast(substr(customer_code, 2, 2) as int) % 4 as string) as mapped_platform, case when customer_code = 'C03' then '' else 'BSHOP' || lpad(cast(cast(substr(customer_code, 2, 2) as int) % 20 as string), 2, '0') end as mapped_shop,
            total_score as match_score, mapping_status
        from fx_shop_map""",
}

VIEWS["fx_text"] = """
        select o_orderkey as ok, cast(round(o_totalprice * 100) as bigint) as cents, substr(cast(o_orderdate as string), 1, 10) as day,
            case o_orderkey % 6 when 0 then cast(cast(round(o_totalprice * 100) as bigint) as string) when 1 then '  ' || cast(cast(round(o_totalprice * 100) as bigint) as string) || ' ' when 2 then 'N/A' when 3 then ''
                when 4 then cast(cast(floor(round(o_totalprice * 100) / 1000) as bigint) as string) || ',' || lpad(cast(cast(round(o_totalprice * 100) as bigint) % 1000 as string), 3, '0') else '1d' end as number_text,
            cast(cast(substr(cast(o_orderdate as string), 1, 4) as int) + 20 as string) || case o_orderkey % 3 when 0 then '年' when 1 then '-' else '/' end || cast(cast(substr(cast(o_orderdate as string), 6, 2) as int) as string) || '月' as month_text,
            case when o_orderkey % 4 = 0 then '明细.xlsx' else cast(25 + o_orderkey % 2 as string) || '年' || cast(1 + o_orderkey % 12 as string) || '月.xlsx' end as file_name
        from orders"""

_BASE = ("lineitem", "orders", "customer")


def views(spark: SparkSession, d: str, more: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """All views, and `more` of them, as DataFrames, built from one another."""
    known = {t: table(spark, d, t) for t in _BASE}
    for name, sql in {**VIEWS, **(more or {})}.items():
        used = {t: df for t, df in known.items() if re.search(rf"(from|join)\s+{t}\b", sql)}
        text = sql.replace("{", "{{").replace("}", "}}")
        for t in used:
            text = _named(text, t)
        known[name] = spark.sql(text, **used)
    return known


def _named(sql: str, name: str) -> str:
    return re.sub(rf"(from|join)\s+{name}\b", rf"\1 {{{name}}}", sql)


def with_views(query: str, ctes: dict[str, str] | None = None) -> str:
    """The query as one DuckDB statement with all views, and further named steps, before it."""
    steps = ", ".join(f"{n} as ({s})" for n, s in {**VIEWS, **(ctes or {})}.items())
    return f"with {steps} {query}"
