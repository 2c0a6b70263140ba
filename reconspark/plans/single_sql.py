"""Oracle SQL of the single-operator queries."""

from __future__ import annotations

from reconspark.functions.business import PLATFORM_TOKENS, PLATFORM_WORDS
from reconspark.plans.chain_sql import M0, M1, STEPS, s
from reconspark.plans.fixtures import with_views
from reconspark.plans.reports import MONTHLY

_LINE = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"
_RUNS = """select user_id, run_no, event_type, min(event_id) as first_event, count(*) as events from (
    select *, cast(sum(fresh) over (partition by user_id order by ts, event_id rows unbounded preceding) as bigint) as run_no from (
        select *, case when lag(event_type) over w is not distinct from event_type and row_number() over w > 1 then 0 else 1 end as fresh from events window w as (partition by user_id order by ts, event_id))) group by 1, 2, 3"""


def _pick(way: str) -> str:
    return f"select l_orderkey, l_linenumber, {_LINE} from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by " + ", ".join(f"{c} {way}" for c in f"{_LINE}, l_shipdate".split(", ")) + ") = 1"


def _tall(parts: dict[str, dict[str, str]]) -> str:
    rows = [f"select '{m}' as metric, coalesce(cast({v} as double), 0.0) as metric_value from {t}" for t, ms in parts.items() for m, v in ms.items()]
    return " union all ".join(rows)


def _sum(*names: str, **more: str) -> dict[str, str]:
    return {n: f"sum({n})" for n in names} | {n: f"sum({v})" for n, v in more.items()}


_CHAINED = {
    "surrogate_key": "select order_no, source_file, case when platform_order_no = '' then '__WDT__' || order_no else platform_order_no end as order_key, case when platform_order_no = '' then 0 else 1 end as matchable from fx_order_file",
    "scan_parse_number": "select ok, case when ok % 6 in (2, 3, 5) then 0.0 else cast(cents as double) end as amount from fx_text",
    "month_extract": "select ok, cast(cast(substr(day, 1, 4) as int) + 20 as string) || '-' || substr(day, 6, 2) as month, case when ok % 4 = 0 then 'none' else '20' || cast(25 + ok % 2 as string) || '-' || lpad(cast(1 + ok % 12 as string), 2, '0') end as file_month from fx_text",
    "business_month": "select reconcile_id, substr(case when business_date = '' then period_end else business_date end, 1, 7) as bill_month, cast(cast(cast(period_end as date) + interval '1' day as date) as string) as reconcile_date from fx_bill",
    "net_measures": "select reconcile_id, ar + prior_ar - neg_ar - prior_neg_ar as net_receivable, receipts + prior_receipts - refunds - prior_refunds as net_cash, ar - neg_ar as current_receivable, receipts - refunds as current_cash, ar + prior_ar - neg_ar - prior_neg_ar - (receipts + prior_receipts - refunds - prior_refunds) as computed_difference from fx_bill",
    "semi_evidence": f"select shop, count(*) as orders, {s('receivable')} from order_dedup o where exists (select 1 from fx_bill b where b.platform_order_no = o.platform_order_no and b.platform_order_no <> '') group by 1",
    "anti_uninvoiced": f"select business_type, count(*) as row_count, {s('share_amount')} from fx_oms o where not exists (select 1 from fx_sap s where s.oms_sales_no = o.document_no) group by 1",
    "theta_tolerance_join": f"select ship_month, count(*) as pairs, {s('amount')} from fx_item join fx_oms on outbound_date = ship_date and item_code = material_key where abs(amount - share_amount) <= 1 group by 1",
    "cross_candidates": "select customer_code, shop, case substr(shop, 1, 2) when '拼多' then '拼多多' else substr(shop, 1, 2) end as platform from (select customer_code, substr(wdt_shop, 1, 2) as t from fx_shop_map) join (select distinct shop from fx_item) on t = substr(shop, 1, 2)",
    "expr_join_codes": f"select case when material_key not like 'SKU:%' then 'code' when sap_code is null then 'unknown product' else 'resolved product' end as code_kind, count(*) as row_count, {s('quantity')} from fx_item left join product_code_best on substr(material_key, 5) = product_code group by 1",
    "top_shop": f"select * from (select material_key, shop, {s('amount')} from fx_item group by 1, 2) qualify row_number() over (partition by material_key order by amount desc, shop) = 1",
    "partition_totals": f"""select *, cast(sum(abs(amount)) over w as bigint) as abs_amount_total, cast(sum(abs(quantity)) over w as bigint) as abs_qty_total, count(*) over w as item_groups
        from (select ship_month, shop, material_key, {s('amount')}, {s('quantity')} from fx_item group by 1, 2, 3) window w as (partition by ship_month, shop)""",
    "topk_abs_diff": "select platform_order_no, amount_difference, result from order_bill_recon where amount_difference is not null order by abs(amount_difference) desc, platform_order_no limit 20",
    "exception_order": "select platform_order_no, result, cast(case result when '单号金额一致' then 2 else 1 end as integer) as exception_rank from order_bill_recon order by 3, 2, 1",
    "labelled_union": " union all ".join([f"select 'WDT' as source, {s('quantity')}, {s('amount')} from fx_item", *[f"select 'OMS_{t}', {s('item_num', 'quantity')}, {s('share_amount', 'amount')} from fx_oms where business_type = '{t}'" for t in ("Y005", "Y001")]]),
    "vector_cosine": """select * from (with w as (select shop, ship_month as m, material_key as i, sum(cast(amount as double) / 100) as x from fx_item group by 1, 2, 3),
        o as (select customer_code, outbound_month as m, item_code as i, sum(cast(share_amount as double) / 100) as y from fx_oms where business_type = 'Y005' and customer_code is not null group by 1, 2, 3),
        a as (select shop, sqrt(sum(x * x)) as n from w group by 1), b as (select customer_code, sqrt(sum(y * y)) as n from o group by 1)
        select shop, customer_code, round(coalesce(dot / nullif(a.n * b.n, 0), 0.0), 6) as cosine from (select shop, customer_code, sum(x * y) as dot from w join o using (m, i) group by 1, 2) join a using (shop) join b using (customer_code))""",
    "two_level_max_sum": f"select shop, {s('m', 'receivable')} from (select shop, order_no, max(receivable) as m from fx_order_file group by 1, 2) group by 1",
    "composite_distinct": "select business_type, count(distinct outbound_month || '|' || customer_code) as month_customers, count(distinct document_no) as documents from fx_oms group by 1",
    "status_rollup": f"select result, count(*) as group_count, {s('order_qty')}, {s('order_amount')}, {s('bill_receivable')}, {s('bill_cash')} from flow_order_bill group by 1",
    "result_share": "select result, count(*) as group_count, count(*) / cast((select count(*) from flow_order_bill) as double) as share from flow_order_bill group by 1 union all select '合计', count(*), case when count(*) > 0 then 1.0 else 0.0 end from flow_order_bill",
    "result_disposition": """select result, count(*) as row_count, case when result in ('单号应收金额一致', '单号实收金额一致') then '匹配剔除' when result = '单号一致金额差异' then '保留差异' when result in ('仅订单', '仅账单') then '关闭' else '保留复核' end as disposition,
        case when result like '%差异%' and result not like '%一致%' then 'error' when result like '%仅%' or result like '%未映射%' then 'warn' when result like '%差异%' then 'warn' else 'ok' end as severity from flow_order_bill group by 1""",
    "safe_ratios": f"select order_no, amount / cast(nullif(quantity, 0) as double) as price_or_null, coalesce(amount / cast(nullif(quantity, 0) as double), 0.0) as price_or_zero, case when abs(amount) > 0 then cast(quantity as double) / amount end as per_cent from (select order_no, {s('amount')}, {s('quantity')} from fx_item group by 1)",
    "recon_controls": _tall({
        "order_platform": {"platform_orders": "count(*)"} | _sum("order_amount"),
        "bill_platform": {"bill_orders": "count(*)"} | _sum("bill_receivable", "bill_cash"),
        "order_bill_recon where result in ('单号金额一致', '单号一致金额差异')": {"matched_orders": "count(*)"} | _sum(matched_order_amount="order_amount", matched_bill_amount="bill_receivable"),
        "bill_summary_recon": {"summary_groups": "count(*)", "summary_consistent_groups": "count(*) filter (where result = '一致')"},
        "fx_sap": _sum(sap_quantity="invoice_qty", sap_amount="tax_amount") | {"sap_rows": "count(*)"},
        "fx_oms": _sum(oms_quantity="item_num", oms_amount="share_amount") | {"oms_rows": "count(*)"},
        "oms_sap_recon": _sum(key_sap_quantity="sap_qty", key_oms_quantity="oms_qty", key_sap_amount="sap_amount", key_oms_amount="oms_amount") | {"exact_keys": "count(*) filter (where result = '数量金额一致')", "total_keys": "count(*)"},
        "fx_oms o where document_no not in (select oms_sales_no from sap_key)": _sum(pool_quantity="item_num", pool_amount="share_amount") | {"pool_rows": "count(*)"},
        "fx_customer_map": {"mapped_customers": "count(*)", "high_confidence": "count(*) filter (where mapping_status = '高置信')", "unmapped": "count(*) filter (where mapped_shop = '')"},
    }),
    "flow_controls": _tall({
        "period_order": {"orders": "count(distinct case when platform_order_no = '' then order_no else platform_order_no end)"},
        "period_bill": {"bill_orders": "count(distinct case when platform_order_no = '' then reconcile_id else platform_order_no end)"},
        f"item_resolved where ship_month between '{M0}' and '{M1}'": _sum(order_qty="quantity", order_amount="amount"),
        f"fx_sap where file_month between '{M0}' and '{M1}' and file_month in (select ship_month from fx_item)": _sum(sap_full_qty="invoice_qty", sap_full_amount="tax_amount"),
        "flow_shop_bill": _sum("bill_records", "bill_success_amount", "bill_receivable", "bill_cash"),
        "flow_oms_month": _sum(close_docs="oms_docs", close_qty="oms_qty", close_amount="oms_amount"),
        "flow_sap_month": _sum(sap_assisted_qty="sap_qty", sap_assisted_amount="sap_amount"),
        "flow_billed_items": _sum(billed_qty="order_bill_qty"),
        "flow_shop_map where customer_code <> ''": _sum(mapped_bill_amount="bill_receivable"),
        "flow_shop_map where coalesce(customer_code, '') = ''": _sum(unmapped_bill_amount="bill_receivable"),
    }),
    "flow_display_metrics": _tall({
        "flow_order_bill": {"order_groups": "count(*)", "order_key_matches": "count(*) filter (where result like '单号%')", "order_amount_exact": "count(*) filter (where result like '单号_收金额一致')", "order_key_coverage": "count(*) filter (where result like '单号%') / cast(nullif(count(*), 0) as double)"},
        "flow_bill_oms": {"bill_exact_groups": "count(*) filter (where result = '成功金额一致')", "bill_total_groups": "count(*)", "bill_abs_success_difference": "sum(abs(success_difference))"},
        **{f"flow_shop_map where mapping_status = '{label}'": {f"mapping_{n}": "sum(bill_receivable)"} for n, label in (("high", "高置信"), ("review", "待复核"), ("low", "低置信"), ("none", "未映射"))},
        "flow_qty_recon where result in ('数量一致', '数量差异')": {"qty_common_groups": "count(*)", "qty_exact_groups": "count(*) filter (where result = '数量一致')", "qty_abs_difference": "sum(abs(qty_difference))", "qty_exact": "sum(case when result = '数量一致' then oms_qty end)"},
    }),
    "mapping_averages": "select mapping_status, count(*) as customers, round(sum(total_score) / count(*), 9) as avg_score from fx_shop_map group by 1",
    "top_mappings": "select customer_code, wdt_shop, total_score from fx_shop_map order by total_score desc, customer_code limit 30",
    "ranked_sales_days": """select ship_date, shop, material_code, customer_code, amount_difference, result from sales_day_recon
        order by case result when '数量金额一致' then 4 when '金额一致数量差异' then 3 when '数量一致金额差异' then 2 else 1 end, abs(amount_difference) desc nulls last, ship_date nulls first, shop nulls first, material_code nulls first, customer_code nulls first limit 20000""",
    "monthly_sheet": f"select month, {', '.join(MONTHLY)} from flow_monthly union all select '合计', {', '.join(s(c) for c in MONTHLY)} from flow_monthly",
    "waterfall": """select * from (with o as (select count(*) as g, cast(sum(order_count) as double) as q, cast(sum(order_amount) as double) as a from order_bill_recon where result = '单号金额一致'), n as (select cast(sum(order_count) as double) as t from order_platform),
        i as (select count(*) filter (where oms_qty is not null and abs(amount_difference) <= 1) as g2, cast(sum(order_amount) filter (where abs(amount_difference) <= 1) as double) as a2, cast(sum(order_amount) as double) as ta,
            count(*) filter (where oms_qty is not null and qty_difference = 0) as g3, cast(sum(order_qty) filter (where qty_difference = 0) as double) as q3, cast(sum(order_qty) as double) as tq from sales_day_recon where order_qty > 0),
        v as (select count(*) filter (where result = '数量金额一致') as g5, cast(sum(sap_qty) filter (where result = '数量金额一致') as double) as q5, cast(sum(sap_amount) filter (where result = '数量金额一致') as double) as a5, cast(sum(sap_amount) as double) as ts from oms_sap_recon)
        select 1 as tier, '旺店通→惠策' as link, g as groups, q as quantity, a as amount, q / t as covered, '匹配后剔除' as treatment from o, n union all select 2, '旺店通→OMS日结', g2, null, a2, a2 / ta, '匹配后剔除' from i
        union all select 3, '旺店通→OMS日结', g3, q3, null, q3 / tq, '作为数量辅助结论' from i union all select 4, '非网店订单→OMS业务类型', null, null, null, null, '按类型分别剔除'
        union all select 5, 'OMS月结→SAP', g5, q5, a5, a5 / ts, '匹配后剔除' from v union all select 6, '剩余总体', null, null, null, null, '列入差异明细')""",
    "detail_manifest": " union all ".join(f"select '{t}' as detail, count(*) as row_count from {t}" for t in ("flow_order_bill", "flow_bill_oms", "flow_qty_recon", "flow_field_map", "flow_shop_map")),
}
_PLAIN = {
    "keep_first": _pick("asc"),
    "keep_last": _pick("desc"),
    "upsert_sum": "select l_orderkey, l_linenumber, cast(sum(cast(l_quantity as bigint)) as bigint) as l_quantity, count(*) as row_count from lineitem group by 1, 2",
    "run_length_orders": _RUNS,
    "last_runs": f"select * from ({_RUNS}) qualify row_number() over (partition by user_id, event_type order by run_no desc) = 1",
    "platform_tokens": "select shop, case " + " ".join(f"when shop like '%{t}%' then '{p}'" for t, p in PLATFORM_TOKENS) + " else '' end as platform, case " + " ".join(f"when shop like '%{w}%' then '{w}'" for w in PLATFORM_WORDS) + " else '' end as word from (select distinct shop from huice_detail where shop is not null)",
    "report_columns": """select * from (values (1, 'bill_month' || chr(10) || '账单月份'), (2, 'platform' || chr(10) || '平台'), (3, 'bill_shop' || chr(10) || '惠策店铺'), (4, 'customer_code' || chr(10) || 'OMS客户编码'),
        (5, 'customer_name' || chr(10) || 'OMS客户名称'), (6, 'bill_records' || chr(10) || '账单记录数'), (7, 'success_count' || chr(10) || '成功记录数'), (8, 'bill_success_amount' || chr(10) || '对账成功金额'),
        (9, 'bill_receivable' || chr(10) || '惠策本期应收'), (10, 'bill_cash' || chr(10) || '惠策本期实收'), (11, 'source_rows' || chr(10) || '源文件行数')) t(place, shown)""",
    "report_parameters": """select * from (values ('order_bill_amount_tolerance', '0.01'), ('bill_summary_amount_tolerance', '0.01'), ('oms_sap_line_amount_tolerance', '0.01'), ('oms_sap_total_amount_tolerance', '2.0'), ('sap_filter', '发票类型描述=标准发票（2C)'),
        ('oms_sap_key', 'OMS.document_no=SAP.OMS销售单号；再加物料编码+销售单位'), ('order_bill_key', '旺店通.原始单号=惠策.平台订单号'), ('date_scope', ''), ('money_tolerance', '1'), ('count_tolerance', '0'), ('period_start', '1996-01-01'), ('period_end', '1998-07-01')) t(name, value)""",
    "report_registry": """select * from (values ('full', 1, 'order_bill_recon', 50000), ('full', 2, 'bill_summary_recon', 200000), ('full', 3, 'oms_sap_recon', 200000), ('full', 4, 'uninvoiced_pool_recon', 200000), ('full', 5, 'customer_map', 200000),
        ('items', 1, 'shop_map', null), ('items', 2, 'item_month_recon', 0), ('items', 3, 'item_day_recon', 0), ('items', 4, 'sales_day_recon', 20000), ('items', 5, 'order_type_coverage', null), ('items', 6, 'shop_month_recon', null),
        ('bridge', 1, 'bill_oms_item_recon', 20000), ('bridge', 2, 'bill_oms_shop_recon', null), ('bridge', 3, 'bill_customer_map', null), ('bridge', 4, 'bill_internal_recon', null), ('bridge', 5, 'bill_material_month', null),
        ('flow', 1, 'flow_order_bill', 15000), ('flow', 2, 'flow_bill_oms', 20000), ('flow', 3, 'flow_qty_recon', 20000), ('flow', 4, 'flow_field_map', 20000), ('flow', 5, 'flow_shop_map', 20000)) t(family, place, detail, sample_limit)""",
    "period_rollup": " union all ".join(
        f"select '{g}' as grain, {f} as period, count(*) as row_count, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as cents from orders group by 2"
        for g, f in (("month", "strftime(o_orderdate, '%Y-%m')"), ("quarter", "cast(year(o_orderdate) as string) || '-Q' || cast(quarter(o_orderdate) as string)"), ("year", "cast(year(o_orderdate) as string)"))
    ),
}

ORACLES = _PLAIN | {name: with_views(sql, STEPS) for name, sql in _CHAINED.items()}
