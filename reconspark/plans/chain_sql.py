"""The chain's steps as SQL for the DuckDB oracle, written on their own: outer joins, windows and grouping in plain SQL."""

from __future__ import annotations

from reconspark.plans.chain import FIXTURE_SCOPE, METRICS, TYPE_PAIRS
from reconspark.plans.fixtures import with_views

START, END = FIXTURE_SCOPE.start, FIXTURE_SCOPE.end
M0, M1 = "1996-01", "1998-06"


def s(x: str, name: str | None = None) -> str:
    return f"cast(sum({x}) as bigint) as {name or x}"


def n(name: str) -> str:
    return f"count(*) as {name}"


_ok, _off = "reconcile_result like '%成功%'", "reconcile_result like '%不一致%'"
_ar, _cash = "net_receivable <> 0 and net_cash = 0", "net_cash <> 0 and net_receivable = 0"
_metric_of = dict(zip(METRICS, ((_ok, "1"), (_ok, "net_receivable"), (_off, "1"), (_off, "net_receivable"), (_off, "net_cash"), (_ar, "1"), (_ar, "net_receivable"), (_cash, "1"), (_cash, "net_cash")), strict=True))
_bill_date = "coalesce(nullif(business_date, ''), period_end)"


def _orders(source: str) -> str:
    return f"""
        select case when platform_order_no = '' then '__WDT__' || order_no else platform_order_no end as platform_order_no, max(case when platform_order_no = '' then 0 else 1 end) as matchable, min(shop) as order_shop,
            min(substr(coalesce(nullif(payment_time, ''), trade_time), 1, 7)) as order_month, min(substr(ship_time, 1, 7)) as ship_month, count(*) as order_count, {s('receivable', 'order_amount')}, {s('allocated', 'allocated_amount')}, {s('quantity', 'order_qty')},
            string_agg(order_no, '|' order by order_no) as internal_orders from {source} group by 1"""


def _bills(source: str, receivable: str, cash: str) -> str:
    return f"""
        select case when platform_order_no = '' then '__HC__' || reconcile_id else platform_order_no end as platform_order_no, min(platform) as platform, min(shop) as bill_shop, count(*) as bill_rows, {s(receivable, 'bill_receivable')}, {s(cash, 'bill_cash')},
            min(bill_month) as bill_month, string_agg(reconcile_id, '|' order by reconcile_id) as reconcile_ids from {source} group by 1"""


def _oms_key(source: str, more: str = "") -> str:
    return f"select document_no as oms_sales_no, item_code as material_code, sale_unit as sales_unit, {s('item_num', 'oms_qty')}, {s('share_amount', 'oms_amount')}, count(*) as oms_rows, min(outbound_month) as outbound_month{more} from {source} group by 1, 2, 3"


def _item_recon(grain: str, day: str, where: str, amount_first: bool) -> str:
    amount = "when abs(o.oms_amount - w.order_amount) <= 1 then '金额一致数量差异'" if amount_first else ""
    return f"""
        with w0 as (select {grain}, shop, material_code, {s('quantity', 'order_qty')}, {s('amount', 'order_amount')}, {s('line_count', 'order_lines')} from item_resolved where {where} group by 1, 2, 3),
        w as (select w0.*, m.customer_code, m.customer_name, m.total_score, m.mapping_status from w0 left join fx_shop_map m on m.wdt_shop = w0.shop),
        o as (select o0.*, m.wdt_shop, m.total_score as o_score, m.mapping_status as o_status from (
            select {day} as {grain}, customer_code, min(customer_name) as o_name, item_code as material_code, {s('item_num', 'oms_qty')}, {s('share_amount', 'oms_amount')}, count(distinct document_no) as oms_docs, count(*) as oms_lines
            from fx_oms where business_type = 'Y005' group by 1, 2, 4) o0 join fx_shop_map m on m.customer_code = o0.customer_code)
        select coalesce(w.{grain}, o.{grain}) as {grain}, coalesce(w.shop, o.wdt_shop) as shop, coalesce(w.customer_code, o.customer_code) as customer_code, case when w.shop is null then o.o_name else w.customer_name end as customer_name,
            coalesce(w.material_code, o.material_code) as material_code, coalesce(order_qty, 0) as order_qty, coalesce(order_amount, 0) as order_amount, coalesce(order_lines, 0) as order_lines, oms_qty, oms_amount, oms_docs, oms_lines,
            case when w.shop is null then o_score else total_score end as total_score, case when w.shop is null then o_status else mapping_status end as mapping_status,
            coalesce(oms_qty, 0) - coalesce(order_qty, 0) as qty_difference, coalesce(oms_amount, 0) - coalesce(order_amount, 0) as amount_difference,
            case when w.shop is null then '仅OMS' when o.material_code is null then '仅旺店通' when o.oms_qty = w.order_qty and abs(o.oms_amount - w.order_amount) <= 1 then '数量金额一致' {amount}
                 when o.oms_qty = w.order_qty then '数量一致金额差异' else '数量金额差异' end as result
        from w full outer join o on w.{grain} = o.{grain} and w.customer_code = o.customer_code and w.material_code = o.material_code"""


STEPS = {
    "order_dedup": f"""
        select order_no, max(platform_order_no) as platform_order_no, max(shop) as shop, max(receivable) as receivable, max(allocated) as allocated, max(quantity) as quantity, max(line_count) as line_count,
            min(nullif(trade_time, '')) as trade_time, min(nullif(payment_time, '')) as payment_time, max(nullif(ship_time, '')) as ship_time, count(*) as file_occurrences, string_agg(source_file, '|' order by source_file) as source_files
        from fx_order_file group by order_no""",
    "order_platform": _orders("order_dedup"),
    "bill": f"""
        select *, net_receivable - net_cash as computed_difference from (select *, ar + prior_ar - neg_ar - prior_neg_ar as net_receivable, receipts + prior_receipts - refunds - prior_refunds as net_cash,
            ar - neg_ar as current_receivable, receipts - refunds as current_cash, substr({_bill_date}, 1, 7) as bill_month from fx_bill)""",
    "bill_platform": _bills("bill", "net_receivable", "net_cash"),
    "order_bill_recon": """
        select coalesce(o.platform_order_no, b.platform_order_no) as platform_order_no, coalesce(matchable, 1) as matchable, coalesce(order_shop, '') as order_shop, platform, bill_shop, case when o.platform_order_no is null then '' else order_month end as order_month, bill_month,
            coalesce(order_count, 0) as order_count, bill_rows, coalesce(order_amount, 0) as order_amount, coalesce(allocated_amount, 0) as allocated_amount, bill_receivable, bill_cash, coalesce(order_amount, 0) - bill_receivable as amount_difference,
            coalesce(order_qty, 0) as order_qty, coalesce(internal_orders, '') as internal_orders, reconcile_ids,
            case when o.platform_order_no is null then '仅惠策' when b.platform_order_no is null then case when matchable = 0 then '旺店通原始单号为空' else '仅旺店通' end when abs(order_amount - bill_receivable) <= 1 then '单号金额一致' else '单号一致金额差异' end as result
        from order_platform o full outer join bill_platform b on o.platform_order_no = b.platform_order_no""",
    "bill_rebuilt_summary": "select cast(cast(cast(period_end as date) + interval '1' day as date) as string) as reconcile_date, platform, shop, " + ", ".join(s(f"case when {c} then {v} else 0 end", m) for m, (c, v) in _metric_of.items()) + " from bill group by 1, 2, 3",
    "bill_summary_recon": "with g as (select reconcile_date, platform, shop, " + ", ".join(s(m) for m in METRICS) + """ from fx_summary group by 1, 2, 3)
        select coalesce(g.reconcile_date, r.reconcile_date) as reconcile_date, coalesce(g.platform, r.platform) as platform, coalesce(g.shop, r.shop) as shop, """
    + ", ".join(f"coalesce(g.{m}, 0) as source_{m}, r.{m} as rebuilt_{m}, coalesce(g.{m}, 0) - r.{m} as diff_{m}" for m in METRICS)
    + ", case when g.shop is null then '仅明细重建' when " + " and ".join(f"abs(g.{m} - r.{m}) <= {0 if m.endswith('count') else 1}" for m in METRICS) + """ then '一致' else '差异' end as result
        from g full outer join bill_rebuilt_summary r on g.reconcile_date = r.reconcile_date and g.platform = r.platform and g.shop = r.shop""",
    "bill_internal_recon": f"""
        with d as (select substr(period_end, 1, 7) as month, platform, shop, count(*) as detail_rows, {s('net_receivable', 'detail_receivable')}, {s('net_cash', 'detail_cash')} from bill group by 1, 2, 3),
        g as (select substr(reconcile_date, 1, 7) as month, platform, shop, {', '.join(s(m) for m in METRICS)} from fx_summary group by 1, 2, 3),
        j as (select coalesce(d.month, g.month) as month, coalesce(d.platform, g.platform) as platform, coalesce(d.shop, g.shop) as shop, d.shop is not null as l, g.shop is not null as r, coalesce(detail_rows, 0) as detail_rows, coalesce(detail_receivable, 0) as detail_receivable,
            coalesce(detail_cash, 0) as detail_cash, {', '.join(f'coalesce({m}, 0) as {m}' for m in METRICS)} from d full outer join g on d.month = g.month and d.platform = g.platform and d.shop = g.shop),
        k as (select *, detail_receivable - success_amount - mismatch_receivable - single_ar_amount as receivable_difference, detail_cash - success_amount - mismatch_cash - single_cash_amount as cash_difference from j)
        select month, platform, shop, detail_rows, detail_receivable, detail_cash, {', '.join(METRICS)}, receivable_difference, cash_difference,
            case when not l then '仅店铺汇总' when not r then '仅明细重建' when abs(receivable_difference) <= 1 and abs(cash_difference) <= 1 then '金额一致' else '金额差异' end as result from k""",
    "sap": f"select file_month, oms_sales_no, material_code, sales_unit, sap_invoice_no, {s('invoice_qty')}, {s('tax_amount')}, count(*) as row_count from fx_sap group by 1, 2, 3, 4, 5",
    "sap_key": f"select oms_sales_no, material_code, sales_unit, {s('invoice_qty', 'sap_qty')}, {s('tax_amount', 'sap_amount')}, {s('row_count', 'sap_rows')}, min(file_month) as file_month, string_agg(distinct sap_invoice_no, ',' order by sap_invoice_no) as sap_invoice_nos from sap group by 1, 2, 3",
    "oms_sap_recon": f"""
        with o as (select * from ({_oms_key('fx_oms')}) where oms_sales_no in (select oms_sales_no from sap_key))
        select coalesce(k.oms_sales_no, o.oms_sales_no) as oms_sales_no, coalesce(k.material_code, o.material_code) as material_code, coalesce(k.sales_unit, o.sales_unit) as sales_unit, coalesce(file_month, '') as file_month, outbound_month,
            coalesce(sap_invoice_nos, '') as sap_invoice_nos, coalesce(sap_rows, 0) as sap_rows, oms_rows, coalesce(sap_qty, 0) as sap_qty, oms_qty, oms_qty - coalesce(sap_qty, 0) as quantity_difference, coalesce(sap_amount, 0) as sap_amount, oms_amount,
            oms_amount - coalesce(sap_amount, 0) as amount_difference, case when o.oms_rows is null then '仅SAP' when k.sap_rows is null then '仅OMS' when oms_qty = sap_qty and abs(oms_amount - sap_amount) <= 1 then '数量金额一致' when oms_qty = sap_qty then '数量一致金额差异' else '数量金额差异' end as result
        from sap_key k full outer join o on k.oms_sales_no = o.oms_sales_no and k.material_code = o.material_code and k.sales_unit = o.sales_unit""",
    "uninvoiced_pool_recon": f"""
        with p as (select outbound_month, mapped_platform, mapped_shop, mapping_status, match_score, o.customer_code, min(customer_name) as customer_name, {s('item_num', 'oms_qty')}, {s('share_amount', 'oms_amount')}, count(*) as oms_rows
            from fx_oms o left join fx_customer_map m on m.customer_code = o.customer_code where not exists (select 1 from sap_key k where k.oms_sales_no = o.document_no and k.oms_sales_no <> '') group by 1, 2, 3, 4, 5, 6),
        h as (select bill_month, platform, shop, {s('net_receivable', 'bill_receivable')}, {s('net_cash', 'bill_cash')}, count(*) as bill_rows from bill group by 1, 2, 3)
        select outbound_month, mapped_platform, mapped_shop, customer_code, customer_name, mapping_status, match_score, oms_rows, oms_qty, oms_amount, coalesce(bill_rows, 0) as bill_rows, coalesce(bill_receivable, 0) as bill_receivable, coalesce(bill_cash, 0) as bill_cash,
            oms_amount - coalesce(bill_receivable, 0) as amount_difference, case when coalesce(mapped_shop, '') = '' then '店铺未映射' when h.shop is null then '仅OMS' when abs(oms_amount - bill_receivable) <= 1 then '金额一致' else '金额差异' end as result
        from p left join h on bill_month = outbound_month and platform = mapped_platform and shop = mapped_shop""",
    "product_code_best": "select product_code, sap_code, n from (select *, row_number() over (partition by product_code order by n desc, sap_code) as rn from (select product_code, sap_code, cast(sum(occurrences) as bigint) as n from fx_product group by 1, 2)) where rn = 1",
    "item_coded": "select i.*, case when material_key like 'SKU:%' then coalesce(sap_code, material_key) else material_key end as material_code from fx_item i left join product_code_best p on substr(material_key, 5) = product_code",
    "item_resolved": f"select ship_date, ship_month, shop, material_code, unit, order_type, {s('quantity')}, {s('amount')}, count(*) as line_count from item_coded group by 1, 2, 3, 4, 5, 6",
    "item_month_recon": _item_recon("ship_month", "outbound_month", "true", False),
    "item_day_recon": _item_recon("ship_date", "outbound_date", "ship_date <> ''", False),
    "sales_day_recon": _item_recon("ship_date", "outbound_date", "ship_date <> '' and order_type = '网店销售'", True),
    "shop_month_recon": f"""
        select *, case when qty_difference = 0 and abs(amount_difference) <= 1 then '店铺月度数量金额一致' when qty_difference = 0 then '店铺月度数量一致金额差异' else '店铺月度差异' end as result from (
            select ship_month, shop, customer_code, customer_name, mapping_status, total_score, {', '.join(s(c) for c in ('order_qty', 'oms_qty', 'qty_difference', 'order_amount', 'oms_amount', 'amount_difference'))},
                count(*) filter (where result = '数量金额一致') as exact_item_groups, count(*) as item_groups from item_month_recon group by 1, 2, 3, 4, 5, 6)""",
    "order_type_coverage": f"""
        with pairs(order_type, business_type) as (values {', '.join(map(repr, TYPE_PAIRS))}),
        w as (select ship_date as day, order_type, material_code as item, {s('quantity', 'qty')}, {s('amount')} from item_resolved where ship_date <> '' group by 1, 2, 3),
        o as (select outbound_date as day, business_type, item_code as item, {s('item_num', 'qty')}, {s('share_amount', 'amount')} from fx_oms group by 1, 2, 3),
        t as (select order_type, {s('qty', 'order_qty')}, {s('amount', 'order_amount')} from w group by 1),
        e as (select p.order_type, p.business_type, count(w.item) as exact_groups, {s('w.qty', 'exact_qty')}, {s('w.amount', 'exact_amount')} from pairs p join w using (order_type) join o on o.business_type = p.business_type and o.day = w.day and o.item = w.item
              where o.qty = w.qty and abs(o.amount - w.amount) <= 1 group by 1, 2)
        select order_type, business_type, order_qty, order_amount, coalesce(exact_groups, 0) as exact_groups, coalesce(exact_qty, 0) as exact_qty, coalesce(exact_amount, 0) as exact_amount,
            coalesce(exact_qty, 0) / cast(nullif(order_qty, 0) as double) as qty_coverage, case when order_amount <> 0 then coalesce(exact_amount, 0) / cast(order_amount as double) end as amount_coverage
        from pairs join t using (order_type) left join e using (order_type, business_type)""",
    "sales_controls": f"""
        select *, amount_exact / cast(nullif(order_amount, 0) as double) as amount_coverage, qty_exact / cast(nullif(order_qty, 0) as double) as qty_coverage from (
            select count(*) as order_groups, {s('order_qty')}, {s('order_amount')}, count(oms_qty) as linked_groups, count(*) filter (where oms_qty is not null and abs(amount_difference) <= 1) as amount_exact_groups,
                {s('case when abs(amount_difference) <= 1 then order_amount else 0 end', 'amount_exact')}, {s('case when qty_difference = 0 then order_qty else 0 end', 'qty_exact')} from sales_day_recon where order_qty > 0)""",
    "bill_order_month": f"select bill_month, platform, shop as bill_shop, platform_order_no, {s('current_receivable', 'bill_receivable')}, {s('current_cash', 'bill_cash')}, count(*) as bill_rows from bill where platform_order_no <> '' group by 1, 2, 3, 4",
    "order_item": f"select order_no, material_code, unit, {s('quantity', 'item_qty')}, {s('amount', 'item_amount')}, count(*) as item_lines from item_coded group by 1, 2, 3",
    "platform_order_item": f"""
        select platform_order_no, substr(ship_time, 1, 7) as ship_month, shop as order_shop, material_code, unit, {s('item_qty')}, {s('item_amount')}, {s('item_lines')} from order_dedup join order_item using (order_no) where platform_order_no <> '' group by 1, 2, 3, 4, 5""",
    "shop_bridge": f"""
        with x as (select platform, bill_shop, order_shop, count(distinct platform_order_no) as matched_orders, cast(sum(abs(bill_receivable)) as bigint) as matched_receivable from bill_order_month join platform_order_item using (platform_order_no) group by 1, 2, 3),
        r as (select *, row_number() over (partition by platform, bill_shop order by matched_orders desc, matched_receivable desc, order_shop) as rn, cast(sum(matched_orders) over (partition by platform, bill_shop) as bigint) as total_orders from x),
        b as (select *, matched_orders / cast(total_orders as double) as bridge_share from r where rn = 1)
        select platform, bill_shop, order_shop, matched_orders, total_orders, bridge_share, case when bridge_share >= 0.9 then '高置信' when bridge_share >= 0.7 then '待复核' else '低置信' end as bridge_status from b""",
    "bill_customer_map": """
        select platform, bill_shop, order_shop, customer_code, customer_name, total_score as map_score, bridge_share, bridge_status, mapping_status as map_status,
            case when bridge_status = '高置信' and mapping_status = '高置信' then '高置信' when customer_code is not null and bridge_status <> '低置信' and mapping_status <> '低置信' then '待复核' else '低置信' end as final_status
        from shop_bridge left join fx_shop_map on wdt_shop = order_shop""",
    "bill_item_alloc": """
        with j as (select *, cast(sum(abs(item_amount)) over g as bigint) as abs_amount_total, cast(sum(abs(item_qty)) over g as bigint) as abs_qty_total, count(*) over g as item_groups
            from bill_order_month join platform_order_item using (platform_order_no) window g as (partition by bill_month, platform, bill_shop, platform_order_no)),
        r as (select *, case when abs_amount_total > 0 then cast(abs(item_amount) as double) / abs_amount_total when abs_qty_total > 0 then cast(abs(item_qty) as double) / abs_qty_total else cast(1 as double) / item_groups end as alloc_rate from j)
        select *, bill_receivable * alloc_rate as allocated_receivable, bill_cash * alloc_rate as allocated_cash from r""",
    "bill_material_month": f"""
        select bill_month, platform, bill_shop, material_code, min(customer_code) as customer_code, min(customer_name) as customer_name, min(final_status) as mapping_status, round(sum(allocated_receivable), 4) as bill_receivable, round(sum(allocated_cash), 4) as bill_cash,
            {s('item_qty', 'bridge_qty')}, count(distinct platform_order_no) as mapped_orders, {s('bill_rows')} from bill_item_alloc left join bill_customer_map using (platform, bill_shop, order_shop) group by 1, 2, 3, 4""",
    "bill_oms_item_recon": f"""
        with o as (select outbound_month as bill_month, customer_code, min(customer_name) as o_name, item_code as material_code, {s('item_num', 'oms_qty')}, {s('share_amount', 'oms_amount')}, count(distinct document_no) as oms_docs from fx_oms where business_type = 'Y005' group by 1, 2, 4)
        select coalesce(h.bill_month, o.bill_month) as bill_month, coalesce(platform, '') as platform, coalesce(bill_shop, '') as bill_shop, coalesce(h.customer_code, o.customer_code) as customer_code, case when bill_shop is null then o_name else customer_name end as customer_name,
            case when bill_shop is null then '未映射OMS' else mapping_status end as mapping_status, coalesce(h.material_code, o.material_code) as material_code, coalesce(bill_receivable, 0) as bill_receivable, coalesce(bill_cash, 0) as bill_cash, coalesce(bridge_qty, 0) as bridge_qty,
            coalesce(mapped_orders, 0) as mapped_orders, coalesce(bill_rows, 0) as bill_rows, coalesce(oms_qty, 0) as oms_qty, coalesce(oms_amount, 0) as oms_amount, coalesce(oms_docs, 0) as oms_docs,
            round(coalesce(oms_amount, 0) - coalesce(bill_receivable, 0), 4) as receivable_difference, round(coalesce(oms_amount, 0) - coalesce(bill_cash, 0), 4) as cash_difference,
            case when bill_shop is null then '仅OMS' when oms_docs is null then '仅惠策' when abs(oms_amount - bill_receivable) <= 1 then '应收金额一致' when abs(oms_amount - bill_cash) <= 1 then '实收金额一致' else '金额差异' end as result
        from bill_material_month h full outer join o on h.bill_month = o.bill_month and h.customer_code = o.customer_code and h.material_code = o.material_code""",
    "bill_oms_shop_recon": f"""
        select *, case when abs(receivable_difference) <= 1 then '店铺月度应收一致' when abs(cash_difference) <= 1 then '店铺月度实收一致' else '店铺月度差异' end as result from (
            select bill_month, platform, bill_shop, customer_code, customer_name, mapping_status, {', '.join(f'cast(sum(cast({c} as decimal(28, 4))) as double) as {c}' for c in ('bill_receivable', 'bill_cash', 'receivable_difference', 'cash_difference'))},
                {', '.join(s(c) for c in ('bridge_qty', 'oms_qty', 'oms_amount', 'mapped_orders', 'bill_rows', 'oms_docs'))} from bill_oms_item_recon group by 1, 2, 3, 4, 5, 6)""",
    "bridge_coverage": f"""
        with a as (select count(*) as order_months, {s('bill_receivable', 'receivable')}, {s('bill_cash', 'cash')} from bill_order_month),
        b as (select count(*) as mapped_order_months, {s('r', 'mapped_receivable')}, {s('c', 'mapped_cash')} from (select bill_month, platform, bill_shop, platform_order_no, max(bill_receivable) as r, max(bill_cash) as c from bill_item_alloc group by 1, 2, 3, 4))
        select a.*, b.*, coalesce(mapped_order_months / cast(nullif(order_months, 0) as double), 0) as order_mapping_rate, coalesce(mapped_receivable / cast(nullif(receivable, 0) as double), 0) as receivable_mapping_rate, coalesce(mapped_cash / cast(nullif(cash, 0) as double), 0) as cash_mapping_rate from a, b""",
    "period_bill": f"select * from bill where {_bill_date} >= '{START}' and {_bill_date} < '{END}'",
    "period_order": f"select * from order_dedup where ship_time >= '{START}' and ship_time < '{END}'",
    "flow_order_bill": f"""
        with o as ({_orders('period_order')}), b as ({_bills('period_bill', 'current_receivable', 'current_cash')}),
        j as (select coalesce(o.platform_order_no, b.platform_order_no) as platform_order_no, o.platform_order_no is not null as l, b.platform_order_no is not null as r, coalesce(matchable, 1) as matchable, coalesce(order_shop, '') as order_shop, platform, bill_shop,
            case when o.platform_order_no is null then '' else ship_month end as ship_month, bill_month, coalesce(order_count, 0) as order_count, coalesce(bill_rows, 0) as bill_rows, coalesce(order_qty, 0) as order_qty, coalesce(order_amount, 0) as order_amount,
            coalesce(allocated_amount, 0) as allocated_amount, coalesce(bill_receivable, 0) as bill_receivable, coalesce(bill_cash, 0) as bill_cash, coalesce(internal_orders, '') as internal_orders, coalesce(reconcile_ids, '') as reconcile_ids
            from o full outer join b on o.platform_order_no = b.platform_order_no)
        select * exclude (l, r), order_amount - bill_receivable as receivable_difference, order_amount - bill_cash as cash_difference,
            case when not l then '仅账单' when not r then case when matchable = 0 then '旺店通原始单号为空' else '仅订单' end when abs(order_amount - bill_receivable) <= 1 then '单号应收金额一致' when abs(order_amount - bill_cash) <= 1 then '单号实收金额一致' else '单号一致金额差异' end as result from j""",
    "flow_shop_bill": f"""
        select '1997-0' || cast(k as string) as bill_month, platform, shop as bill_shop, {s('success_count + mismatch_count + single_ar_count + single_cash_count', 'bill_records')}, {s('success_count')}, {s('success_amount', 'bill_success_amount')},
            {s('success_amount + mismatch_receivable + single_ar_amount', 'bill_receivable')}, {s('success_amount + mismatch_cash + single_cash_amount', 'bill_cash')}, count(*) as source_rows
        from (select *, case when source_file like '%1月%' then 1 when source_file like '%2月%' then 2 when source_file like '%3月%' then 3 when source_file like '%4月%' then 4 when source_file like '%5月%' then 5 when source_file like '%6月%' then 6 end as k from fx_summary)
        where k is not null group by 1, 2, 3""",
    "flow_shop_map": """
        select bill_month, platform, bill_shop, coalesce(m.customer_code, d.customer_code) as customer_code, coalesce(m.customer_name, d.customer_name) as customer_name, coalesce(final_status, case when d.customer_code is not null then d.mapping_status else '未映射' end) as mapping_status,
            case when m.customer_code is not null then '订单桥接映射' when d.customer_code is not null then '同名店铺映射' else '未映射' end as mapping_source, bill_records, success_count, bill_success_amount, bill_receivable, bill_cash, source_rows
        from flow_shop_bill left join bill_customer_map m using (platform, bill_shop) left join fx_shop_map d on 'BSHOP' || right(d.wdt_shop, 2) = bill_shop""",
    "month_close": f"select * from fx_oms where business_type = 'Y001' and outbound_date >= '{START}' and outbound_date < '{END}'",
    "flow_oms_month": f"select outbound_month, customer_code, min(customer_name) as customer_name, count(distinct document_no) as oms_docs, {s('item_num', 'oms_qty')}, {s('share_amount', 'oms_amount')}, count(*) as oms_lines from month_close group by 1, 2",
    "flow_field_map": f"""
        with c as ({_oms_key('month_close', ', min(customer_code) as customer_code, min(customer_name) as customer_name')}),
        a as (select r.oms_sales_no, r.material_code, r.sales_unit, r.file_month, c.outbound_month, r.sap_invoice_nos, customer_code, customer_name, r.sap_rows, r.oms_rows, r.sap_qty, coalesce(c.oms_qty, r.oms_qty) as oms_qty, r.quantity_difference, r.sap_amount,
            coalesce(c.oms_amount, r.oms_amount) as oms_amount, r.amount_difference, coalesce(c.oms_qty, r.sap_qty) as mapped_qty, coalesce(c.oms_amount, r.sap_amount) as mapped_amount,
            case when c.oms_rows is null then 'SAP补数量金额' when r.result = '数量金额一致' then '双向字段一致' when r.quantity_difference = 0 then '数量一致金额差异' else '数量金额差异' end as mapping_result, r.result as source_result
            from oms_sap_recon r left join c on c.oms_sales_no = r.oms_sales_no and c.material_code = r.material_code and c.sales_unit = r.sales_unit where coalesce(c.outbound_month, r.file_month) between '{M0}' and '{M1}')
        select * from a union all
        select oms_sales_no, material_code, sales_unit, '', outbound_month, '', customer_code, customer_name, 0, oms_rows, 0, oms_qty, oms_qty, 0, oms_amount, oms_amount, oms_qty, oms_amount, '仅OMS月结', '仅OMS' from c
        where not exists (select 1 from oms_sap_recon r where c.oms_sales_no = r.oms_sales_no and c.material_code = r.material_code and c.sales_unit = r.sales_unit)""",
    "flow_sap_month": f"""
        select outbound_month, customer_code, min(customer_name) as customer_name, count(distinct oms_sales_no) as mapped_docs, {s('sap_qty')}, {s('sap_amount')}, {s('oms_qty', 'mapped_oms_qty')}, {s('oms_amount', 'mapped_oms_amount')},
            count(*) filter (where mapping_result = '双向字段一致') as exact_keys, count(*) as mapped_keys from flow_field_map where customer_code <> '' group by 1, 2""",
    "flow_bill_oms": """
        with j as (select coalesce(h.bill_month, o.outbound_month) as bill_month, h.bill_month is not null as l, o.outbound_month is not null as r, coalesce(platform, '') as platform, coalesce(bill_shop, '') as bill_shop, coalesce(h.customer_code, o.customer_code) as customer_code,
            case when h.bill_month is null then o.customer_name else h.customer_name end as customer_name, coalesce(mapping_status, 'OMS侧未对应') as mapping_status, coalesce(mapping_source, 'OMS客户') as mapping_source, coalesce(bill_records, 0) as bill_records,
            coalesce(success_count, 0) as success_count, coalesce(bill_success_amount, 0) as bill_success_amount, coalesce(bill_receivable, 0) as bill_receivable, coalesce(bill_cash, 0) as bill_cash, coalesce(oms_docs, 0) as oms_docs, coalesce(oms_qty, 0) as oms_qty, coalesce(oms_amount, 0) as oms_amount
            from flow_shop_map h full outer join flow_oms_month o on h.bill_month = o.outbound_month and h.customer_code = o.customer_code),
        k as (select j.*, coalesce(sap_qty, 0) as sap_assisted_qty, coalesce(sap_amount, 0) as sap_assisted_amount from j left join flow_sap_month f on f.outbound_month = j.bill_month and f.customer_code = j.customer_code)
        select * exclude (l, r), oms_amount - bill_success_amount as success_difference, oms_amount - bill_receivable as receivable_difference, oms_amount - bill_cash as cash_difference, sap_assisted_amount - bill_success_amount as sap_success_difference,
            case when not l then '仅OMS月结' when coalesce(customer_code, '') = '' then '店铺未映射' when not r then '仅账单' when abs(oms_amount - bill_success_amount) <= 1 then '成功金额一致' when abs(oms_amount - bill_receivable) <= 1 then '应收金额一致'
                 when abs(oms_amount - bill_cash) <= 1 then '实收金额一致' when abs(sap_assisted_amount - bill_success_amount) <= 1 then 'SAP辅助金额一致' else '金额差异' end as result from k""",
    "flow_billed_items": f"""
        select substr(ship_time, 1, 7) as ship_month, shop as order_shop, material_code, unit, count(distinct platform_order_no) as billed_orders, {s('item_qty', 'order_bill_qty')}, {s('item_amount')}, count(*) as item_groups
        from period_order o join order_item using (order_no) where platform_order_no <> '' and exists (select 1 from period_bill b where b.platform_order_no = o.platform_order_no) group by 1, 2, 3, 4""",
    "flow_qty_recon": f"""
        with w as (select ship_month, order_shop, customer_code, customer_name, mapping_status, material_code, {s('billed_orders')}, {s('order_bill_qty')}, {s('item_amount')} from flow_billed_items left join fx_shop_map on wdt_shop = order_shop group by 1, 2, 3, 4, 5, 6),
        o as (select outbound_month as ship_month, customer_code, min(customer_name) as o_name, item_code as material_code, {s('item_num', 'oms_qty')}, {s('share_amount', 'oms_amount')}, count(distinct document_no) as oms_docs from month_close group by 1, 2, 4),
        j as (select coalesce(w.ship_month, o.ship_month) as ship_month, w.ship_month is not null as l, o.ship_month is not null as r, order_shop, coalesce(w.customer_code, o.customer_code) as customer_code, case when w.ship_month is null then o_name else customer_name end as customer_name, mapping_status,
            coalesce(w.material_code, o.material_code) as material_code, coalesce(billed_orders, 0) as billed_orders, coalesce(order_bill_qty, 0) as order_bill_qty, coalesce(item_amount, 0) as item_amount, coalesce(oms_qty, 0) as oms_qty, coalesce(oms_amount, 0) as oms_amount, coalesce(oms_docs, 0) as oms_docs
            from w full outer join o on w.ship_month = o.ship_month and w.customer_code = o.customer_code and w.material_code = o.material_code)
        select ship_month, case when l then order_shop else m.wdt_shop end as order_shop, j.customer_code, j.customer_name, case when l then j.mapping_status else m.mapping_status end as mapping_status, material_code, billed_orders, order_bill_qty, item_amount, oms_qty, oms_amount, oms_docs,
            oms_qty - order_bill_qty as qty_difference, case when not l then '仅OMS月结数量' when j.customer_code is null then '店铺未映射' when not r then '仅订单账单数量' when oms_qty = order_bill_qty then '数量一致' else '数量差异' end as result
        from j left join fx_shop_map m on m.customer_code = j.customer_code""",
    "flow_monthly": f"""
        with w as (select ship_month as month, {s('quantity', 'order_qty')}, {s('amount', 'order_amount')} from item_resolved where ship_month between '{M0}' and '{M1}' group by 1),
        h as (select bill_month as month, {', '.join(s(c) for c in ('bill_records', 'bill_success_amount', 'bill_receivable', 'bill_cash'))} from flow_shop_bill group by 1),
        o as (select outbound_month as month, {s('oms_qty')}, {s('oms_amount')} from flow_oms_month group by 1), i as (select outbound_month as month, {s('sap_qty')}, {s('sap_amount')} from flow_sap_month group by 1),
        f as (select file_month as month, {s('invoice_qty', 'sap_full_qty')}, {s('tax_amount', 'sap_full_amount')} from sap where file_month between '{M0}' and '{M1}' group by 1)
        select *, sap_full_amount - oms_amount as sap_full_difference, case when abs(oms_amount - bill_receivable) <= abs(oms_amount - bill_cash) then '应收更接近' else '实收更接近' end as closer
        from w left join h using (month) left join o using (month) left join i using (month) left join f using (month)""",
}


def oracle(name: str) -> str:
    """The step's rows as one DuckDB statement."""
    return with_views(f"select * from {name}", STEPS)
