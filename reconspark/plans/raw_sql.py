"""Oracle SQL of the ingestion queries."""

from __future__ import annotations

from reconspark.plans.cleaning_sql import _blank
from reconspark.plans.fixtures import with_views
from reconspark.plans.raw_fixtures import _AMOUNTS, _METRICS, RAW

_num = lambda c: f"coalesce(try_cast(replace(trim({c}), ',', '') as double), 0.0)"
_LINES = f"""select *, trim(order_no) as o, case when sap_code <> '' then sap_code when product_code <> '' then 'SKU:' || product_code else '' end as material_key, {_num('quantity')} as q, {_num('amount')} as a
    from raw_order_line where trim(order_no) not in ('', '订单编号')"""
_MONTH = "case when regexp_matches(ship_time, '20\\d\\d-\\d') then substr(ship_time, 1, 7) when regexp_matches(source_file, '2[56]年') then '20' || substr(source_file, 1, 2) || '-' || lpad(regexp_extract(source_file, '年(\\d+)月', 1), 2, '0') else '' end"
_ITEMS = f"select o as order_no, substr(ship_time, 1, 10) as ship_date, {_MONTH} as ship_month, shop, material_key, unit, order_type, q as quantity, a as amount from ({_LINES}) where shop <> '' and material_key <> '' and {_MONTH} <> ''"
_PRODUCTS = f"select product_code, sap_code, count(*) as occurrences from ({_LINES}) where product_code <> '' and sap_code <> '' group by 1, 2"
_BILL_TEXTS = "reconcile_id, platform_order_no, platform, shop, reconcile_status, period_start, business_date, period_end, reconcile_result, failure_result, source_file"
_BILLS = f"""select {_BILL_TEXTS}, {', '.join(f'cast({a} as double) as {a}' for a in (*_AMOUNTS, 'positive_difference', 'reverse_difference'))} from (
    select *, row_number() over (partition by reconcile_id order by source_file, row_number) as rn from raw_bill where reconcile_id not in ('', '对账流水号')) where rn = 1"""
_CURRENT = f"select reconcile_id, ar - neg_ar as current_receivable, receipts - refunds as current_cash from ({_BILLS})"
_FIRST = lambda t: f"(select *, upper(trim(reconcile_id)) as k from {t} where not {_blank('reconcile_id')} qualify row_number() over (partition by upper(trim(reconcile_id)) order by row_id) = 1)"

_SQL = {
    "ingest_orders": """with k as (select *, trim(order_no) as o from raw_order_line where trim(order_no) <> ''),
        f as (select *, case when o = lag(o) over w then 0 else 1 end as fresh from k window w as (partition by source_file order by row_number)),
        r as (select *, sum(fresh) over (partition by source_file order by row_number rows unbounded preceding) as run from f),
        a as (select source_file, o as order_no, run, """ + ", ".join(f"arg_min({c}, row_number) as {c}" for c in ("platform_order_no", "sub_order_no", "shop", "order_status", "order_type", "trade_time", "payment_time", "ship_time", "receivable")) + f""",
            sum({_num('amount')}) as allocated, sum({_num('quantity')}) as quantity, count(*) as line_count from r group by 1, 2, 3)
        select order_no, source_file, platform_order_no, sub_order_no, shop, order_status, order_type, trade_time, payment_time, ship_time, {_num('receivable')} as receivable, allocated, quantity, line_count
        from a qualify row_number() over (partition by source_file, order_no order by run desc) = 1""",
    "ingest_order_lines": f"select o as order_no, material_key, unit, q as quantity, a as amount from ({_LINES}) where material_key <> ''",
    "ingest_items": _ITEMS,
    "ingest_products": _PRODUCTS,
    "ingest_bills": _BILLS,
    "ingest_current": _CURRENT,
    "ingest_summaries": f"""select monthly_id, reconcile_date, platform, shop, source_file, {', '.join(f'{_num(m)} as {m}' for m in _METRICS)} from raw_summary where monthly_id <> '月汇总流水号'
        qualify row_number() over (partition by monthly_id order by source_file desc, row_number desc) = 1""",
    "ingest_invoices": f"""select replace(source_file, '.XLSX', '') as file_month, oms_sales_no, material_code, sales_unit, sap_invoice_no, {', '.join(f'cast({a} as double) as {a}' for a in ('invoice_qty', 'tax_amount', 'net_amount', 'tax_value'))}
        from raw_invoice where trim(invoice_type) = '标准发票（2C)'""",
    "ingest_closes": """select document_no, item_code, item_name, sale_unit, remark, business_no, business_type, customer_code, customer_name, outbound_time, substr(outbound_time, 1, 10) as outbound_date, substr(outbound_time, 1, 7) as outbound_month,
        create_time, warehouse_code, warehouse_name, cycle_type, cast(item_num as double) as item_num, cast(delivery_amount as double) as delivery_amount, cast(share_amount as double) as share_amount from raw_dump
        qualify row_number() over (partition by document_no, item_code, sale_unit, warehouse_code, outbound_time order by row_number desc, business_type desc, customer_code desc) = 1""",
    "raw_item_months": f"""with p as (select product_code, sap_code from ({_PRODUCTS}) qualify row_number() over (partition by product_code order by occurrences desc, sap_code) = 1)
        select ship_month, case when material_key like 'SKU:%' then coalesce(sap_code, material_key) else material_key end as material_code, sum(quantity) as quantity, sum(amount) as amount, count(*) as line_count
        from ({_ITEMS}) left join p on product_code = substr(material_key, 5) where ship_month between '2015-12' and '2018-06' group by 1, 2""",
    "raw_bill_months": f"""with b as (select cast(cast(substr(d, 1, 4) as int) + 20 as varchar) || substr(d, 5, 3) as bill_month, shop, current_receivable, current_cash
            from (select *, coalesce(nullif(business_date, ''), period_end) as d from ({_BILLS})) join ({_CURRENT}) using (reconcile_id))
        select bill_month, shop, count(*) as bill_rows, sum(current_receivable) as bill_receivable, sum(current_cash) as bill_cash from b where bill_month between '2015-12' and '2018-06' group by 1, 2""",
    "tolerance_boundary": """with r as (select ln, cast(cents as double) / 100 as a, cast(cents as double) / 100 + cast(ln - 3 as double) / 200 as b, cast(qty as double) as p, cast(qty as double) + case pk % 3 when 0 then 0.0::double when 1 then 5e-7::double else 1.5e-6::double end as q from fx_line)
        select ln, case when abs(p - q) <= 1e-6::double and abs(a - b) <= 0.01::double then '数量金额一致' when abs(p - q) <= 1e-6::double then '数量一致金额差异' else '数量金额差异' end as result, count(*) as row_count from r group by 1, 2""",
}
ORACLES = {name: with_views(f"select * from ({sql})", RAW) for name, sql in _SQL.items()}
ORACLES["bill_current_join"] = f"""select shop, count(*) as bill_rows, cast(sum(cast(current_receivable as decimal(18, 4))) as double) as current_receivable, cast(sum(cast(current_cash as decimal(18, 4))) as double) as current_cash
    from {_FIRST('huice_detail')} b join {_FIRST('huice_current_amount')} c using (k) group by 1"""
