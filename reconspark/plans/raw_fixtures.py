"""Raw inputs as text, made from the star-schema tables: what workbooks and dump would give, faults included.

Row numbers tell all lines apart, so that runs of orders do not depend on how ties fall. Like the views of plans/fixtures.py each is one SQL text that Spark and DuckDB read alike; columns carry field names and
are renamed to the inputs' headers or places for the readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reconspark.plans.fixtures import views
from reconspark.plans.ingest import BILL_HEADERS, DUMP_FIELDS, INVOICE_PLACES, ORDER_HEADERS, SUMMARY_PLACES
from reconspark.sources.contracts import SUMMARY_METRICS


def _text(x: str) -> str:
    return f"cast({x} as string)"


def _later(day: str) -> str:
    """The same day twenty years later, since months are read from 20.. years only."""
    return f"cast(cast(substr({day}, 1, 4) as int) + 20 as string) || substr({day}, 5)"


_AMOUNTS = ("ar", "prior_ar", "neg_ar", "prior_neg_ar", "receipts", "prior_receipts", "refunds", "prior_refunds")
_BILL = ("reconcile_id", "platform", "shop", "reconcile_status", "period_start", "period_end", "business_date", "platform_order_no", *_AMOUNTS, "positive_difference", "reverse_difference", "reconcile_result", "failure_result")
_METRICS = SUMMARY_METRICS.split()
_head = lambda names, key, header: ", ".join(f"'{header}' as {n}" if n == key else f"'{n}' as {n}" for n in names)

RAW = {
    "raw_order_line": f"""
        select case when ok % 29 = 0 and ln = 1 then ' ' else ' J' || {_text('ok')} end as order_no, case when ok % 31 = 0 then '' else shop end as shop, 'P' || {_text('ok')} as platform_order_no, {_text('ln')} as sub_order_no,
            '已发货' as order_status, order_type, order_day as trade_time, case when ok % 4 = 0 then '' else order_day end as payment_time, case when ok % 19 = 0 then '' else ship_day || ' 10:00:00' end as ship_time,
            case when ok % 3 = 0 then 'N/A' when ok % 3 = 1 then '1,' || lpad({_text('ok % 1000')}, 3, '0') else ' ' || {_text('ln')} end as receivable, {_text('cents')} as amount, case when ok % 178 = 0 then '' else {_text('qty')} end as quantity,
            case when pk % 10 = 0 then '' else 'M' || {_text('pk')} end as sap_code, case when pk % 7 = 0 then '' else 'P' || {_text('pk % 500')} end as product_code, unit,
            case when ok % 17 = 0 then '订单.xlsx' else '26年' || {_text('1 + ok % 6')} || '月.xlsx' end as source_file, case when ok % 23 = 0 and ln >= 4 then 5000000000000000000 else 0 end + (ok * 10 + ln) * 10000000000 + pk * 10000 + cents % 10000 as row_number
        from (select l.*, {_later('i.first_day')} as ship_day, {_later('l.order_date')} as order_day, i.shop, i.order_type from fx_line l
            join (select ok, shop, order_type, min(ship_date) as first_day from fx_item group by ok, shop, order_type) i on i.ok = l.ok)
        union all select {_head(ORDER_HEADERS.values(), 'order_no', '订单编号')}, '26年1月.xlsx', cast(3000000000000000 as bigint)""",
    "raw_bill": f"""
        select {', '.join(f"{_text('b.' + c)} as {c}" if c in _AMOUNTS else "'0' as " + c if c.endswith('_difference') else "'成功' as " + c if c == 'reconcile_status' else "'' as " + c if c in ('period_start', 'failure_result') else 'b.' + c for c in _BILL)},
            '1.xlsx' as source_file, cast(substr(b.reconcile_id, 2) as bigint) as row_number from fx_bill b
        union all select {', '.join(f"{_text('b.' + c + ' + 7')} as {c}" if c in _AMOUNTS else "'1' as " + c if c.endswith('_difference') else "'' as " + c if c in ('reconcile_status', 'period_start', 'failure_result') else 'b.' + c for c in _BILL)},
            '2.xlsx', cast(substr(b.reconcile_id, 2) as bigint) from fx_bill b where cast(substr(b.reconcile_id, 2) as bigint) % 3 = 0
        union all select {_head(_BILL, 'reconcile_id', '对账流水号')}, '2.xlsx', cast(0 as bigint) union all select {', '.join(f"'' as {n}" for n in _BILL)}, '2.xlsx', cast(1 as bigint)""",
    "raw_summary": f"""
        select reconcile_date || platform || shop as monthly_id, reconcile_date, platform, shop, {', '.join(f'{_text(m)} as {m}' for m in _METRICS)}, source_file, cast(1 as bigint) as row_number from fx_summary
        union all select reconcile_date || platform || shop, reconcile_date, platform, shop, {', '.join(f"' 1,00{k}.5 '" for k, _ in enumerate(_METRICS))}, source_file, cast(2 as bigint) from fx_summary where platform = 'PF2'
        union all select {_head(("monthly_id", "reconcile_date", "platform", "shop", *_METRICS), 'monthly_id', '月汇总流水号')}, '汇总1月.xlsx', cast(3 as bigint)""",
    "raw_invoice": f"""
        select oms_sales_no, sap_invoice_no, case when material_code like '%7' then '标准发票（2C）' when material_code like '%8' then '贷项' else ' 标准发票（2C)' end as invoice_type, material_code, {_text('invoice_qty')} as invoice_qty, sales_unit,
            {_text('tax_amount')} as tax_amount, {_text('tax_amount - 1')} as net_amount, '1' as tax_value, file_month || '.XLSX' as source_file, cast(2 as bigint) as row_number from fx_sap""",
    "raw_dump": f"""
        select {', '.join({'item_name': "'it''s' as item_name", 'item_num': _text('item_num') + ' as item_num', 'share_amount': _text('share_amount') + ' as share_amount', 'delivery_amount': "'1.5' as delivery_amount", 'outbound_time': _later('outbound_date') + " || ' 08:00:00' as outbound_time", 'remark': "'' as remark", 'business_no': "'' as business_no", 'create_time': "'' as create_time", 'warehouse_code': "'W' || " + _text('item_num % 4') + ' as warehouse_code', 'warehouse_name': "'' as warehouse_name", 'cycle_type': "'' as cycle_type", 'customer_code': "coalesce(customer_code, '') as customer_code", 'customer_name': "coalesce(customer_name, '') as customer_name"}.get(f, f) for f in DUMP_FIELDS)},
            'd.sql' as source_file, cast(item_num * 1000000000 + share_amount as bigint) as row_number from fx_oms""",
}


def raw_views(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The raw inputs of a data folder under the names of ingest.chain_tables, with headers and places as readers give them."""
    v = views(spark, d, RAW)
    place = lambda df, places: df.withColumnsRenamed({n: f"c{p}" for p, n in places.items()})
    name = lambda df, headers: df.withColumnsRenamed({n: h for h, n in headers.items()})
    return {
        "lines": name(v["raw_order_line"], ORDER_HEADERS), "bill_rows": name(v["raw_bill"], BILL_HEADERS), "summary_rows": place(v["raw_summary"], SUMMARY_PLACES),
        "invoice_rows": place(v["raw_invoice"], INVOICE_PLACES), "dump_rows": v["raw_dump"],
    }
