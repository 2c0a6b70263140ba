"""The llm queries that SQL can say, for the DuckDB oracle."""

from reconspark.plans.cleaning_sql import _blank, _typed

_P2_FIELDS = ("shop", "platform_order_no", "order_status", "payment_time", "ship_time", "receivable_amount")

P2 = f"""
with r as (
    select o.*, {_typed('order_no')} as k, coalesce(trust_rank, 999999) as t, coalesce(exported_at, timestamp '1900-01-01') as e
    from wdt_orders_file o left join export_file using (source_file) where not {_blank('order_no')}
), g as (select k, min(row_id) as group_row_id from r group by k having count(*) > 1),
v as ({' union all '.join(f"select k, '{f}' as field_name, row_id, t, e from r where not " + (f"({f} is null or isnan({f}))" if f == "receivable_amount" else _blank(f)) for f in _P2_FIELDS)})
select group_row_id, field_name, row_id as value_row_id
from v join g using (k) qualify row_number() over (partition by k, field_name order by t, e desc, row_id desc) = 1
"""

ORACLES = {"p2_found": P2}
