"""What each table of the reconciliation holds: columns, types and the key that tells its rows apart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Contract:
    """Columns with their types, and the key of the table (empty: rows may repeat)."""

    columns: dict[str, str]
    key: tuple[str, ...] = ()

    def conform(self, df: DataFrame) -> DataFrame:
        """The columns of the contract in their order and types; a missing column is an error, others are left out.

        Text that is no number of the column's type becomes null; the readers give zero before it comes to that.
        """
        missing = [c for c in self.columns if c not in df.columns]
        if missing:
            raise ValueError(f"columns are missing: {', '.join(missing)}")
        return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in self.columns.items()])

    def repeated(self, df: DataFrame) -> DataFrame:
        """Keys that more than one row has, with row_count; no rows for a table that keeps its contract."""
        return df.groupBy(*self.key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def _columns(texts: str, numbers: str = "", counts: str = "") -> dict[str, str]:
    return {c: t for names, t in ((texts, "string"), (numbers, "double"), (counts, "bigint")) for c in names.split()}


SUMMARY_METRICS = "success_count success_amount mismatch_count mismatch_receivable mismatch_cash single_ar_count single_ar_amount single_cash_count single_cash_amount"
CONTRACTS = {
    "fx_order_file": Contract(_columns("order_no source_file platform_order_no sub_order_no shop order_status order_type trade_time payment_time ship_time", "receivable allocated quantity", "line_count"), ("order_no", "source_file")),
    "fx_order_line": Contract(_columns("order_no material_key unit", "quantity amount")),
    "fx_item": Contract(_columns("order_no ship_date ship_month shop material_key unit order_type", "quantity amount")),
    "fx_product": Contract(_columns("product_code sap_code", counts="occurrences"), ("product_code", "sap_code")),
    "fx_bill": Contract(
        _columns("reconcile_id platform_order_no platform shop reconcile_status period_start business_date period_end reconcile_result failure_result source_file", "ar prior_ar neg_ar prior_neg_ar receipts prior_receipts refunds prior_refunds positive_difference reverse_difference"),
        ("reconcile_id",),
    ),
    "fx_current": Contract(_columns("reconcile_id", "current_receivable current_cash"), ("reconcile_id",)),
    "fx_summary": Contract(_columns("monthly_id reconcile_date platform shop source_file", SUMMARY_METRICS), ("monthly_id",)),
    "fx_sap": Contract(_columns("file_month oms_sales_no material_code sales_unit sap_invoice_no", "invoice_qty tax_amount net_amount tax_value")),
    "fx_oms": Contract(
        _columns("document_no item_code item_name sale_unit remark business_no business_type customer_code customer_name outbound_time outbound_date outbound_month create_time warehouse_code warehouse_name cycle_type", "item_num delivery_amount share_amount"),
        ("document_no", "item_code", "sale_unit", "warehouse_code", "outbound_time"),
    ),
    "fx_customer_map": Contract(_columns("customer_code customer_name mapped_platform mapped_shop mapping_status", "match_score"), ("customer_code",)),
    "fx_shop_map": Contract(_columns("customer_code customer_name wdt_shop same_name mapping_status", "total_score"), ("customer_code",)),
}
