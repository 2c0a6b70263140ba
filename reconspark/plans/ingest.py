"""From raw inputs to the chain's tables: order lines, bills, bill summaries, invoices and the order-management dump.

Each function takes a frame of text columns as a reader gives it (source_file and row_number included) and returns a table
that keeps its contract. Guards drop what is no record: lines without a key, repeated header rows, invoices of another
type, items without their dimensions. Missing columns are blank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reconspark.functions import business as B
from reconspark.functions.numbers import parse_number
from reconspark.functions.text import clean_text
from reconspark.operators.dedup import keep_first, keep_last, last_run, run_length
from reconspark.operators.mapping import customer_shop_map, shop_map
from reconspark.sources.contracts import CONTRACTS, SUMMARY_METRICS
from reconspark.sources.sql_dump import read_dump
from reconspark.sources.xlsx import XlsxSource

#: Headers of the inputs and the fields they become.
ORDER_HEADERS = {
    "订单编号": "order_no", "店铺名称": "shop", "原始单号": "platform_order_no", "原始子单号": "sub_order_no", "订单状态": "order_status", "订单类型": "order_type", "交易时间": "trade_time", "付款时间": "payment_time",
    "发货时间": "ship_time", "应收金额": "receivable", "分摊后总价": "amount", "数量": "quantity", "SAP编码": "sap_code", "货品编号": "product_code", "单位": "unit",
}
BILL_HEADERS = {
    "对账流水号": "reconcile_id", "平台": "platform", "店铺": "shop", "对账状态": "reconcile_status", "账期开始日期": "period_start", "账期结束日期": "period_end", "业务日期": "business_date", "平台订单号": "platform_order_no",
    "正应收金额": "ar", "往期正应收金额": "prior_ar", "负应收金额": "neg_ar", "往期负应收金额": "prior_neg_ar", "收款金额（正实收）": "receipts", "往期收款金额": "prior_receipts", "退款金额（负实收）": "refunds", "往期退款金额": "prior_refunds",
    "正向差异金额": "positive_difference", "逆向差异金额": "reverse_difference", "对账结果": "reconcile_result", "对账失败结果": "failure_result",
}
#: The header of the summaries' key, the columns of summaries and invoices by place, the invoice type.
SUMMARY_KEY_HEADER = "月汇总流水号"
SUMMARY_PLACES = dict(enumerate(("monthly_id", "reconcile_date", "platform", "shop", *SUMMARY_METRICS.split()), 1))
INVOICE_PLACES = {1: "oms_sales_no", 6: "sap_invoice_no", 15: "invoice_type", 32: "material_code", 43: "invoice_qty", 44: "sales_unit", 49: "tax_amount", 50: "net_amount", 51: "tax_value"}
INVOICE_TYPE = "标准发票（2C)"
#: The fields of a line of the dump.
DUMP_FIELDS = (
    "item_code", "item_name", "item_num", "sale_unit", "delivery_amount", "share_amount", "remark", "business_no", "document_no", "business_type", "customer_code", "customer_name", "outbound_time", "create_time",
    "warehouse_code", "warehouse_name", "cycle_type",
)


def named(raw: DataFrame, names: dict[str, str]) -> DataFrame:
    """Trimmed texts under their field names, blank where the input has no such column; source_file and row_number."""
    there = set(raw.columns)
    return raw.select(*[(clean_text(F.col(f"`{h}`")) if h in there else F.lit("")).alias(n) for h, n in names.items()], "source_file", "row_number")


def _record(key: str, header: str) -> Column:
    """Whether a row is a record: its key is neither blank nor the header again."""
    return (F.col(key) != "") & (F.col(key) != header)


def order_files(raw: DataFrame) -> DataFrame:
    """One row for each order of a file: contiguous lines of one order are a run; the order's own fields come from the
    run's first line, the lines' amounts and quantities are summed, and of several runs the last counts.

    Lines without an order number are left out and do not end a run.
    """
    lines = named(raw, ORDER_HEADERS).where("order_no <> ''")
    own = ("platform_order_no", "sub_order_no", "shop", "order_status", "order_type", "trade_time", "payment_time", "ship_time", "receivable")
    aggs = {c: F.min_by(c, "row_number") for c in own}
    runs = run_length(lines, ["source_file"], ["row_number"], "order_no", {**aggs, "allocated": F.sum(parse_number("amount")), "quantity": F.sum(parse_number("quantity")), "line_count": F.count(F.lit(1))})
    last = last_run(runs, ["source_file"], "order_no")
    return CONTRACTS["fx_order_file"].conform(last.withColumn("receivable", parse_number("receivable")))


def _item_lines(raw: DataFrame) -> DataFrame:
    lines = named(raw, ORDER_HEADERS).where(_record("order_no", "订单编号"))
    return lines.withColumns({"material_key": B.material_key("sap_code", "product_code"), "quantity": parse_number("quantity"), "amount": parse_number("amount")})


def order_lines(raw: DataFrame) -> DataFrame:
    """Items of orders whose material is known; month and shop may be blank."""
    return CONTRACTS["fx_order_line"].conform(_item_lines(raw).where("material_key <> ''"))


def items(raw: DataFrame) -> DataFrame:
    """Items with month (of the shipment, else of the file's name), shop and material; others are left out."""
    lines = _item_lines(raw)
    month = F.coalesce(F.nullif(B.month_of("ship_time"), F.lit("")), B.month_of_file("source_file"))
    lines = lines.withColumns({"ship_month": month, "ship_date": F.substring("ship_time", 1, 10)})
    return CONTRACTS["fx_item"].conform(lines.where("ship_month <> '' and shop <> '' and material_key <> ''"))


def products(raw: DataFrame) -> DataFrame:
    """How often each product code stands beside each SAP code, counted before the items' guard on dimensions."""
    lines = _item_lines(raw).where("product_code <> '' and sap_code <> ''")
    return CONTRACTS["fx_product"].conform(lines.groupBy("product_code", "sap_code").agg(F.count(F.lit(1)).alias("occurrences")))


_BILL_AMOUNTS = ("ar", "prior_ar", "neg_ar", "prior_neg_ar", "receipts", "prior_receipts", "refunds", "prior_refunds", "positive_difference", "reverse_difference")


def bills(raw: DataFrame) -> DataFrame:
    """One row for each bill record; of several with one number the first by file and row counts."""
    rows = named(raw, BILL_HEADERS).where(_record("reconcile_id", "对账流水号"))
    first = keep_first(rows, ["reconcile_id"], ["source_file", "row_number"])
    return CONTRACTS["fx_bill"].conform(first.withColumns({a: parse_number(a) for a in _BILL_AMOUNTS}))


def current_amounts(raw: DataFrame) -> DataFrame:
    """Amounts of a bill's own period, without those of earlier ones; the first record of a number counts."""
    own = bills(raw)
    return CONTRACTS["fx_current"].conform(own.select("reconcile_id", (F.col("ar") - F.col("neg_ar")).alias("current_receivable"), (F.col("receipts") - F.col("refunds")).alias("current_cash")))


def _placed(raw: DataFrame, places: dict[int, str]) -> DataFrame:
    return named(raw, {f"c{p}": n for p, n in places.items()})


def summaries(raw: DataFrame) -> DataFrame:
    """One row for each monthly summary; of several with one number the last by file and row counts."""
    rows = _placed(raw, SUMMARY_PLACES).where(_record("monthly_id", SUMMARY_KEY_HEADER))
    last = keep_last(rows, ["monthly_id"], ["source_file", "row_number"])
    return CONTRACTS["fx_summary"].conform(last.withColumns({m: parse_number(m) for m in SUMMARY_METRICS.split()}))


def invoices(raw: DataFrame) -> DataFrame:
    """Invoice lines of the one type, with the month that their file is named after."""
    rows = _placed(raw, INVOICE_PLACES).where(F.col("invoice_type") == INVOICE_TYPE)
    amounts = ("invoice_qty", "tax_amount", "net_amount", "tax_value")
    return CONTRACTS["fx_sap"].conform(rows.withColumns({"file_month": F.regexp_replace("source_file", r"\.[^.]*$", ""), **{a: parse_number(a) for a in amounts}}))


def closes(raw: DataFrame) -> DataFrame:
    """Lines of the dump, the last of each key, with date and month of their outbound time."""
    rows = named(raw, {f: f for f in DUMP_FIELDS})
    last = keep_last(rows, list(CONTRACTS["fx_oms"].key), ["source_file", "row_number"])
    last = last.withColumns({a: parse_number(a) for a in ("item_num", "delivery_amount", "share_amount")})
    return CONTRACTS["fx_oms"].conform(last.withColumns({"outbound_date": F.substring("outbound_time", 1, 10), "outbound_month": B.month_of("outbound_time")}))


def chain_tables(lines: DataFrame, bill_rows: DataFrame, summary_rows: DataFrame, invoice_rows: DataFrame, dump_rows: DataFrame, span: tuple[str, str] | None = None) -> dict[str, DataFrame]:
    """All tables of the chain from the five raw inputs; both maps of customers and shops are made from them."""
    t = {
        "fx_order_file": order_files(lines), "fx_order_line": order_lines(lines), "fx_item": items(lines), "fx_product": products(lines), "fx_bill": bills(bill_rows), "fx_current": current_amounts(bill_rows),
        "fx_summary": summaries(summary_rows), "fx_sap": invoices(invoice_rows), "fx_oms": closes(dump_rows),
    }
    t["fx_customer_map"] = CONTRACTS["fx_customer_map"].conform(customer_shop_map(t["fx_oms"], t["fx_bill"]))
    t["fx_shop_map"] = CONTRACTS["fx_shop_map"].conform(shop_map(t["fx_item"], t["fx_oms"], span).withColumn("same_name", F.col("wdt_shop")))
    return t


def read_raw(spark: SparkSession, orders: str, bill_files: str, summary_files: str, invoice_files: str, dump: str, max_rows: int | None = None, archived: str = "已归档订单明细") -> dict[str, DataFrame]:
    """The five raw inputs as frames for chain_tables: workbooks by glob, folder or file, and the dump.

    Order workbooks whose name holds `archived` repeat what others have and are left out. `max_rows` is a limit of rows a
    file for trials.
    """
    spark.dataSource.register(XlsxSource)

    def book(path: str, **options: str) -> DataFrame:
        limit = {"max_rows": str(max_rows)} if max_rows else {}
        return spark.read.format("xlsx").options(path=path, **options, **limit).load()

    at = lambda places: "|".join(map(str, places))
    return {
        "lines": book(orders, columns="|".join(ORDER_HEADERS), exclude=archived), "bill_rows": book(bill_files, columns="|".join(BILL_HEADERS)), "summary_rows": book(summary_files, positions=at(SUMMARY_PLACES)),
        "invoice_rows": book(invoice_files, positions=at(INVOICE_PLACES)), "dump_rows": read_dump(spark, dump, list(DUMP_FIELDS), max_rows=max_rows),
    }
