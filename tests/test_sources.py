"""Workbook and dump readers, and the sinks, on tiny generated files."""

import json
import zipfile

import pytest

from reconspark import job
from reconspark.plans.chain import Scope
from reconspark.sources import exports
from reconspark.sources.sql_dump import read_dump
from reconspark.sources.xlsx import XlsxSource, column_number, header

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def book(path, rows, shared=(), target="worksheets/sheet1.xml"):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {NS}><sheets><sheet name="a" r:id="rId7"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships><Relationship Id="rId7" Target="{target}"/></Relationships>')
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {NS}>" + "".join(f"<si><r><t>{s[:1]}</t></r><r><t>{s[1:]}</t></r></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {NS}><sheetData>{rows}</sheetData></worksheet>")


@pytest.fixture()
def folder(tmp_path):
    head = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>金额</t></is></c><c r="D1" t="inlineStr"><is><t>金额</t></is></c></row>'
    book(tmp_path / "a.xlsx", head + '<row r="2"><c r="A2" t="s"><v>1</v></c><c r="C2"><v>1.5</v></c><c r="D2"><v>2.5</v></c></row><row r="4"><c r="A4" t="s"><v>99</v></c></row>', ["订单编号", "J1"])
    book(tmp_path / "b.XLSX", '<row><c t="inlineStr"><is><t>订单编号</t></is></c></row><row><c t="inlineStr"><is><t>J2</t></is></c></row>', target="/xl/worksheets/sheet1.xml")
    book(tmp_path / "c旧.xlsx", '<row r="1"><c r="A1"><v>x</v></c></row>')
    return str(tmp_path)


def test_workbooks(spark, folder):
    spark.dataSource.register(XlsxSource)
    read = lambda **o: spark.read.format("xlsx").options(path=folder, exclude="旧", **o)
    rows = read(columns="订单编号|金额|金额#2|缺").load().orderBy("source_file", "row_number").collect()
    assert [tuple(r) for r in rows] == [("J1", "1.5", "2.5", None, "a.xlsx", 2), ("99", None, None, None, "a.xlsx", 4), ("J2", None, None, None, "b.XLSX", 2)]
    by_place = read(positions="3|1", max_rows="1").load().orderBy("source_file").collect()
    assert [tuple(r)[:2] for r in by_place] == [("1.5", "J1"), (None, "J2")]
    assert read().load().columns == ["订单编号", "金额", "金额#2", "source_file", "row_number"]
    assert header(f"{folder}/a.xlsx") == ["订单编号", "", "金额", "金额#2"]
    assert [column_number(x) for x in ("A1", "AA3", "12", None)] == [1, 27, 0, 0]


def test_dump(spark, tmp_path):
    (tmp_path / "d.sql").write_bytes("INSERT INTO t\r\nVALUES ('a', ' 1 ', 'it''s, so');\r\nVALUES ('only', 'two');\r\nVALUES ('', NULL, '甲');\r\n".encode("utf-16"))
    rows = read_dump(spark, str(tmp_path / "d.sql"), ["x", "y", "z"]).orderBy("row_number").collect()
    assert [tuple(r)[:3] for r in rows] == [("a", "1", "it's, so"), ("", "NULL", "甲")]
    assert rows[0].row_number < rows[1].row_number and rows[0].source_file == "d.sql"
    assert read_dump(spark, str(tmp_path / "d.sql"), ["x", "y", "z"], max_rows=1).count() == 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "乙"), (1, None)], "n int, t string").orderBy("n")
    assert exports.write_csv(df, str(tmp_path / "x.csv")) == 2
    assert (tmp_path / "x.csv").read_bytes() == "﻿n,t\r\n1,\r\n2,乙\r\n".encode()
    assert exports.write_sample(df, str(tmp_path / "x.json"), 1) == 1
    assert json.loads((tmp_path / "x.json").read_text()) == {"headers": ["n", "t"], "rows": [[1, None]], "included_rows": 1, "limit": 1}
    made = []
    for _ in range(2):
        assert exports.stage(spark, str(tmp_path), "s", lambda: made.append(1) or df).count() == 2
    assert made == [1]
    assert exports.stage(spark, str(tmp_path), "s", lambda: made.append(1) or df, input="other").count() == 2 and made == [1, 1]
    bad = spark.createDataFrame([(float("nan"), 1.0)], "a double, b double")
    assert list(exports.faults({"t": bad})) == [("t", "a")]


def test_job(spark, tiny, tmp_path):
    assert job.main(["--input", tiny, "--output", str(tmp_path / "o"), "--queries", "flow_order_bill,p4_summary", "--format", "csv", "--sample", "10"]) == 0
    summary = json.loads((tmp_path / "o/summary.json").read_text())
    assert sum(r["group_count"] for r in summary["flow_order_bill"]) == summary["manifest"][0]["row_count"]


def cells(values, number):
    """A row whose cells are (column number, text) pairs."""

    def name(n):
        return (name((n - 1) // 26) if n > 26 else "") + chr(65 + (n - 1) % 26)

    return f'<row r="{number}">' + "".join(f'<c r="{name(k)}{number}" t="inlineStr"><is><t>{v}</t></is></c>' for k, v in values) + "</row>"


def table_book(path, headers, rows):
    book(path, "".join(cells(list(enumerate(r, 1)), n) for n, r in enumerate([headers, *rows], 1)))


def placed_book(path, rows):
    book(path, "".join(cells(sorted(r.items()), n) for n, r in enumerate([{1: "标题"}, *rows], 1)))


def test_mended_workbook(spark, tmp_path):
    rows = cells([(1, "订单编号"), (2, "数量")], 1) + cells([(1, "J1"), (2, "1")], 2) + cells([(1, "A&B\x01"), (2, "2")], 3).replace('<row r="3"', '<row r="3" x14ac:dyDescent="0.2"') + '<row r="4"><c r="A4"><v>lost</c></row>' + cells([(1, "J5"), (2, "5")], 5) + '<row r="6"><c r="A6">'
    book(tmp_path / "bad.xlsx", rows)
    spark.dataSource.register(XlsxSource)
    got = spark.read.format("xlsx").options(path=str(tmp_path / "*.xlsx"), columns="订单编号|数量").load().orderBy("row_number").collect()
    assert [tuple(r)[:2] for r in got] == [("J1", "1"), ("A&B", "2"), ("J5", "5")]


@pytest.mark.parametrize("encoding", ["utf-16", "utf-16-be", "utf-8"])
def test_dump_in_parts(spark, tmp_path, encoding):
    text = "".join(f"VALUES ('{k}', '{'款' * (k % 7)}ਊ一𝄞');\r\n" if k % 3 else "\n" for k in range(400)) + "VALUES ('last', 'x');"
    (tmp_path / "d.sql").write_bytes(text.encode(encoding))
    whole = read_dump(spark, str(tmp_path / "d.sql"), ["k", "v"], encoding).orderBy("row_number").collect()
    assert [r.k for r in whole] == [str(k) for k in range(400) if k % 3] + ["last"] and whole[6].v == "款" * 3 + "ਊ一𝄞"
    for part in (64, 1000):
        assert read_dump(spark, str(tmp_path / "d.sql"), ["k", "v"], encoding, part_bytes=part).orderBy("row_number").collect() == whole


def raw_inputs(folder):
    """Five raw inputs with one case each: blank and repeated keys, headers again, runs, types, fan-out, faults."""
    lines = ["订单编号", "店铺名称", "原始单号", "原始子单号", "订单状态", "订单类型", "交易时间", "付款时间", "发货时间", "应收金额", "分摊后总价", "数量", "SAP编码", "货品编号", "单位", "数量"]

    def line(order, shop, platform, kind, shipped, due, amount, qty, sap, product):
        return [order, shop, platform, "1", "已发货", kind, "2026-01-01", "", shipped, due, amount, qty, sap, product, "箱", "9"]

    shop = "天猫甲店"
    for name in ("orders", "bills", "summaries", "invoices"):
        (folder / name).mkdir()
    table_book(folder / "orders/26年1月.xlsx", lines, [
        line("J1", shop, "P1", "网店销售", "2026-01-05 10:00:00", "1,234.50", "600.25", "1", "M1", "Q1"), line("J1", shop, "P1", "网店销售", "2026-01-05 10:00:00", "7", "634.25", "2", "", "Q1"), line("", shop, "P9", "网店销售", "2026-01-05", "1", "1", "1", "M1", ""),
        line("J2", shop, "P2", "网店销售", "2026-01-06", "10.00", "10.00", "1", "M2", ""), line("J3", shop, "P3", "网店销售", "", "10.00", "10.00", "1", "M2", ""), line("J2", shop, "P2", "网店销售", "2026-01-06", "10.00", "5.00", "5", "M2", ""),
        line("J4", shop, "", "网店销售", "2026-01-07", "5", "5", "1", "M3", ""), line("订单编号", "店铺名称", "原始单号", "订单类型", "发货时间", "应收金额", "1", "1", "SAP编码", "货品编号"), line("J5", "", "P5", "网店销售", "2026-01-07", "3", "3", "1", "M3", ""),
        line("J6", shop, "P6", "赠品", "2026-01-08", "N/A", "abc", "1d", "", ""),
    ])
    table_book(folder / "orders/26年2月.xlsx", lines, [line("J3", shop, "P3", "网店销售", "2026-02-01", "10.00", "10.00", "1", "M2", "")])
    table_book(folder / "orders/已归档订单明细.xlsx", lines, [line("J9", shop, "P9", "网店销售", "2026-02-01", "99", "99", "1", "M2", "")])
    head = ["对账流水号", "平台", "店铺", "对账状态", "账期开始日期", "账期结束日期", "业务日期", "平台订单号", "正应收金额", "往期正应收金额", "负应收金额", "往期负应收金额", "收款金额（正实收）", "往期收款金额", "退款金额（负实收）", "往期退款金额", "正向差异金额", "逆向差异金额", "对账结果", "对账失败结果"]

    def bill(number, order, due, prior, cash, result="对账成功", day="2026-01-10"):
        return [number, "天猫", "天猫甲店", "已对账", "2026-01-01", "2026-01-31", day, order, due, prior, "0", "0", cash, "0", "0", "0", "0", "0", result, ""]

    table_book(folder / "bills/1.xlsx", head, [bill("R1", "P1", "1234.51", "100", "1234.51"), bill("R2", "P2", "10.02", "0", "10.00"), bill("R3", "P3", "99", "0", "98", "金额不一致"), bill("R4", "", "1", "0", "1"), bill("R5", "P8", "2", "0", "2", day=""), bill("对账流水号", "平台订单号", "0", "0", "0"), bill("", "P1", "1", "0", "1")])
    table_book(folder / "bills/2.xlsx", head, [bill("R1", "P1", "5", "0", "5")])
    place = lambda number, *v: dict(enumerate([number, "2026-02-01", "天猫", "天猫甲店", *v], 1))
    placed_book(folder / "summaries/汇总1月.xlsx.bak.xlsx", [place("月汇总流水号", *"123456789"), place("S1", "1", "1", "0", "0", "0", "0", "0", "0", "0"), place("S1", "3", "1,255.53", "1", "99", "98", "0", "0", "0", "0"), place("", *"123456789")])
    invoice = lambda doc, kind, item, qty, amount: {1: doc, 6: "I1", 15: kind, 32: item, 43: qty, 44: "箱", 49: amount, 50: "0", 51: "0", 104: "x"}
    placed_book(folder / "invoices/2026-01.XLSX", [invoice("D1", "标准发票（2C)", "M1", "1", "600.25"), invoice("D1", "标准发票（2C)", "M1", "2", "0"), invoice("D2", "标准发票（2C）", "M2", "1", "1"), invoice("D3", "标准发票（2C)", "M9", "1", "1")])
    row = lambda item, qty, amount, doc, kind, code, name, at: "VALUES ('" + "', '".join([item, "it''s, so", qty, "箱", "0", amount, "", "", doc, kind, code, name, at, "", "W1", "", ""]) + "');"
    dump = [
        "INSERT INTO t", row("M1", "9", "9", "D1", "Y005", "C1", "甲", "2026-01-05 09:00:00"), row("M1", "3", "1234.50", "D1", "Y005", "C1", "天猫甲店有限公司", "2026-01-05 09:00:00"), row("M2", "6", "15.00", "D2", "Y005", "C1", "天猫甲店有限公司", "2026-01-06 09:00:00"),
        row("M2", "1", "1354.53", "D4", "Y001", "C1", "天猫甲店有限公司", "2026-01-31"), row("M7", "1", "2", "", "Y001", "C2", "乙公司", "2026-01-31"), "VALUES ('short');",
    ]
    (folder / "dump.sql").write_bytes("\r\n".join(dump).encode("utf-16"))
    return {"orders": f"{folder}/orders", "bills": f"{folder}/bills/*.xlsx", "summaries": f"{folder}/summaries", "invoices": f"{folder}/invoices/*.XLSX", "dump": f"{folder}/dump.sql"}


def test_raw_inputs_to_reports(spark, tmp_path):
    paths = raw_inputs(tmp_path)
    out = tmp_path / "out"
    argv = ["--output", str(out), *[x for k, v in paths.items() for x in (f"--{k}", v)]]
    assert job.main(argv) == 0
    chain = job.raw_chain(spark, paths, Scope(), str(out / "stages"))
    orders = {r.order_no: r for r in chain.v["fx_order_file"].where("source_file like '%1月%'").collect()}
    assert set(orders) == {"J1", "J2", "J3", "J4", "J5", "J6", "订单编号"}  # order lines have no guard against a header again
    assert (orders["J1"].receivable, orders["J1"].allocated, orders["J1"].quantity, orders["J1"].line_count) == (1234.5, 1234.5, 3.0, 2)
    assert (orders["J2"].allocated, orders["J2"].quantity, orders["J2"].line_count) == (5.0, 5.0, 1)  # the last run counts
    assert orders["J6"].receivable == 0 and orders["J6"].quantity == 0
    items = {(r.order_no, r.ship_month, r.material_key) for r in chain.v["fx_item"].collect()}
    assert items == {("J1", "2026-01", "M1"), ("J1", "2026-01", "SKU:Q1"), ("J2", "2026-01", "M2"), ("J3", "2026-01", "M2"), ("J3", "2026-02", "M2"), ("J4", "2026-01", "M3")}
    assert {tuple(r) for r in chain.v["fx_product"].collect()} == {("Q1", "M1", 1)}
    assert {r.reconcile_id: r.current_receivable for r in chain.v["fx_current"].collect()} == {"R1": 1234.51, "R2": 10.02, "R3": 99.0, "R4": 1.0, "R5": 2.0}
    assert [(r.monthly_id, r.success_count, r.success_amount, r.source_file) for r in chain.v["fx_summary"].collect()] == [("S1", 3.0, 1255.53, "汇总1月.xlsx.bak.xlsx")]
    assert {(r.file_month, r.oms_sales_no, r.sap_qty) for r in chain.sap_key.collect()} == {("2026-01", "D1", 3.0), ("2026-01", "D3", 1.0)}
    assert {(r.document_no, r.item_num, r.outbound_month, r.item_name) for r in chain.v["fx_oms"].collect()} == {("D1", 3.0, "2026-01", "it's, so"), ("D2", 6.0, "2026-01", "it's, so"), ("D4", 1.0, "2026-01", "it's, so"), ("", 1.0, "2026-01", "it's, so")}
    flow = {r.platform_order_no: r.result for r in chain.flow_order_bill.collect()}
    # In doubles 1234.51 - 1234.5 is a hair under a cent, so that it is within the tolerance.
    assert flow == {"P1": "单号应收金额一致", "P2": "单号实收金额一致", "P3": "单号一致金额差异", "__WDT__J4": "旺店通原始单号为空", "P5": "仅订单", "P6": "仅订单", "__HC__R4": "仅账单", "P8": "仅账单"}
    full = {r.platform_order_no: r.result for r in chain.order_bill_recon.collect()}
    assert full["P1"] == "单号一致金额差异" and full["P5"] == "仅旺店通" and full["P8"] == "仅惠策"
    assert {(r.customer_code, r.wdt_shop, r.mapping_status) for r in chain.v["fx_shop_map"].collect()} == {("C1", "天猫甲店", "高置信")}
    assert {(r.customer_code, r.mapped_shop) for r in chain.v["fx_customer_map"].collect()} == {("C1", "天猫甲店"), ("C2", "")}
    assert {(r.customer_code, r.result) for r in chain.flow_bill_oms.collect()} == {("C1", "应收金额一致"), ("C2", "仅OMS月结")}
    summary = exports.read_summary(str(out / "summary.json"))
    assert {r["detail"]: r["row_count"] for r in summary["manifest"]}["flow_flow_order_bill"] == len(flow)
    assert {r["name"] for r in summary["parameters"]} >= {"sap_filter", "oms_sap_total_amount_tolerance", "period_start"} and summary["monthly"][-1]["month"] == "合计"
    assert exports.read_sample(spark, str(out / "flow_flow_shop_map.json")).columns[0] == "bill_month\n账单月份"
    csv = (out / "flow_flow_order_bill.csv").read_text(encoding="utf-8-sig").splitlines()
    assert csv[0].startswith("platform_order_no,") and len(csv) == len(flow) + 1
    # Another input makes stages of its own.
    other = job.raw_chain(spark, {**paths, "orders": f"{tmp_path}/orders/26年2月.xlsx"}, Scope(), str(out / "stages"))
    assert other.v["fx_order_file"].count() == 1
