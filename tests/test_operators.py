"""Operators on hand-written rows: one case for each outcome, nulls, ties, empty tables and clashing names."""

import difflib

import pytest
from pyspark.sql import functions as F

from reconspark.functions import business as B
from reconspark.functions.numbers import parse_amount, parse_number
from reconspark.functions.text import is_blank, strip, trimmed_key, typed_key
from reconspark.operators import dedup, rollup
from reconspark.operators.allocate import pro_rata
from reconspark.operators.differences import difference_summary, differences
from reconspark.operators.matching import best_match, bridge_vote, cosine, graded, sequence_ratio
from reconspark.operators.orphans import orphan_counts, orphan_report, orphans
from reconspark.operators.recon import classify, exception_first, two_sided, within


def one(spark, value, *columns):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(*columns).first()


@pytest.mark.parametrize("text,want", [(" jy25 01\t", "JY2501"), ("ＪＹ２５－２", "JY25-2"), ('="JY25-2"', "JY25-2"), ("'JY25", "JY25"), ("JY25 ", "JY25"), ("JY2500001", "JY2500001"), ("", None), ("N/A", None), (None, None), ("''", None), ("  ", None), ("无", None)])
def test_typed_key(spark, text, want):
    assert one(spark, text, typed_key("v"))[0] == want


@pytest.mark.parametrize("text,want", [(" hc1 ", "HC1"), ("a b", "A B"), ("--", None), ("　x　", "X"), ("SKU:qp1", "SKU:QP1"), ("HC25100", "HC25100")])
def test_trimmed_key(spark, text, want):
    assert one(spark, text, trimmed_key("v"))[0] == want


def test_blank_and_strip(spark):
    for text, want in ((None, True), ("", True), ("　", True), ("null", True), ("N/A", True), ("-", True), ("0", False), ("NULLABLE", False), ("a" * 100_000, False), (" " * 100_000, True)):
        assert one(spark, text, is_blank("v"))[0] is want, text
    assert one(spark, " " * 50_000 + "x y" + " " * 50_000, strip("v"))[0] == "x y"
    assert one(spark, "x" + " " * 100_000 + "y", F.length(strip("v")))[0] == 100_002


@pytest.mark.parametrize("text,want", [("1,234.50", 1234.5), (" N/A ", 0.0), ("NULL", 0.0), ("", 0.0), (None, 0.0), ("abc", 0.0), ("1d", 0.0), ("-3", -3.0), ("1e3", 1000.0)])
def test_parse_number(spark, text, want):
    assert one(spark, text, parse_number("v"))[0] == want


@pytest.mark.parametrize("text,want", [("¥17.67", 17.67), ("(¥40.28)", -40.28), ("8.953000e+01", 89.53), ("1,141.18", 1141.18), ("17.72元", 17.72), (" １２．３ ", 12.3), ("-0.00", 0.0), ("N/A", None), (None, None), ("abc", None), ("0.0000001", 0.0)])
def test_parse_amount(spark, text, want):
    got = one(spark, text, parse_amount("v"))[0]
    assert (got is None and want is None) or float(got) == want


def test_business_functions(spark):
    months = spark.createDataFrame([("2026-1-3", "25年3月.xlsx"), ("2026/01/03", "汇总11月"), ("2026年1月3日", "26年12月"), ("bad", None)], "t string, f string")
    got = [tuple(r) for r in months.select(B.month_of("t"), B.month_of_file("f", "?"), B.first_month("f", "2026")).collect()]
    assert got == [("2026-01", "2025-03", "2026-03"), ("2026-01", "?", "2026-01"), ("2026-01", "2026-12", "2026-02"), ("", "?", None)]
    days = spark.createDataFrame([("2026-01-31 08:00",), ("2026/01/31",), ("45000",), (None,)], "d string")
    assert [r[0] for r in days.select(B.next_day("d")).collect()] == ["2026-02-01", None, None, None]
    names = spark.createDataFrame([("ＡＢ食品有限公司（天猫）旗舰店",), (None,), ("",)], "n string")
    assert [tuple(r) for r in names.select(B.normalize_name("n"), B.normalize_shop("n"), B.inside_brackets("n"), B.platform_word("n"), B.platform_token("n")).collect()] == [("ab天猫", "ab", "天猫", "天猫", "天猫"), ("", "", None, "", ""), ("", "", "", "", "")]
    keys = spark.createDataFrame([("S", "P"), ("", "P"), (None, ""), (None, None)], "s string, p string")
    assert [r[0] for r in keys.select(B.material_key("s", "p")).collect()] == ["S", "SKU:P", "", ""]
    assert [r[0] for r in keys.select(B.surrogate("s", "__", "p")).collect()] == ["S", "__P", "__", None]


def test_dedup_policies(spark):
    df = spark.createDataFrame([("a", 1, 10, "x"), ("a", 2, 20, None), ("a", 2, 20, None), (None, 3, 30, "y")], "k string, o int, m int, t string")
    rows = lambda d: sorted((tuple(r) for r in d.collect()), key=str)
    assert rows(dedup.keep_first(df, ["k"], ["o"])) == [("a", 1, 10, "x"), (None, 3, 30, "y")]
    assert rows(dedup.keep_last(df, ["k"], ["o"])) == [("a", 2, 20, None), (None, 3, 30, "y")]
    assert rows(dedup.upsert_sum(df, ["k"], ["m"])) == [("a", 50, 3), (None, 30, 1)]
    assert dedup.keep_first(df.limit(0), ["k"], ["o"]).count() == 0


def test_runs(spark):
    df = spark.createDataFrame([("f", i, k, i) for i, k in enumerate(["a", "a", "b", None, None, "a"])], "f string, r int, k string, q int")
    runs = dedup.run_length(df, ["f"], ["r"], "k", {"q": F.sum("q"), "n": F.count(F.lit(1)), "head": F.min("r")})
    assert [tuple(r) for r in runs.orderBy("run_no").collect()] == [("f", 1, "a", 1, 2, 0), ("f", 2, "b", 2, 1, 2), ("f", 3, None, 7, 2, 3), ("f", 4, "a", 5, 1, 5)]
    assert {(r.k, r.run_no) for r in dedup.last_run(runs, ["f"], "k").collect()} == {("a", 4), ("b", 2), (None, 3)}


def test_two_sided_and_classify(spark):
    a = spark.createDataFrame([("1", 1.0), ("2", 2.0), ("3", None), (None, 9.0)], "k string, x double")
    b = spark.createDataFrame([("1", 1.009), ("2", 2.02), ("4", 4.0), ("3", 3.0), (None, 9.0)], "k string, y double")
    both = two_sided(a, b, ["k"], {"x": 0.0})
    result = classify([(~F.col("in_left"), "right"), (~F.col("in_right"), "left"), (within("x", "y", 0.01), "same")], "differs")
    got = sorted((r.k or "", r.x, r.result) for r in both.withColumn("result", result).collect() if r.k != "3")
    assert got == [("", 0.0, "right"), ("", 9.0, "left"), ("1", 1.0, "same"), ("2", 2.0, "differs"), ("4", 0.0, "right")]
    three = both.withColumn("result", result).where("k = '3'").first()
    assert three.x is None and three.result == "differs"
    assert two_sided(a.limit(0), b.limit(0), ["k"]).count() == 0
    ordered = exception_first(spark.createDataFrame([("ok", 1), ("bad", 3), ("bad", 2)], "result string, k int"), ["ok"], "k").collect()
    assert [(r.result, r.k) for r in ordered] == [("bad", 2), ("bad", 3), ("ok", 1)]


def test_matching(spark):
    pairs = [("abcd", "bcde"), ("京东店", "京东"), ("", "x"), (None, "x"), ("lefeva", "levefa")]
    df = spark.createDataFrame(pairs, "a string, b string")
    want = [difflib.SequenceMatcher(None, a or "", b or "").ratio() if a and b else 0.0 for a, b in pairs]
    assert [r[0] for r in df.select(sequence_ratio("a", "b")).collect()] == want
    v = spark.createDataFrame([("s", "m", 3.0), ("s", "n", 4.0), ("z", "m", 0.0)], "shop string, d string, x double")
    o = spark.createDataFrame([("c", "m", 3.0), ("c", "n", 4.0)], "customer string, d string, x double")
    assert {(r.shop, round(r.cosine, 9)) for r in cosine(v, "shop", "customer", ["d"], "x", o).collect()} == {("s", 1.0), ("z", 0.0)}
    votes = spark.createDataFrame([("p", "h", "w1", 9, 1.0), ("p", "h", "w2", 1, 9.0), ("p", "i", "w2", 4, 1.0), ("p", "i", "w1", 4, 1.0)], "platform string, bill_shop string, order_shop string, matched_orders long, matched_receivable double")
    got = {(r.bill_shop, r.order_shop, r.bridge_share, r.bridge_status) for r in bridge_vote(votes, ["platform", "bill_shop"], "order_shop", "matched_orders", "matched_receivable").collect()}
    assert got == {("h", "w1", 0.9, "高置信"), ("i", "w1", 0.5, "低置信")}
    assert [r[0] for r in spark.createDataFrame([(0.72,), (0.55,), (0.1,), (None,)], "s double").select(graded("s", 0.72, 0.55)).collect()] == ["高置信", "待复核", "低置信", "低置信"]
    assert best_match(votes.limit(0), ["platform"], [F.asc("order_shop")]).count() == 0


def test_pro_rata(spark):
    items = spark.createDataFrame([("g1", 30.0, 1.0), ("g1", -70.0, 1.0), ("g2", 0.0, 2.0), ("g2", 0.0, 3.0), ("g3", 0.0, 0.0), ("g3", 0.0, 0.0), ("g9", 1.0, 1.0), (None, 1.0, 1.0)], "g string, amount double, qty double")
    bills = spark.createDataFrame([("g1", "jan", 100.0), ("g1", "feb", 7.0), ("g2", "jan", 50.0), ("g3", "jan", 9.0), ("g4", "jan", 9.0), (None, "jan", 4.0)], "g string, month string, bill double")
    out = pro_rata(bills, items, "g", "amount", "qty", {"share": "bill"})
    assert {(r.g, r.month, round(r.s, 9)) for r in out.groupBy("g", "month").agg(F.sum("share").alias("s")).collect()} == {("g1", "jan", 100.0), ("g1", "feb", 7.0), ("g2", "jan", 50.0), ("g3", "jan", 9.0)}
    assert sorted(r.alloc_rate for r in out.where("g = 'g2'").collect()) == [0.4, 0.6]
    assert {r.alloc_rate for r in out.where("g = 'g3'").collect()} == {0.5} and pro_rata(bills, items.limit(0), "g", "amount", "qty", {"share": "bill"}).count() == 0


def test_rollups(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 3)], "result string, m int")
    assert {tuple(r) for r in rollup.status_rollup(df, ["m"]).collect()} == {("a", 2, 1), ("b", 1, 3)}
    assert {(r.result, r.group_count, round(r.share, 3)) for r in rollup.result_share(df).collect()} == {("a", 2, 0.667), ("b", 1, 0.333), ("合计", 3, 1.0)}
    assert [tuple(r) for r in rollup.result_share(df.limit(0)).collect()] == [("合计", 0, 0.0)]
    assert {tuple(r) for r in rollup.tall(df.agg(F.sum("m").alias("s"), F.max(F.lit(None).cast("int")).alias("n"))).collect()} == {("s", 4.0), ("n", 0.0)}


COPY = [("1", "10.00", None), ("2", "10.01", "5"), ("2", "10.01", "5"), ("3", "10.02", "5"), ("5", None, None), (None, "1", "1")]


def test_differences(spark):
    left = spark.createDataFrame([("1", 10.0, 5.0, "q"), ("2", 10.0, 5.0, "q"), ("3", 10.0, 5.0, "q"), ("4", 1.0, 1.0, "q"), (None, 1.0, 1.0, "q")], "k string, a double, b double, difference string")
    right = spark.createDataFrame(COPY, "k string, a string, b string").withColumns({c: F.col(c).cast("double") for c in "ab"})
    got = sorted(tuple(r) for r in differences(left, right, "k", ("a", "b"), ("recon", "copy")).collect())
    assert got == [("1", "b"), ("3", "a"), ("4", "only_recon"), ("5", "only_copy")]
    assert {tuple(r) for r in difference_summary(differences(left, left.limit(0), "k", ("a",), ("recon", "copy"))).collect()} == {("only_recon", 4)}
    assert differences(left.limit(0), right.limit(0), "k", ("a",), ("x", "y")).count() == 0


def test_orphans_split_heavy_keys(spark):
    refs = spark.createDataFrame([(i, "hot" if i % 3 else "hot2", "f", "m1") for i in range(90)] + [(100, "x", "f", "m1"), (101, "y", "f", None), (102, None, "f", "m1")], "row_id long, ref_key string, ref_field string, file_month string")
    known = spark.createDataFrame([("hot", "f"), ("hot", "f"), ("x", "f"), (None, "f")], "target_key string, ref_field string")
    want = {i for i in range(90) if i % 3 == 0} | {101}
    for heavy_at in (5, 10_000):
        assert {r.row_id for r in orphans(refs, known, ["file_month"], heavy_at).collect()} == want
        assert {(r.ref_key, r.file_month, r.reference_count, r.orphan) for r in orphan_counts(refs, known, ["file_month"], heavy_at).collect()} == {("hot", "m1", 60, False), ("hot2", "m1", 30, True), ("x", "m1", 1, False), ("y", None, 1, True)}
        assert {tuple(r) for r in orphan_report(refs, known, ["file_month"], heavy_at).collect()} == {("m1", 91, 30), (None, 1, 1)}
    assert orphans(refs, known.limit(0), ["file_month"]).count() == 92 and orphans(refs.limit(0), known, ["file_month"]).count() == 0
def test_orphan_report_counts_hot_keys_a_period(spark):
    refs = spark.range(30_000).select(F.lit("f").alias("ref_field"), F.concat(F.lit("m"), F.col("id") % 3).alias("file_month"), F.when(F.col("id") % 2 == 0, "f|hot").otherwise("f|lost").alias("ref_key"))
    known = spark.createDataFrame([("f|hot",), ("g|lost",)], "target_key string")
    for heavy_at in (10_000, 10**9):
        found = orphan_report(refs, known, ["ref_field", "file_month"], heavy_at)
        assert {tuple(r) for r in found.collect()} == {("f", f"m{k}", 10_000, 5_000) for k in range(3)}


def test_keys_before_a_last_line_break(spark):
    df = spark.createDataFrame([(v,) for v in ("ABC12", "ABC12\n", "ABC12\r\n", "ABC12\u0085", "ABC12\u2028")], "v string")
    for key in (typed_key, trimmed_key):
        assert [r[0] for r in df.select(key("v")).collect()] == ["ABC12"] * 5


def test_exceptions_first_over_a_whole_reconciliation(spark, tiny):
    from reconspark.plans.chain import fixture_chain

    rows = fixture_chain(spark, tiny).order_bill_recon.select("platform_order_no", "result")
    got = [(r.result == "单号金额一致", r.result, r.platform_order_no) for r in exception_first(rows, ["单号金额一致"], "platform_order_no").collect()]
    assert len(got) == rows.count() and len({ok for ok, _, _ in got}) == 2
    assert [ok for ok, _, _ in got] == sorted(ok for ok, _, _ in got)
    assert got == sorted(got, key=lambda r: (r[0], r[1].encode(), (r[2] or "").encode()))
