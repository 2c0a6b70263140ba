"""Timestamp texts against a brute-force reader made of strptime formats."""

import re
import unicodedata
from datetime import datetime, timedelta, timezone
from decimal import ROUND_HALF_UP, Decimal
from zoneinfo import ZoneInfo

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reconspark.operators.moments import estimate_zones, instants, offset_histories, with_instant

ABBR = {"CET": 1, "CEST": 2, "PST": -8, "PDT": -7, "EST": -5, "EDT": -4, "GMT": 0, "UTC": 0, "BST": 1, "AEST": 10, "AEDT": 11, "Z": 0, "z": 0}
CLOCKS = ["", " %H:%M:%S", " %H:%M:%S.%f", "T%H:%M:%S", "T%H:%M:%S.%f", " %H:%M", " %I:%M:%S %p"]
YEAR_FIRST = ["%Y-%m-%d", "%Y/%m/%d", "%Y.%m.%d"]


def to_ms(local: datetime, tz) -> int:
    at = local.replace(tzinfo=tz).astimezone(timezone.utc)
    micros = (at - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return (micros + 500) // 1000


def brute(text, zone, order):
    if text is None:
        return None
    t = " ".join(unicodedata.normalize("NFKC", text).split())
    if re.fullmatch(r"\d{13}", t):
        return int(t)
    if re.fullmatch(r"\d{10}", t):
        return int(t) * 1000
    tz = ZoneInfo(zone)
    if m := re.search(r"24[:时]00([:分]00秒?)?$|24时00分00秒$|240000$", t):
        start = brute(t[: m.start()] + m[0].replace("24", "00", 1), zone, order)
        if start is None:
            return None
        # The clock's next midnight, which is not 24 hours later where the clocks change.
        local = datetime.fromtimestamp(start / 1000, tz).replace(tzinfo=None) + timedelta(days=1)
        return to_ms(local, tz)
    if re.fullmatch(r"\d{5}(\.\d+)?", t):
        ms = int((Decimal(t) * 86_400_000).to_integral_value(ROUND_HALF_UP))
        return to_ms(datetime(1899, 12, 30) + timedelta(milliseconds=ms), tz)
    if m := re.search(r"(?<=\d\d)\s*(\[?)([A-Z][a-z]+/[A-Za-z_]+|UTC)\]?$", t):
        tz, t = ZoneInfo(m[2]), t[: m.start()]
    elif m := re.search(r"(?<=:\d\d|\d\d\d)\s*(?:UTC|GMT)?([+-])(\d\d?)(?::?(\d\d))?$", t):
        tz, t = timezone((1 if m[1] == "+" else -1) * timedelta(hours=int(m[2]), minutes=int(m[3] or 0))), t[: m.start()]
    elif m := re.search(r"(?<=\d\d)\s*([A-Z]{3,4}|[Zz])$", t):
        if m[1] in ABBR:
            tz, t = timezone(timedelta(hours=ABBR[m[1]])), t[: m.start()]
    if m := re.fullmatch(r"(\S+) (上午|下午)(.*)", t):
        h, rest = m[3].split(":", 1)
        t = f"{m[1]} {(int(h) % 12) + 12 if m[2] == '下午' else int(h) % 12:02d}:{rest}"
    xy = {"dmy": "%d{0}%m{0}%Y", "mdy": "%m{0}%d{0}%Y", "ymd": "%d{0}%m{0}%Y"}[order]
    days = YEAR_FIRST + [xy.format(s) for s in "-/."] + ["%d-%b-%Y", "%d %b %Y", "%b %d, %Y"]
    formats = [d + c for d in days for c in CLOCKS] + ["%Y年%m月%d日", "%Y年%m月%d日 %H时%M分%S秒"]
    if re.fullmatch(r"\d{8}|\d{14}", t):
        formats = ["%Y%m%d" if len(t) == 8 else "%Y%m%d%H%M%S"]
    for f in formats:
        try:
            return to_ms(datetime.strptime(t, f), tz)
        except ValueError:
            pass
    return None


@pytest.mark.parametrize("name,fields", [("wdt_orders_file", ("ship_time",)), ("huice_detail", ("business_date", "period_end"))])
def test_against_brute_force(spark, tiny, name, fields):
    files = spark.read.parquet(f"{tiny}/export_file.parquet")
    rows = spark.read.parquet(f"{tiny}/{name}.parquet")
    got = {(r.row_id, r.field_name): r.utc_ms for r in instants(rows, files, "row_id", fields, name).collect()}
    info = {r.source_file: (r.tz_name, r.date_order) for r in files.collect()}
    want = {}
    for r in rows.collect():
        for f in fields:
            ms = brute(r[f], *info[r.source_file])
            if ms is not None:
                want[r.row_id, f] = ms
    assert len(want) > 100
    assert got == want


CASES = [
    ("2026-03-29 02:30:00", "Europe/Berlin", "dmy", "2026-03-29 01:30:00"),
    ("2025-10-26 02:30:00", "Europe/Berlin", "dmy", "2025-10-26 00:30:00"),
    ("2025-11-31", "UTC", "ymd", None),
    ("25:61", "UTC", "ymd", None),
    ("2026-03-", "UTC", "ymd", None),
    ("########", "UTC", "ymd", None),
    ("", "UTC", "ymd", None),
    (None, "UTC", "ymd", None),
    ("x" * 50000, "UTC", "ymd", None),
    ("2025-10-02 下午12:05:13", "UTC", "ymd", "2025-10-02 12:05:13"),
    ("Oct 6, 2025 12:37:15 AM", "UTC", "mdy", "2025-10-06 00:37:15"),
    ("01-31-2026", "UTC", "mdy", "2026-01-31 00:00:00"),
    ("31.01.2026", "UTC", "dmy", "2026-01-31 00:00:00"),
    ("2025-10-26 02:30:00 CET", "Asia/Shanghai", "dmy", "2025-10-26 01:30:00"),
    ("2025-10-06 10:00:00", None, "ymd", None),
    ("2025-10-06T10:00:00Z", None, "ymd", "2025-10-06 10:00:00"),
    ("45950.5", "Asia/Shanghai", "ymd", "2025-10-20 04:00:00"),
    ("2025-10-06 24:00:00", "UTC", "ymd", "2025-10-07 00:00:00"),
    ("2025-10-25 24:00", "Europe/Berlin", "ymd", "2025-10-25 22:00:00"),
    ("2026-03-29 24:00:00", "Europe/Berlin", "ymd", "2026-03-29 22:00:00"),
    ("20251231240000", "Asia/Shanghai", "ymd", "2025-12-31 16:00:00"),
    ("31/12/2025 24:00:00", "UTC", "dmy", "2026-01-01 00:00:00"),
    ("2025年12月31日 24时00分00秒", "UTC", "ymd", "2026-01-01 00:00:00"),
    ("2025-10-06 24:00:01", "UTC", "ymd", None),
    ("2025-02-29 24:00:00", "UTC", "ymd", None),
    ("2025-10-06 25:00:00", "UTC", "ymd", None),
    ("2025-10-06 10:00:00 Nowhere/Land", "UTC", "ymd", None),
]


def test_cases(spark):
    df = spark.createDataFrame(pd.DataFrame(CASES, columns=["t", "z", "o", "want"]).astype(object).where(lambda x: x.notna(), None), "t string, z string, o string, want string")
    for r in with_instant(df, "t", "z", "o").withColumn("got", F.timestamp_millis("utc_ms").cast("string")).collect():
        assert r.got == r.want, r


def test_zone_is_estimated_where_none_is_declared(spark, tiny):
    files = spark.read.parquet(f"{tiny}/export_file.parquet")
    rows = spark.read.parquet("/root/testdata/sf0.01/wdt_orders_file.parquet").withColumn("tz_name", F.lit("clash"))
    blind = files.withColumn("tz_name", F.when(~F.col("source_file").contains("华东仓"), F.col("tz_name")))
    want = {(r.row_id, r.utc_ms) for r in instants(rows, files, "row_id", ("ship_time",), "t").collect()}
    got = {(r.row_id, r.utc_ms) for r in instants(rows, blind, "row_id", ("ship_time",), "t").collect()}
    assert len(got & want) / len(want) > 0.99


def test_estimate_finds_offset_histories(spark):
    rows = [("a", f"2025-10-{d:02d} 10:00:00+02:00") for d in range(1, 20)] + [("a", f"2025-11-{d:02d} 10:00:00+01:00") for d in range(1, 20)] + [("b", "2025-10-30 10:00:00"), ("c", None)]
    df = spark.createDataFrame(rows, "f string, t string").withColumn("at", F.lit("2025-11-20 00:00:00").cast("timestamp_ntz")).withColumn("o", F.lit("ymd"))
    got = {r.f: (r.zone, r.violations) for r in estimate_zones(df, "f", "t", "at", "o").collect()}
    assert got["a"] == ("Europe/Berlin", 0)
    assert set(got) == {"a", "b"}


def test_empty_tables(spark, tiny):
    files = spark.read.parquet(f"{tiny}/export_file.parquet")
    rows = spark.read.parquet(f"{tiny}/wdt_orders_file.parquet")
    assert instants(rows.limit(0), files, "row_id", ("ship_time",), "t").count() == 0
    assert instants(rows.limit(5), files.limit(0), "row_id", ("ship_time",), "t").columns == ["table_name", "row_id", "field_name", "utc_ms"]


def test_zones_of_all_dealt_fields(spark, tmp_path):
    from reconspark.plans.cleaning import p1_zones

    files = spark.createDataFrame([(f, None, "ymd", "2025-12-20 00:00:00") for f in ("a", "b")], "source_file string, tz_name string, date_order string, exported_at string").withColumn("exported_at", F.col("exported_at").cast("timestamp_ntz"))
    summer, winter = "2025-10-{:02d} 10:00:00+02:00", "2025-11-{:02d} 10:00:00+01:00"
    bills = [("a", b, t.format(k)) for t in (summer, winter) for k in range(1, 20) for b in (None, "########")] + [("b", t.format(k), None) for t in (summer, winter) for k in range(1, 20)]
    files.write.parquet(f"{tmp_path}/export_file.parquet")
    spark.createDataFrame(bills, "source_file string, business_date string, period_end string").write.parquet(f"{tmp_path}/huice_detail.parquet")
    spark.createDataFrame([], "source_file string, ship_time string, payment_time string").write.parquet(f"{tmp_path}/wdt_orders_file.parquet")
    got = {r.source_file: (r.zone, r.violations, r.evidence) for r in p1_zones(spark, str(tmp_path)).collect()}
    assert got == {"a": ("Europe/Berlin", 0, 76), "b": ("Europe/Berlin", 0, 38)}


def test_zones_of_a_whole_system(spark):
    """No file of a system declares its zone: the estimates read (nearly) all moments as the declared zones do."""
    folder = "/root/testdata/sf0.01"
    files = spark.read.parquet(f"{folder}/export_file.parquet")
    for name, fields, system, earlier in (("huice_detail", ("business_date", "period_end"), "huice", None), ("wdt_orders_file", ("ship_time",), "wdt", "payment_time")):
        rows = spark.read.parquet(f"{folder}/{name}.parquet")
        blind = files.withColumn("tz_name", F.when(F.col("source_system") != system, F.col("tz_name")))
        want = {(r.row_id, r.field_name, r.utc_ms) for r in instants(rows, files, "row_id", fields, "t").collect()}
        got = {(r.row_id, r.field_name, r.utc_ms) for r in instants(rows, blind, "row_id", fields, "t", earlier).collect()}
        assert len(got & want) / len(want) > 0.99, name


def test_sequence_bounds_the_offset(spark):
    """Without stated offsets, a known earlier moment and the ingestion leave one hour; the customary name of it wins."""
    rows = [("f", "2025-12-10 18:10:00", "2025-12-10T10:05:00Z", "2025-12-10 10:20:00"), ("f", "2025-12-12 09:00:00", "2025-12-12 07:00:00", "2025-12-12 09:00:00"), ("g", "2025-12-10 18:10:00", None, "2026-01-10 10:20:00")]
    df = spark.createDataFrame(rows, "f string, t string, e string, at string").withColumn("at", F.col("at").cast("timestamp_ntz")).withColumn("o", F.lit("ymd"))
    got = {r.f: (r.zone, r.violations, r.evidence) for r in estimate_zones(df, "f", "t", "at", "o", "e").collect()}
    assert got["f"] == ("Asia/Shanghai", 0, 3) and got["g"][1:] == (0, 1)
    assert estimate_zones(df.limit(0), "f", "t", "at", "o", "e").count() == 0


def test_histories_tell_zones_apart():
    bounds, histories = offset_histories(datetime(2025, 10, 1, tzinfo=timezone.utc), datetime(2026, 6, 30, tzinfo=timezone.utc))
    assert {"UTC", "Asia/Shanghai", "Europe/Berlin", "Europe/London", "America/Chicago", "Australia/Sydney"} <= set(histories) and "Asia/Hong_Kong" not in histories and len(histories) > 50
    for zone, offsets in histories.items():
        for at, want in zip([datetime(2025, 10, 1, tzinfo=timezone.utc).timestamp(), *bounds], offsets, strict=True):
            assert datetime.fromtimestamp(at, ZoneInfo(zone)).utcoffset() == timedelta(minutes=want)
    assert set(offset_histories(datetime(2026, 1, 1, tzinfo=timezone.utc), datetime(2026, 1, 2, tzinfo=timezone.utc))[1]) >= {"UTC", "Asia/Shanghai"}
