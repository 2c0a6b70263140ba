"""Months, names, platforms and keys of the reconciliation tables."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from reconspark.functions.text import _col

#: Words that carry no name, platform words in the order they are looked for.
NAME_NOISE = ("有限公司", "有限责任公司", "信息技术", "电子商务", "网络科技", "世纪", "官方", "旗舰店", "专卖店", "食品", "奶酪", "妙可蓝多", "蒙牛", "技术", "商贸")
PLATFORM_WORDS = ("天猫", "淘宝", "京东", "拼多多", "抖音", "快手", "微信", "视频号", "小红书", "唯品会")
SHOP_NOISE = ("抖音", "抖店", "快手", "小店", "天猫", "淘宝", "京东", "拼多多", "微信", "视频号", "小红书", "店铺")
#: Platform tokens and the platform they stand for, in order.
PLATFORM_TOKENS = (("抖", "抖音"), ("快手", "快手"), ("天猫", "天猫"), ("淘宝", "天猫"), ("京东", "京东"), ("寻梦", "拼多多"), ("拼多多", "拼多多"), ("视频号", "视频号"), ("微信", "视频号"), ("小红书", "小红书"), ("鲸灵", "鲸灵"), ("有赞", "有赞"))


def month_of(c: Column | str) -> Column:
    """yyyy-MM of the first year and month in a text, else the empty text."""
    pattern = r"(20\d{2})[-/.年](\d{1,2})"
    year, month = F.regexp_extract(_col(c), pattern, 1), F.regexp_extract(_col(c), pattern, 2)
    return F.when(F.coalesce(year, F.lit("")) != "", F.concat(year, F.lit("-"), F.lpad(month, 2, "0"))).otherwise("")


def month_of_file(name: Column | str, fallback: str = "") -> Column:
    """20yy-MM of a file name such as 25年3月, else the fallback."""
    year, month = (F.regexp_extract(_col(name), r"(25|26)年(\d{1,2})月", k) for k in (1, 2))
    return F.when(year != "", F.concat(F.lit("20"), year, F.lit("-"), F.lpad(month, 2, "0"))).otherwise(fallback)


def first_month(name: Column | str, year: str, months: int = 6) -> Column:
    """Month by the first of 1月, 2月 ... that the name contains; 11月 contains 1月 and counts as such."""
    return reduce(lambda w, k: w.when(_col(name).contains(f"{k}月"), f"{year}-{k:02d}"), range(2, months + 1), F.when(_col(name).contains("1月"), f"{year}-01"))


def next_day(c: Column | str) -> Column:
    """The day after an ISO date text, as text; null if it is no date."""
    return F.date_format(F.date_add(F.try_to_timestamp(F.substring(_col(c), 1, 10), F.lit("yyyy-MM-dd")).cast("date"), 1), "yyyy-MM-dd")


@pandas_udf(StringType())
def nfkc_lower(s: pd.Series) -> pd.Series:
    """NFKC and lower case; the JVM has no built-in for it. For distinct names."""
    return s.map(lambda t: unicodedata.normalize("NFKC", t or "").lower())


def normalize_name(c: Column | str) -> Column:
    """A company or shop name without noise words, spaces, brackets and punctuation."""
    bare = F.regexp_replace(nfkc_lower(_col(c)), "|".join(NAME_NOISE), "")
    return F.regexp_replace(bare, r"[\s()（）\-—_·.,，。/]+", "")


def normalize_shop(c: Column | str) -> Column:
    """normalize_name without platform words."""
    return F.regexp_replace(normalize_name(c), "|".join(SHOP_NOISE), "")


def platform_word(c: Column | str) -> Column:
    """The first platform word the text contains, else the empty text."""
    return reduce(lambda w, p: w.when(_col(c).contains(p), p), PLATFORM_WORDS[1:], F.when(_col(c).contains(PLATFORM_WORDS[0]), PLATFORM_WORDS[0])).otherwise("")


def platform_token(c: Column | str) -> Column:
    """The platform of the first token the text contains, else the empty text."""
    (t, p), rest = PLATFORM_TOKENS[0], PLATFORM_TOKENS[1:]
    return reduce(lambda w, x: w.when(_col(c).contains(x[0]), x[1]), rest, F.when(_col(c).contains(t), p)).otherwise("")


def inside_brackets(c: Column | str) -> Column:
    """All bracketed parts of a text, joined by a space."""
    return F.array_join(F.regexp_extract_all(_col(c), F.lit(r"[（(]([^）)]+)[）)]"), F.lit(1)), " ")


def surrogate(key: Column | str, prefix: str, own: Column | str) -> Column:
    """The key, or prefix and own number where the key is blank, so that blank keys never meet."""
    return F.when(F.coalesce(_col(key), F.lit("")) == "", F.concat(F.lit(prefix), _col(own))).otherwise(_col(key))


def business_month(date: Column | str, fallback: Column | str) -> Column:
    """yyyy-MM of a date text, or of the fallback where it is blank."""
    return F.substring(F.coalesce(F.nullif(_col(date), F.lit("")), _col(fallback)), 1, 7)


def material_key(sap_code: Column | str, product_code: Column | str) -> Column:
    """The SAP code, else SKU: and the product code, else the empty text."""
    s, p = F.coalesce(_col(sap_code), F.lit("")), F.coalesce(_col(product_code), F.lit(""))
    return F.when(s != "", s).when(p != "", F.concat(F.lit("SKU:"), p)).otherwise("")
