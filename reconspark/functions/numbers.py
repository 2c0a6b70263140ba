"""Amounts and quantities that arrive as text or as floating point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reconspark.functions.text import _col, half_width, is_blank, squeeze

NUMBER = r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?"
#: Currency marks around an amount.
CURRENCY = r"(?i)(¥|￥|\$|€|£|元|圆|块钱|rmb|cny|usd|eur|gbp)"


def parse_number(c: Column | str) -> Column:
    """Blank or unreadable text as 0.0; thousands separators and outer spaces are dropped.

    The grammar is checked before the cast, so suffixes such as '1d' do not pass as numbers.
    """
    bare = F.replace(squeeze(c), F.lit(","), F.lit(""))
    return F.when(F.coalesce(bare.rlike(f"^{NUMBER}$"), F.lit(False)), bare.try_cast("double")).otherwise(F.lit(0.0))


def parse_amount(c: Column | str) -> Column:
    """An exported amount as decimal(38,6): currency marks, separators, exponents, accounting brackets (negative).

    Blank, placeholder and unreadable texts are null.
    """
    bare = F.regexp_replace(F.translate(squeeze(half_width(c)), "−﹣,", "--"), CURRENCY, "")
    negative = bare.rlike(r"^\(.*\)$")
    bare = F.regexp_replace(bare, r"[()]", "")
    value = F.when(bare.rlike(f"^{NUMBER}$"), bare.try_cast("double").try_cast("decimal(38,6)"))
    return F.when(~is_blank(c), F.when(negative, -value).otherwise(value))


def exact(c: Column | str) -> Column:
    """A double as decimal(38,6); NaN and infinities are null."""
    return _col(c).try_cast("decimal(38,6)")
