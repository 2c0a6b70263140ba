"""Typing-insensitive text: width, white space, quoting, blanks and placeholders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Full-width ASCII block and the ideographic space, by rule.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "

#: White space of any kind, zero-width characters included.
SPACE = r"[\s\p{Z}\u0085\u200b-\u200d\u2060\ufeff]"
QUOTE = r"""["'`\u00b4\u2018-\u201f\u00ab\u00bb\u2039\u203a\u300c-\u300f\u2032\u2033]"""

#: Texts that stand for no value, upper case, without white space.
PLACEHOLDERS = ("", "-", "--", "---", "—", "——", "/", "N/A", "#N/A", "NA", "NULL", "NONE", "NIL", "NAN", "\\N", "无", "空", "暂无")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_width(c: Column | str) -> Column:
    """Full-width letters, digits, signs and spaces as their half-width forms; pure ASCII passes untouched."""
    return F.when(F.octet_length(_col(c)) == F.length(_col(c)), _col(c)).otherwise(F.translate(_col(c), _WIDE, _NARROW))


def squeeze(c: Column | str) -> Column:
    """Without white space of any kind."""
    return F.regexp_replace(_col(c), SPACE + "+", "")


def strip(c: Column | str) -> Column:
    """Without outer white space of any kind."""
    return F.regexp_replace(_col(c), f"^{SPACE}++|(?<!{SPACE}){SPACE}++$", "")


def clean_text(c: Column | str) -> Column:
    """Null as the empty text, else without outer white space."""
    return F.coalesce(strip(c), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """True for null, white space and placeholders; never null."""
    bare = F.upper(squeeze(half_width(c)))
    return F.when(_col(c).rlike("^[0-9A-Za-z]{5}"), F.lit(False)).otherwise(F.coalesce(bare.isin(*PLACEHOLDERS), F.lit(True)))


def number_blank(c: Column | str) -> Column:
    """True for null and NaN."""
    return F.coalesce(F.isnan(_col(c)) | _col(c).isNull(), F.lit(True))


def typed_key(c: Column | str) -> Column:
    """A key apart from typing: upper case, half width, without white space and quoting; null if blank.

    Spreadsheet quoting (="...") and a leading apostrophe count as quoting. Suffixes stay.
    """
    bare = F.upper(squeeze(half_width(c)))
    bare = F.regexp_replace(bare, "^=(?=" + QUOTE + ")", "")
    bare = F.regexp_replace(bare, QUOTE, "")
    return F.when(_col(c).rlike(r"^[0-9A-Z_-]{5,}+\z"), _col(c)).when(is_blank(c) | (bare == ""), F.lit(None)).otherwise(bare)


def trimmed_key(c: Column | str) -> Column:
    """A key apart from letter case and outer white space; null if blank."""
    return F.when(_col(c).rlike(r"^[0-9A-Z:_-]{5,}+\z"), _col(c)).when(is_blank(c), F.lit(None)).otherwise(F.upper(strip(c)))
