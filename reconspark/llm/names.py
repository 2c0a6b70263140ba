"""Names of shops and customers, taken apart into brand, platform, kind and ordinal whatever their order."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Well-known platforms and how people write them (lower case); others are learned from the data.
PLATFORMS = {
    "天猫": ("天猫", "猫店", "tmall", "tm"),
    "京东": ("京东", "jd"),
    "抖音": ("抖音", "抖店", "douyin", "dy"),
    "拼多多": ("拼多多", "拼多", "pdd"),
}
#: Kinds of store, goods, and words that name no store.
KINDS = {"旗舰": ("旗舰店", "旗舰", "官旗"), "专卖": ("专卖店", "专卖"), "企业": ("企业店", "企业"), "专营": ("专营店", "专营")}
GOODS = ("烘焙", "食饮", "乳业", "厨房", "生活", "零食")
NOISE = ("官方", "停用", "已停", "作废")
#: Traditional characters of these words.
SIMPLE = str.maketrans("專賣營業東艦貓官鋪瀾歐", "专卖营业东舰猫官铺澜欧")
#: Words of company names that name no brand, longest first.
COMPANY = (
    "有限责任公司", "供应链管理", "电子商务", "网络科技", "线下客户", "有限公司", "co.,ltd", "商贸", "贸易", "食品", "科技", "公司", "foods", "trading", "ltd", "inc",
)
#: Cities and how people write them (lower case).
CITIES = {
    "广州": ("广州", "gz"), "杭州": ("杭州", "hz"), "宁波": ("宁波", "nb"), "上海": ("上海", "沪", "sh"), "深圳": ("深圳", "sz"), "厦门": ("厦门", "xm"), "合肥": ("合肥", "hf"),
    "成都": ("成都", "cd"), "青岛": ("青岛", "qd"), "武汉": ("武汉", "wh"), "苏州": ("苏州",), "长沙": ("长沙", "cs"),
}

_HAN = re.compile("[㐀-鿿]+")
_RUN = re.compile("[a-z]{2,}")
_TAIL = re.compile(r"[(（\[【]\s*(?:停用|原|旧|新|作废)\s*[)）\]】]|[-_—]\s*(?:旧|原|新)\s*$")
_SECOND = re.compile(r"(?:第)?([二三四五六七八九2-9])(?:号)?店")


@dataclass(frozen=True)
class Words:
    """Platforms and cities with their spellings, normalised and longest first."""

    platforms: dict[str, tuple[str, ...]]
    cities: dict[str, tuple[str, ...]]
    latin: dict[str, str] = field(init=False)

    def __post_init__(self) -> None:
        for known in (self.platforms, self.cities):
            for name, spelled in known.items():
                known[name] = tuple(sorted(set(spelled), key=lambda a: (-len(a), a)))
        object.__setattr__(self, "latin", {a: p for p, spelled in self.platforms.items() for a in spelled if a.isascii()})


KNOWN = Words(dict(PLATFORMS), dict(CITIES))
#: Shares of all rows from which a platform text counts as a platform's name, and as a spelling of one: by arithmetic
#: there are at most a hundred names and a hundred thousand spellings.
NAME_SHARE, SPELLING_SHARE = 0.01, 0.00001


@dataclass(frozen=True)
class Name:
    """What a name says; missing parts are the empty text."""

    brand: str = ""
    nick: str = ""
    platform: str = ""
    kind: str = ""
    goods: str = ""
    ordinal: str = ""


def normal(text: str | None) -> str:
    """Half width, lower case, simplified store words, one kind of space."""
    return unicodedata.normalize("NFKC", text or "").lower().translate(SIMPLE).replace("​", "").strip()


def _take(text: str, words: tuple[str, ...]) -> tuple[str, str]:
    for w in words:
        if w in text:
            return w, text.replace(w, " ", 1)
    return "", text


def shop_name(raw: str | None, words: Words = KNOWN) -> Name:
    """Parts of a shop's name; order, separators, brackets and decorations do not matter."""
    text = _TAIL.sub(" ", normal(raw))
    for w in NOISE:
        text = text.replace(w, "")
    platform = kind = goods = ordinal = ""
    for m in _RUN.finditer(text):
        if m[0] in words.latin and not platform:
            platform, text = words.latin[m[0]], text[: m.start()] + " " + text[m.end() :]
            break
    # Spaces are typing inside a name, separators are not: words may be split by either.
    text = re.sub(r"\s+", "", text)
    if m := _SECOND.search(text):
        ordinal, text = m[1].translate(str.maketrans("23456789", "二三四五六七八九")), text[: m.start()] + "店" + text[m.end() :]
    for p, names in words.platforms.items():
        if platform:
            break
        found, text = _take(text, tuple(n for n in names if not n.isascii()))
        platform = p if found else ""
    for k, names in KINDS.items():
        found, rest = _take(text, names)
        if found:
            kind, text = k, rest
            break
    for g in GOODS:
        found, rest = _take(text, (g,))
        if found:
            goods, text = g, rest
            break
    text = text.replace("店", " ", 1) if text.rstrip(" .*。").endswith("店") else text
    text = re.sub(r"(?<![㐀-鿿])[店站](?![㐀-鿿])", " ", text)
    brand = "".join(_HAN.findall(text))
    nick = "" if brand else "".join(_RUN.findall(text))
    return Name(brand, nick, platform, kind, goods, ordinal)


def customer_name(raw: str | None, words: Words = KNOWN) -> Name:
    """Brand or nickname and platform of a customer's company name.

    A name in brackets (brand and platform) is preferred; else city, company words and platform are taken out.
    """
    text = normal(raw)
    inside = re.findall(r"[(\[（]([^)\]）]+)[)\]）]", text)
    platform = ""
    inside = [x for x in inside if not any(x in names for names in words.cities.values())]
    rest = re.sub(r"[(\[（][^)\]）]*[)\]）]", " ", text)
    for part in [*inside, rest]:
        for m in _RUN.finditer(part):
            platform = platform or words.latin.get(m[0], "")
        for p, names in words.platforms.items():
            platform = platform or (p if any(n in part for n in names if not n.isascii()) else "")

    def core(part: str) -> str:
        for names in words.platforms.values():
            for n in names:
                if not n.isascii():
                    part = part.replace(n, " ")
        for w in COMPANY:
            part = part.replace(w, " ")
        for c in words.cities:
            part = part.replace(c, " ", 1)
        for g in GOODS:
            part = part.replace(g, " ")
        return "".join(_HAN.findall(part))

    brand = next((b for b in map(core, inside) if b), "") or core(rest)
    runs = [r for r in _RUN.findall(" ".join([*inside, rest])) if r not in words.latin and r not in COMPANY]
    return Name(brand, "".join(runs) if not brand else "", platform)


def _named(raw: str | None, known: dict[str, tuple[str, ...]]) -> str:
    text = re.sub(r"\s", "", normal(raw))
    return next((p for p, names in known.items() if any(text == n if n.isascii() else n in text for n in names)), "")


def platform_of(raw: str | None, words: Words = KNOWN) -> str:
    """The platform a text names, or the empty text."""
    return _named(raw, words.platforms)


def city_of(raw: str | None, words: Words = KNOWN) -> str:
    """The city a text names, or the empty text."""
    return _named(raw, words.cities)


def learned_words(said: DataFrame, cities: DataFrame) -> Words:
    """The known words and what the data add: platforms and cities that are on no list, with their spellings.

    `said` has shop and platform (as typed), `cities` city_text. A platform text that holds a hundredth of all rows names a
    platform. A rarer one is a spelling of the named platform that the most of its rows have in the shop's name, if any
    has. A city text on no list names a city, without 市 and without what stands before another such city. Only texts
    over a stated share of the rows are looked at, which bounds their number.
    """
    typed = said.where("shop is not null and platform is not null").select(F.lower("shop").alias("shop"), F.trim("platform").alias("platform"))
    counted = typed.groupBy("platform").agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    rows = counted.where(F.col("n") >= max(1, total * SPELLING_SHARE)).collect()
    count: dict[str, int] = {}
    raw: dict[str, list[str]] = {}
    for r in rows:
        text = re.sub(r"\s", "", normal(r.platform))
        count[text] = count.get(text, 0) + r.n
        raw.setdefault(text, []).append(r.platform)
    new = [t for t in count if len(t) > 1 and not platform_of(t)]
    platforms = {p: list(spelled) for p, spelled in PLATFORMS.items()}
    own = sorted((t for t in new if count[t] >= total * NAME_SHARE), key=lambda t: (-count[t], t))
    # A name inside which a shorter name stands (with a suffix) is a spelling of that.
    own = [t for t in own if not any(o != t and o in t for o in own)]
    platforms |= {t: [t] for t in own}
    rare = [t for t in new if t not in own]
    if rare and platforms:
        tried = sorted(platforms)
        inside = typed.where(F.col("platform").isin([x for t in rare for x in raw[t]])).groupBy("platform").agg(*[F.count_if(F.contains("shop", F.lit(p))).alias(f"c{i}") for i, p in enumerate(tried)])
        best: dict[str, list[int]] = {}
        for r in inside.collect():
            text = re.sub(r"\s", "", normal(r.platform))
            best[text] = [x + y for x, y in zip(best.get(text, [0] * len(tried)), r[1:], strict=True)]
        for t, found in sorted(best.items()):
            if max(found) > 0:
                platforms[tried[found.index(max(found))]].append(t)
    listed = cities.where("city_text is not null").groupBy("city_text").agg(F.count(F.lit(1)).alias("n"))
    whole = listed.agg(F.sum("n")).first()[0] or 0
    texts = {re.sub(r"\s|市$", "", normal(r.city_text)) for r in listed.where(F.col("n") >= max(2, whole * SPELLING_SHARE)).collect()}
    texts = {t for t in texts if len(t) > 1 and _HAN.fullmatch(t) and not city_of(t)}
    towns = {t: [t] for t in texts if not any(o != t and t.endswith(o) for o in texts)}
    return Words({p: tuple(v) for p, v in platforms.items()}, {**CITIES, **{t: tuple(v) for t, v in towns.items()}})


def subsequence(short: str, long: str) -> bool:
    """Whether `short` is `long` with characters left out."""
    rest = iter(long)
    return all(c in rest for c in short)


def character_pairs(name: str) -> set[str]:
    """Every two characters of a name, in order of code point; two spellings of one name share at least one such pair."""
    own = sorted(name)
    return {a + b for i, a in enumerate(own) for b in own[i + 1 :]}


def edits(a: str, b: str) -> int:
    """Edit distance in which swapping neighbours counts one."""
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            cost = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, last[j - 2] + 1)
            row.append(cost)
    return row[-1]


def same_brand(a: str, b: str) -> bool:
    """Spellings of one brand: one edit, or up to two characters left out while two remain, or both in one."""
    if a == b:
        return True
    short, long = sorted((a, b), key=len)
    if len(short) < 2:
        return False
    if edits(a, b) <= 1:
        return len(long) >= 3
    if len(long) - len(short) <= 2 and subsequence(short, long):
        return True
    return len(long) == len(short) and sorted(a) == sorted(b) and len(a) >= 3
