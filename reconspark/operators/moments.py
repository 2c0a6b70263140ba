"""Mixed timestamp texts as UTC instants, and zones estimated where none is known.

All parsing is built-in expressions: one pattern decides the form of a text, one replacement brings
its parts into a fixed order. No Python runs per row and nothing is shuffled but the zone evidence,
which is aggregated per file, hour and offset first.
"""

from __future__ import annotations

import zoneinfo
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reconspark.functions.frames import settled
from reconspark.functions.text import SPACE, _col, half_width, is_blank
from reconspark.session import staged

_CLOCK = r"(?:[ t,]*(上午|下午)?\s*(\d{1,2})[:时](\d{1,2})(?:[:分](\d{1,2})(?:[.,](\d+))?秒?)?\s*([ap]m)?)?$"
_YMD = r"^(\d{4})[-/.年](\d{1,2})[-/.月](\d{1,2})日?" + _CLOCK
_XXY = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})" + _CLOCK
_DNY = r"^(\d{1,2})[- ]([a-z]{3,9})\.?[- ,]+(\d{4})" + _CLOCK
_NDY = r"^([a-z]{3,9})\.? +(\d{1,2}),? +(\d{4})" + _CLOCK
_DIGITS = r"^(\d{4})(\d{2})(\d{2})(?:(\d{2})(\d{2})(\d{2})?)?$"
#: The commonest form, cut by position instead of by pattern.
_PLAIN = r"^\d{4}-\d{2}-\d{2}(?:[ Tt]\d{2}:\d{2}:\d{2})?$"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

#: Zone abbreviations as offsets. CST is read as China Standard Time.
ABBREVIATIONS = {
    "Z": "+00:00", "UT": "+00:00", "UTC": "+00:00", "GMT": "+00:00", "WET": "+00:00", "BST": "+01:00", "WEST": "+01:00",
    "CET": "+01:00", "CEST": "+02:00", "EET": "+02:00", "EEST": "+03:00", "MSK": "+03:00", "IST": "+05:30", "CST": "+08:00",
    "HKT": "+08:00", "SGT": "+08:00", "JST": "+09:00", "KST": "+09:00", "AEST": "+10:00", "AEDT": "+11:00", "NZST": "+12:00",
    "NZDT": "+13:00", "EST": "-05:00", "EDT": "-04:00", "CDT": "-05:00", "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
}

_ZONE = (
    r"(?<=\d:\d{2}|\d:\d{2}:\d{2}|:\d{2}\.\d{1,9})\s*("
    r"(?:[Uu][Tt][Cc]|[Gg][Mm][Tt])?\s?[+-]\d{1,2}(?::?\d{2})?|\[[A-Za-z][A-Za-z0-9_+/-]*\]|[A-Z][A-Za-z]+/[A-Za-z_/+-]+|"
    + "|".join(sorted(ABBREVIATIONS, key=len, reverse=True)) + r"|z|utc|gmt)$"
)

#: Names by which a zone goes first among those with the same offsets throughout the evidence; all others follow by name.
CUSTOMARY = (
    "UTC", "Asia/Shanghai", "Europe/Berlin", "Europe/London", "America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles", "Australia/Sydney", "Asia/Tokyo", "Asia/Kolkata",
)
#: Minutes to which evidence on offsets is cut; every present offset is a multiple of 15 minutes within 14 hours.
_STEP, _FAR = 15, 900


def _tidy(c: Column | str) -> Column:
    return F.when(_col(c).rlike("^[!-~]++(?: [!-~]++)*+$"), _col(c)).otherwise(F.trim(F.regexp_replace(half_width(c), SPACE + "+", " ")))


def _zone_id(raw: Column) -> Column:
    """A stated zone or offset as a zone id; null for the empty text."""
    bare = F.translate(raw, "[]", "")
    upper = F.upper(bare)
    signed = F.regexp_replace(upper, r"^(?:UTC|GMT)?\s?(?=[+-])", "")
    digits = F.translate(signed, "+:-", "")
    hours = F.when(F.length(digits) > 2, F.substring(F.lpad(digits, 4, "0"), 1, 2)).otherwise(F.lpad(digits, 2, "0"))
    minutes = F.when(F.length(digits) > 2, F.right(digits, F.lit(2))).otherwise(F.lit("00"))
    offset = F.concat(F.substring(signed, 1, 1), hours, F.lit(":"), minutes)
    known = F.create_map(*[F.lit(x) for pair in ABBREVIATIONS.items() for x in pair])
    return F.when(F.coalesce(raw, F.lit("")) == "", F.lit(None)).when(bare.contains("/"), bare).when(raw.rlike(r"[+-]\d"), offset).otherwise(F.coalesce(F.try_element_at(known, upper), bare))


def _with_zone(df: DataFrame, text: str, into: str, rest: str) -> DataFrame:
    """Adds `into`, the zone id that the tidy text states after its time of day, and `rest`, the text before it."""
    plain = F.col(text).rlike(_PLAIN)
    stated = F.col(text).rlike(r":\d{2}.*[^\d秒]$|[+-]\d{1,2}(:?\d{2})?$")
    df = settled(df, __raw=F.when(~plain & stated, F.regexp_extract(text, _ZONE, 1)))
    before = F.trim(F.left(F.col(text), F.length(text) - F.length("__raw")))
    return settled(df, **{into: _zone_id(F.col("__raw")), rest: F.lower(F.when(F.coalesce("__raw", F.lit("")) == "", F.col(text)).otherwise(before))}).drop("__raw")


def _fields(text: Column, date_order: Column | str) -> Column:
    """year|month|day|half of day|hour|minute|second|fraction of a local text; null for other forms."""
    clock = "$4$9|$5|$6|$7|$8"
    xxy = F.regexp_replace(text, _XXY, "$1|$2|$3|" + clock)
    first, second = F.split_part(xxy, F.lit("|"), F.lit(1)), F.split_part(xxy, F.lit("|"), F.lit(2))
    order = F.coalesce(_col(date_order), F.lit("ymd"))
    month_first = (order == "mdy") | ((order == "ymd") & (second.cast("int") > 12))
    rest = F.regexp_replace(text, _XXY, clock)
    year = F.split_part(xxy, F.lit("|"), F.lit(3))
    named = F.when(text.rlike(_DNY), F.regexp_replace(text, _DNY, "$3|$2|$1|" + clock)).when(text.rlike(_NDY), F.regexp_replace(text, _NDY, "$3|$1|$2|" + clock))
    cut = F.concat_ws("|", F.substring(text, 1, 4), F.substring(text, 6, 2), F.substring(text, 9, 2), F.lit(""), F.substring(text, 12, 2), F.substring(text, 15, 2), F.substring(text, 18, 2), F.lit(""))
    return (
        F.when(text.rlike(_PLAIN), cut)
        .when(text.rlike(_YMD), F.regexp_replace(text, _YMD, "$1|$2|$3|" + clock))
        .when(text.rlike(_XXY), F.concat_ws("|", year, F.when(month_first, first).otherwise(second), F.when(month_first, second).otherwise(first), rest))
        .when(text.rlike(r"^(\d{8}|\d{12}|\d{14})$"), F.regexp_replace(text, _DIGITS, "$1|$2|$3||$4|$5|$6|"))
        .when(text.rlike("[a-z]{3}"), named)
    )


def _local_ms(text: Column) -> Column:
    """Milliseconds of a spreadsheet serial day count on the local clock, else null."""
    serial = F.when(text.rlike(r"^[2-6]\d{4}(\.\d+)?$"), text.try_cast("decimal(30,15)"))
    return F.round((serial - 25569) * 86_400_000).cast("long")


def with_instant(df: DataFrame, text: str, zone: str, date_order: str, into: str = "utc_ms") -> DataFrame:
    """Adds `into` (bigint), the instant in ms since 1970 UTC that the text names, rounded to the nearest.

    Forms: year-first, day- or month-first by `date_order` (ymd, dmy, mdy), month names, twelve-hour clocks
    (AM/PM, 上午/下午), packed digits, epoch seconds and milliseconds, spreadsheet serials, full-width characters.
    A zone in the text wins over the column `zone`. 24:00:00 is 0:00 of the next day. A local time that occurs twice is the earlier instant, one that
    the clock skipped is read with the offset before the change, a date is its 00:00. Null, blank, unreadable and
    impossible texts, and local texts without any zone, give null. The row count never changes.
    """
    temp = ["__m_text", "__m_zone", "__m_body", "__m_part", "__m_serial"]
    df = settled(df, __m_text=F.when(~is_blank(text), _tidy(text)))
    df = _with_zone(df, "__m_text", "__m_zone", "__m_body")
    df = settled(df, __m_part=F.split(_fields(F.col("__m_body"), F.col(date_order)), r"\|", -1), __m_serial=_local_ms(F.col("__m_body")))

    part = lambda k: F.col("__m_part")[k]
    name_at = F.position(F.substring(part(1), 1, 3), F.lit(_MONTHS))
    month = F.when(part(1).rlike(r"^\d"), part(1).try_cast("int")).when(name_at % 3 == 1, F.floor((name_at + 2) / 3).cast("int"))
    hour, half = F.coalesce(part(4).try_cast("int"), F.lit(0)), part(3)
    hour = F.when(half == "", hour).when(half.isin("下午", "pm") & (hour < 12), hour + 12).when(half.isin("上午", "am") & (hour == 12), 0).otherwise(hour)
    df = settled(df, __m_y=part(0).try_cast("int"), __m_mo=month, __m_d=part(2).try_cast("int"), __m_h=hour)
    fraction = F.when(part(7) == "", F.lit("0")).otherwise(F.substring(part(7), 1, 6))
    df = settled(df, __m_mi=F.coalesce(part(5).try_cast("int"), F.lit(0)), __m_s=F.concat(F.coalesce(F.nullif(part(6), F.lit("")), F.lit("0")), F.lit("."), fraction).try_cast("decimal(8,6)"), __m_where=F.coalesce("__m_zone", zone))
    # A spreadsheet serial is taken apart into the same fields; its zone is the file's.
    rest, day = F.pmod("__m_serial", F.lit(86_400_000)), F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("__m_serial") / 86_400_000).cast("int"))
    sheet = F.try_make_timestamp(F.year(day), F.month(day), F.dayofmonth(day), F.floor(rest / 3_600_000).cast("int"), F.floor(rest % 3_600_000 / 60_000).cast("int"), (rest % 60_000 / 1000).cast("decimal(8,6)"), F.col(zone))
    df = settled(df, __m_sheet=F.when(F.col("__m_serial").isNotNull(), sheet))
    midnight = (F.col("__m_h") == 24) & (F.col("__m_mi") == 0) & (F.col("__m_s") == 0) & (half == "")
    after = F.date_add(F.try_make_timestamp_ntz("__m_y", "__m_mo", "__m_d", F.lit(0), F.lit(0), F.lit(0)).cast("date"), 1)
    df = settled(df, __m_next=F.when(midnight, after))
    late = F.col("__m_next").isNotNull()
    df = df.withColumns({"__m_y": F.when(late, F.year("__m_next")).otherwise(F.col("__m_y")), "__m_mo": F.when(late, F.month("__m_next")).otherwise(F.col("__m_mo")), "__m_d": F.when(late, F.dayofmonth("__m_next")).otherwise(F.col("__m_d")), "__m_h": F.when(late, 0).otherwise(F.col("__m_h"))})
    fits = F.col("__m_y").isNotNull() & (F.col("__m_h") < 24) & (F.col("__m_s") < 60)
    df = settled(df, __m_read=F.when(fits, F.try_make_timestamp("__m_y", "__m_mo", "__m_d", "__m_h", "__m_mi", "__m_s", "__m_where")))
    rounded = F.floor((F.unix_micros(F.coalesce("__m_sheet", "__m_read")) + 500) / 1000).cast("long")
    digits = F.when(F.col("__m_body").rlike(r"^(\d{10}|\d{13})$"), F.col("__m_body").try_cast("long"))
    epoch = F.when(digits < 10**11, digits * 1000).otherwise(digits)
    return settled(df, **{into: F.coalesce(rounded, epoch)}).drop(*temp, "__m_y", "__m_mo", "__m_d", "__m_h", "__m_mi", "__m_s", "__m_where", "__m_sheet", "__m_read", "__m_next")


def offset_histories(first: datetime, last: datetime) -> tuple[list[int], dict[str, list[int]]]:
    """Bounds (unix seconds) of the spans between the clock changes of any zone from `first` to `last`, and for each
    different history the zone that names it with its offset in minutes in each span.

    All zones of the installed time zone database are candidates; of those with one history the most customary name counts.
    """
    hours = [int(first.timestamp()) // 3600 * 3600 + 3600 * k for k in range(0, (int(last.timestamp()) - int(first.timestamp())) // 3600 + 2)]
    days, seen = hours[::24] + hours[-1:], {}
    for name in sorted(zoneinfo.available_timezones(), key=lambda z: (CUSTOMARY.index(z) if z in CUSTOMARY else len(CUSTOMARY), "/" not in z, z)):
        zone = zoneinfo.ZoneInfo(name)
        offset = lambda t, zone=zone: int(datetime.fromtimestamp(t, zone).utcoffset().total_seconds()) // 60
        daily = [offset(t) for t in days]
        changes = []
        for i, (x, y) in enumerate(zip(daily, daily[1:])):
            if x != y:
                within = [t for t in hours[24 * i : 24 * i + 25]]
                changes += [(v, offset(v)) for u, v in zip(within, within[1:]) if offset(u) != offset(v)]
        seen.setdefault((daily[0], *changes), name)
    bounds = sorted({t for _, *changes in seen for t, _ in changes})
    return bounds, {name: [next((o for t, o in reversed(changes) if t <= at), start) for at in [hours[0], *bounds]] for (start, *changes), name in seen.items()}


def _span(seconds: Column, bounds: list[int]) -> Column:
    """The number of bounds at or before a time."""
    return F.size(F.filter(F.array(*map(F.lit, bounds)).cast("array<bigint>"), lambda b: b <= seconds)) if bounds else F.lit(0)


def estimate_zones(rows: DataFrame, group: str, text: str, ingested: str, date_order: str, earlier: str | None = None) -> DataFrame:
    """The zone of each group (file) that its own texts violate least: group, zone, violations, evidence.

    Every text bears on the offset of the file's clock at its time. A text that states an offset or zone gives the offset
    itself. A local text must not lie after the ingestion time `ingested`, nor (sequence order) before the moment that
    `earlier` names in the same row with a zone of its own: both bound the offset. The evidence is counted by group, span
    between clock changes, kind and quarter of an hour before any zone is tried; then each different offset history of
    the time zone database is scored by the evidence it violates. The history with the fewest violations wins; among
    equals the one that most groups with stated offsets support, then the most customary name. Histories that do not
    differ during the evidence cannot be told apart and go by one name. Groups without readable text or with a null
    name do not come out.
    """
    own = rows.select(F.col(group).alias("__g"), F.col(text).alias("__t"), F.col(ingested).cast("timestamp").alias("__in"), F.col(date_order).alias("__o"), (F.col(earlier) if earlier else F.lit(None)).cast("string").alias("__e")).where("__g is not null")
    own = _with_zone(settled(own.withColumn("__utc", F.lit("UTC")), __tidy=_tidy("__t")), "__tidy", "__z", "__rest")
    own = with_instant(own, "__t", "__utc", "__o", "__ms").where("__ms is not null")
    if earlier:  # read without any zone, only texts with one of their own give a moment
        own = with_instant(own.withColumn("__nowhere", F.lit(None).cast("string")), "__e", "__nowhere", "__o", "__ems")
    else:
        own = own.withColumn("__ems", F.lit(None).cast("bigint"))
    epoch = F.trim("__t").rlike(r"^(\d{10}|\d{13})$")
    at = F.floor(F.col("__ms") / 1000)
    sign = F.when(F.substring("__z", 1, 1) == "-", -1).otherwise(1)
    parsed = sign * (F.substring("__z", 2, 2).cast("int") * 60 + F.substring("__z", 5, 2).cast("int"))
    regional = ((F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(at), F.col("__z"))) - at) / 60).cast("int")
    stated = F.when(F.col("__z").rlike(r"^[+-]"), parsed).when(F.col("__z").isNotNull(), regional)
    minutes = lambda ms: F.when(ms.isNotNull(), F.greatest(F.least(ms / 60_000, F.lit(_FAR)), F.lit(-_FAR)))
    latest = F.ceil(minutes(F.col("__ms") - F.unix_millis("__in")) / _STEP) * _STEP
    first = F.floor(minutes(F.col("__ms") - F.col("__ems")) / _STEP) * _STEP
    local = F.col("__z").isNull() & ~epoch
    told = {"is": stated, "from": F.when(local, latest), "to": F.when(local, first)}
    bears = F.array(*[F.struct(F.lit(k).alias("__kind"), v.cast("int").alias("__v")) for k, v in told.items()])
    evidence = staged(own.select("__g", (F.floor(at / 3600) * 3600).alias("__s"), F.inline(bears)).where("__v is not null").groupBy("__g", "__s", "__kind", "__v").agg(F.count(F.lit(1)).alias("__n")), "zone-evidence")
    ends = evidence.agg(F.min("__s").alias("a"), F.max("__s").alias("b")).first()
    moment = lambda s: datetime.fromtimestamp(min(max(s or 0, 0), 4_000_000_000), timezone.utc)
    bounds, histories = offset_histories(moment(ends.a), moment(ends.b))
    zones = rows.sparkSession.createDataFrame([(z, i, k, o) for i, (z, offsets) in enumerate(histories.items()) for k, o in enumerate(offsets)], "zone string, __rank int, __span int, __offset int")
    told = evidence.withColumn("__span", _span(F.col("__s"), bounds)).groupBy("__g", "__span", "__kind", "__v").agg(F.sum("__n").alias("__n"))
    o, v, kind = F.col("__offset"), F.col("__v"), F.col("__kind")
    wrong = F.when(kind == "is", o != v).when(kind == "from", o < v).otherwise(o > v)
    # As many rows as there are histories and spans in the time zone database.
    scored = told.join(F.broadcast(zones), "__span").groupBy("__g", "zone", "__rank").agg(F.sum(F.when(wrong, F.col("__n")).otherwise(0)).alias("violations"), F.sum("__n").alias("evidence"), F.max((kind == "is").cast("int")).alias("__sure"))
    least = scored.groupBy("__g").agg(F.min("violations").alias("violations"))
    tied = staged(scored.join(least, ["__g", "violations"]), "zone-ties")
    share = tied.groupBy("__g").agg((1.0 / F.count(F.lit(1))).alias("__share"))
    support = tied.where("__sure = 1").join(share, "__g").groupBy("zone").agg(F.round(F.sum("__share"), 9).alias("__support"))
    best = tied.join(support, "zone", "left").groupBy("__g").agg(F.min(F.struct(-F.coalesce("__support", F.lit(0.0)), "__rank", "zone", "violations", "evidence")).alias("b"))
    return best.select(F.col("__g").alias(group), F.col("b.zone").alias("zone"), F.col("b.violations").alias("violations"), F.col("b.evidence").alias("evidence"))


def instants(rows: DataFrame, files: DataFrame, key: str, fields: tuple[str, ...], table_name: str, earlier: str | None = None) -> DataFrame:
    """Every readable moment of a table: table_name, the key, field_name, utc_ms.

    `rows` has `key`, `source_file` and the fields; `files` describes each source_file (tz_name, date_order,
    exported_at). A file without tz_name, or not described, gets the zone that estimate_zones finds for it; `earlier` is a
    column of `rows` whose moment comes before those of the fields.
    """
    files = files.select("source_file", F.col("tz_name").alias("__tz"), F.col("date_order").alias("__order"), F.col("exported_at").alias("__exported")).dropDuplicates(["source_file"])
    known = rows.select(key, "source_file", (F.col(earlier) if earlier else F.lit(None)).cast("string").alias("__earlier"), *[F.col(f).cast("string").alias(f) for f in fields]).join(files, "source_file", "left")

    def tall(df: DataFrame) -> DataFrame:
        x = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("__v")) for f in fields]))
        return df.select(key, "source_file", "__tz", "__order", "__exported", "__earlier", x.alias("__x")).select("*", "__x.*").drop("__x")

    # Staged, the estimates are a table of known size (one row a file), so that no row is shuffled to meet them.
    guessed = staged(estimate_zones(tall(known.where("__tz is null")), "source_file", "__v", "__exported", "__order", "__earlier").select("source_file", F.col("zone").alias("__guess")), "file-zones")
    long = tall(known).join(guessed, "source_file", "left").withColumn("__where", F.coalesce("__tz", "__guess"))
    return with_instant(long, "__v", "__where", "__order").where("utc_ms is not null").select(F.lit(table_name).alias("table_name"), key, "field_name", "utc_ms")
