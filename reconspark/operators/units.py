"""Quantities in different units and packs, converted to the base unit of their material. SQL expressions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reconspark.functions.frames import settled
from reconspark.functions.text import _col, half_width, is_blank, number_blank, squeeze, trimmed_key

#: Unit aliases (lower case, half width), canonical unit, base, factor to the base, offset.
#: Chinese customary units at their present legal value, foreign ones at the international avoirdupois value.
MEASURES = (
    ("g", "g", "1", ("g", "gram", "grams", "gm", "克")),
    ("kg", "g", "1000", ("kg", "kgs", "kilogram", "千克", "公斤", "㎏")),
    ("mg", "g", "0.001", ("mg", "毫克", "㎎")),
    ("t", "g", "1000000", ("t", "ton", "tonne", "吨")),
    ("jin", "g", "500", ("斤", "市斤")),
    ("liang", "g", "50", ("两", "市两")),
    ("qian", "g", "5", ("钱", "市钱")),
    ("dan", "g", "50000", ("担", "市担")),
    ("oz", "g", "28.349523125", ("oz", "ounce", "盎司")),
    ("lb", "g", "453.59237", ("lb", "lbs", "pound", "磅")),
    ("ml", "ml", "1", ("ml", "cc", "毫升", "㎖", "milliliter")),
    ("cl", "ml", "10", ("cl", "厘升")),
    ("dl", "ml", "100", ("dl", "分升", "㎗")),
    ("l", "ml", "1000", ("l", "liter", "litre", "升", "公升", "ℓ")),
    ("pc", "pc", "1", ("pc", "pcs", "ea", "ea.", "piece", "个", "只", "件", "枚", "张", "片")),
    ("pair", "pc", "2", ("对", "双", "pair")),
    ("dozen", "pc", "12", ("打", "dozen", "doz", "dz")),
    ("gross", "pc", "144", ("gross", "罗")),
    ("hundred", "pc", "100", ("百个", "百只")),
    ("thousand", "pc", "1000", ("千个", "千只")),
)
#: Packs and their aliases.
PACKS = (
    ("箱", ("箱", "整箱", "ctn", "carton", "case")),
    ("盒", ("盒", "box")),
    ("袋", ("袋", "bag")),
    ("包", ("包", "pkt", "packet", "pack")),
    ("罐", ("罐", "can", "tin")),
    ("瓶", ("瓶", "btl", "bottle")),
    ("桶", ("桶", "barrel", "bucket")),
    ("块", ("块",)),
    ("支", ("支",)),
    ("板", ("板",)),
)


def alias_table(spark: SparkSession) -> DataFrame:
    """alias, unit, base (null for a pack), factor decimal(20,10), unit_offset; about a hundred rows."""
    rows = [(a, u, b, f, "0") for u, b, f, names in MEASURES for a in names] + [(a, u, None, None, "0") for u, names in PACKS for a in names]
    df = spark.createDataFrame(rows, "alias string, unit string, base string, factor string, unit_offset string")
    return df.withColumns({c: F.col(c).cast("decimal(20,10)") for c in ("factor", "unit_offset")})


def _aliases(spark: SparkSession) -> Column:
    """The same table as a constant map alias -> unit, for use inside array expressions."""
    pairs = [(a, u) for u, _, _, names in MEASURES for a in names] + [(a, u) for u, names in PACKS for a in names]
    return F.create_map(*[F.lit(x) for p in pairs for x in p])


def _any(names: set[str]) -> str:
    """A pattern for any of the names, longer ones first."""
    return "(" + "|".join(map(re.escape, sorted(names, key=lambda n: (-len(n), n)))) + ")"


def _factors() -> Column:
    return F.create_map(*[x for u, _, f, _ in MEASURES for x in (F.lit(u), F.lit(f).cast("decimal(20,10)"))])


def _tidy(c: Column | str) -> Column:
    return F.lower(squeeze(half_width(c)))


def pack_sizes(specs: DataFrame) -> DataFrame:
    """material key, base_unit, counting unit and sizes (map pack -> amount in the base unit) of each spec text.

    A text names one measure and any number of pack counts, from inside out (20g/支，5支/盒，24盒/箱; 20g×5支×24盒/箱;
    净含量:20g；规格:6袋/箱) or from outside in (每箱24盒，每盒5支，每支20g; 1箱=20罐，每罐20g). Text after it may name the
    counting unit (计量单位：箱, 默认单位箱, 按箱计). A text without measure gives no packs, and a pack of 10^18 base units or
    more has no size. Counts may have up to four decimals.
    """
    spark = specs.sparkSession
    names, factors = _aliases(spark), _factors()
    text = _tidy("spec_text")
    packs = {a for _, packed in PACKS for a in packed}
    unit, pack = _any(packs | {a for *_, named in MEASURES for a in named}), _any(packs)
    df = specs.select(
        trimmed_key("sap_code").alias("sap_code"), trimmed_key("product_code").alias("product_code"), F.col("base_unit"),
        F.regexp_extract(text, "(?:计量单位[:：]?|默认单位|按)" + unit + "(?:计|$|[)])?", 1).alias("__count"),
        F.regexp_replace(text, "[,;。]*(计量单位|默认单位|[(]按).*$", "").alias("__t"),
    )
    df = df.withColumn("__n", F.regexp_extract_all("__t", F.lit(r"(\d+(?:\.\d+)?)" + unit), F.lit(1)))
    df = df.withColumn("__u", F.transform(F.regexp_extract_all("__t", F.lit(r"(\d+(?:\.\d+)?)" + unit), F.lit(2)), lambda u: F.try_element_at(names, u)))
    pair = F.arrays_zip(F.col("__n").alias("n"), F.col("__u").alias("u"))
    pair = F.filter(pair, lambda p: ~((p["n"] == "1") & (p["u"] == "箱")))
    df = df.withColumn("__p", pair)
    outward = F.map_contains_key(factors, F.element_at("__p", 1)["u"])
    df = df.where(F.size("__p") > 0).withColumn("__p", F.when(outward, F.col("__p")).otherwise(F.reverse("__p")))
    df = df.where(F.map_contains_key(factors, F.element_at("__p", 1)["u"]))
    outer = F.coalesce(F.nullif(F.regexp_extract("__t", "^(?:每|1)" + pack, 1), F.lit("")), F.nullif(F.regexp_extract("__t", "/" + unit + "$", 1), F.lit("")))
    df = df.withColumn("__outer", F.try_element_at(names, outer))
    first = F.element_at("__p", 1)["n"].try_cast("decimal(14,6)") * F.try_element_at(factors, F.element_at("__p", 1)["u"])
    start = F.struct(F.array().cast("array<struct<u:string,f:decimal(28,10)>>").alias("seen"), first.try_cast("decimal(28,10)").alias("f"))

    def grow(acc: Column, p: Column) -> Column:
        seen = F.concat(acc["seen"], F.array(F.struct(p["u"].alias("u"), acc["f"].alias("f"))))
        return F.struct(seen.alias("seen"), (acc["f"] * p["n"].try_cast("decimal(12,4)")).try_cast("decimal(28,10)").alias("f"))

    df = df.withColumn("__r", F.aggregate(F.slice("__p", F.lit(2), F.size("__p")), start, grow))
    entries = F.concat(F.col("__r.seen"), F.when(F.col("__outer").isNotNull(), F.array(F.struct(F.col("__outer").alias("u"), F.col("__r.f").alias("f")))).otherwise(F.array().cast("array<struct<u:string,f:decimal(28,10)>>")))
    sizes = F.map_from_entries(F.array_compact(F.transform(F.array_distinct(F.transform(entries, lambda e: e["u"])), lambda u: F.element_at(F.filter(entries, lambda e: e["u"] == u), 1))))
    return df.select("sap_code", "product_code", "base_unit", F.try_element_at(names, F.nullif("__count", F.lit(""))).alias("count_unit"), sizes.alias("sizes"))


def to_base_units(rows: DataFrame, specs: DataFrame, key: str = "row_id") -> DataFrame:
    """key, base_unit, milli_quantity of every row that can be converted.

    `rows` has the key, material_key (SAP code, or SKU: + product code), unit and quantity. The unit's text is read
    as a plain unit (kg, 箱), a sized unit (330ml/罐, 罐(330毫升), 0.3L) or a pack with a stated count (箱（10盒装）,
    4盒装箱, 12盒/箱); what it states wins over the spec, inner packs come from the spec. Blank units mean the spec's
    counting unit. No case, hence no row: unknown material, null or NaN quantity, unit exactly the base unit, unit of
    another dimension, pack not in the spec, blank unit without counting unit. A product with several specs that
    disagree is no case either. Halves are rounded away from zero; amounts that do not fit (quantities from 10^14, packs
    from 10^11 base units, results beyond a bigint) give no row. The aliases, a fixed table of about a hundred rows, are
    broadcast, so that no row is shuffled to meet the commonest unit.
    """
    packs = pack_sizes(specs).where("base_unit is not null")
    named = packs.select("base_unit", "count_unit", "sizes", F.explode(F.array("sap_code", F.concat(F.lit("SKU:"), F.col("product_code")))).alias("__m")).where("__m is not null")
    plain = specs.select(F.col("base_unit"), F.lit(None).cast("string").alias("count_unit"), F.lit(None).cast("map<string,decimal(28,10)>").alias("sizes"), F.explode(F.array(trimmed_key("sap_code"), F.concat(F.lit("SKU:"), trimmed_key("product_code")))).alias("__m"))
    named = named.unionByName(plain.where("__m is not null and base_unit is not null").join(named.select("__m"), "__m", "left_anti"))
    facts = named.groupBy("__m").agg(F.max(F.struct("base_unit", "count_unit", F.map_entries("sizes").alias("sizes"))).alias("a"), F.min(F.struct("base_unit", "count_unit", F.map_entries("sizes").alias("sizes"))).alias("b"))
    facts = facts.where("a <=> b").select("__m", F.col("a.base_unit").alias("base_unit"), F.col("a.count_unit").alias("count_unit"), F.map_from_entries("a.sizes").alias("sizes"))

    own = rows.select(F.col(key), F.col("material_key").alias("__key"), F.col("unit").alias("__unit"), F.col("quantity").alias("__q")).where(~number_blank("__q"))
    own = settled(own, __m=trimmed_key("__key"), __text=F.when(is_blank("__unit"), F.lit("")).otherwise(_tidy("__unit"))).drop("__key")
    numeric = F.col("__text").rlike("[0-9]")
    number = F.regexp_extract("__text", r"(?<![\d.])(\d++(?:\.\d++)?)([^\d/()]+?)装?(?:$|[/()]|(?<=装)\D)", 1)
    inner = F.regexp_extract("__text", r"(?<![\d.])(\d++(?:\.\d++)?)([^\d/()]+?)(?:装\D*$|$|[/()])", 2)
    own = settled(own, __number=F.when(numeric, number).otherwise(""), __alias=F.when(numeric, inner).otherwise(F.regexp_replace("__text", "(?<=.)装$", "")))
    own = own.withColumn("__n", F.when(F.col("__number") == "", F.lit(1).cast("decimal(12,4)")).otherwise(F.col("__number").try_cast("decimal(12,4)")))
    aliases = alias_table(rows.sparkSession)
    own = own.join(F.broadcast(aliases), own["__alias"] == aliases["alias"], "left").join(facts, "__m")
    unit = F.when(F.col("__text") == "", F.col("count_unit")).otherwise(F.col("unit"))
    factors = _factors()
    by_measure = F.when(F.coalesce("base", F.lit("")) == F.col("base_unit"), F.col("factor"))
    counted = F.when((F.col("__text") == "") & F.map_contains_key(factors, F.coalesce(unit, F.lit(""))), F.try_element_at(factors, unit))
    each = F.coalesce(by_measure, counted, F.try_element_at("sizes", unit)).try_cast("decimal(21,10)")
    # 14 and 11 digits before the point leave 12 behind it, so that the product is exact far below a thousandth.
    amount = (F.col("__q").try_cast("decimal(18,6)") * F.col("__n")).try_cast("decimal(22,8)") * each
    amount = amount + F.coalesce("unit_offset", F.lit(0)).try_cast("decimal(21,10)")
    out = settled(own, __milli=F.round(amount * 1000, 0).try_cast("long"))
    return out.where(F.col("__milli").isNotNull() & (F.col("__unit").isNull() | (F.col("__unit") != F.col("base_unit")))).select(key, "base_unit", F.col("__milli").alias("milli_quantity"))
