"""One surviving record for each group of duplicates, chosen field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reconspark.functions.text import is_blank, number_blank
from reconspark.session import staged

#: Rows of a group that one window partition ranks.
PART_ROWS = 20_000


def field_blank(df: DataFrame, field: str) -> Column:
    """Blank test by the field's type: text by placeholders, numbers by null and NaN, others by null."""
    kind = dict(df.dtypes)[field]
    return is_blank(field) if kind == "string" else number_blank(field) if kind in ("double", "float") else F.col(field).isNull()


def survivors(rows: DataFrame, key: str, row_id: str, fields: tuple[str, ...], trust: str, recency: str, part_rows: int = PART_ROWS) -> DataFrame:
    """For each group of two or more rows with the same `key`: group_row_id, members and, for each field, the row_id
    whose value survives (null where the field is blank throughout).

    Rows are ranked in a window by completeness of the field, trust (small is best, null last), recency (late is
    best, null last) and row_id (large is best), so that the order is total and ties cannot occur. A group of more than
    `part_rows` rows is split over as many window partitions as it has parts of that size, each keeps its winners, and
    one aggregation ranks the winners of the parts, so no window grows with a group. The number of parts of each such
    group is staged: the planner sees its size and broadcasts it or joins it by shuffle. Null keys
    form no group. Repeated row_ids count as rows of their own and name the same row.
    """
    ranked = rows.select(
        F.col(key).alias("__k"), F.col(row_id).alias("__id"), F.coalesce(-F.col(trust).cast("long"), F.lit(-(2**60))).alias("__trust"),
        F.coalesce(F.col(recency).cast("timestamp"), F.timestamp_seconds(F.lit(-(10**10)))).alias("__late"),
        *[field_blank(rows, f).alias(f"__blank_{i}") for i, f in enumerate(fields)],
    ).where("__k is not null")
    sizes = ranked.groupBy("__k").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > part_rows)
    large = staged(sizes.select("__k", F.ceil(F.col("__n") / part_rows).alias("__parts")), "large-groups")
    ranked = ranked.join(large, "__k", "left").withColumn("__salt", F.when(F.col("__parts").isNotNull(), F.pmod(F.xxhash64("__id"), F.col("__parts"))).otherwise(0))
    part = W.partitionBy("__k", "__salt").orderBy(F.desc("__trust"), F.desc("__late"), F.desc("__id"))
    whole = part.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    place = F.struct("__trust", "__late", F.col("__id").alias("id"))
    best = [F.first(F.when(~F.col(f"__blank_{i}"), place), ignorenulls=True).over(whole).alias(f"__best_{i}") for i, _ in enumerate(fields)]
    parts = ranked.select("__k", "__salt", F.row_number().over(part).alias("__rn"), F.count(F.lit(1)).over(whole).alias("__n"), F.min("__id").over(whole).alias("__first"), *best).where("__rn = 1")
    groups = parts.groupBy("__k").agg(F.sum("__n").alias("members"), F.min("__first").alias("group_row_id"), *[F.max(f"__best_{i}")["id"].alias(f) for i, f in enumerate(fields)])
    return groups.where("members > 1").select("group_row_id", "members", *fields)


def by_field(found: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """group_row_id, field_name, value_row_id; no row for a field that is blank throughout."""
    long = found.select("group_row_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value_row_id")) for f in fields])).alias("x"))
    return long.select("group_row_id", "x.field_name", "x.value_row_id").where("value_row_id is not null")
