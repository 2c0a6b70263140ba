"""References to records that do not exist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reconspark.session import staged

#: References from which a key counts as heavy.
HEAVY_AT = 10_000


def _checked(refs: DataFrame, targets: DataFrame, period: list[str], heavy_at: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The verdict on the heavy keys, and the counts by key and period with their verdict: of heavy and of light keys."""
    counted = staged(refs.where("ref_key is not null").groupBy("ref_key", *period).agg(F.count(F.lit(1)).alias("reference_count")), "reference-counts")
    known = targets.select(F.col("target_key").alias("ref_key")).where("ref_key is not null").distinct().withColumn("__known", F.lit(True))
    heavy = counted.groupBy("ref_key").agg(F.sum("reference_count").alias("__n")).where(F.col("__n") >= heavy_at).select("ref_key")
    verdict = staged(heavy.join(known, "ref_key", "left").select("ref_key", F.col("__known").isNull().alias("orphan")), "heavy-keys")
    light = counted.join(verdict, "ref_key", "left_anti").join(known, "ref_key", "left")
    return verdict, counted.join(verdict, "ref_key"), light.withColumn("orphan", F.col("__known").isNull()).drop("__known")


def orphan_counts(refs: DataFrame, targets: DataFrame, period: list[str], heavy_at: int = HEAVY_AT) -> DataFrame:
    """ref_key, the `period` columns, reference_count and orphan (boolean): references by key and period, each key checked.

    References are counted by key and period before anything else, so a key has one row a period however many references
    it has. Keys with at least `heavy_at` references are checked once each and their verdict is staged, so that the
    planner sees its size: small it is broadcast, else joined by shuffle. All other keys meet the targets in a shuffled
    join that no heavy key reaches. Both parts are united. Null keys are no references; empty tables give no rows.
    """
    _, of_heavy, of_light = _checked(refs, targets, period, heavy_at)
    return of_heavy.unionByName(of_light)


def orphans(refs: DataFrame, targets: DataFrame, period: list[str], heavy_at: int = HEAVY_AT) -> DataFrame:
    """The rows of `refs` (ref_key, the `period` columns and any payload) whose ref_key is not in `targets` (target_key).

    The missing keys come from the same counts as in orphan_counts. Rows of heavy keys get the staged verdict: those that
    exist are left out at once, those that do not are kept and spread over all partitions; only rows of light keys have
    to meet the missing light keys, in one join of which the planner chooses the kind.
    """
    verdict, _, of_light = _checked(refs, targets, period, heavy_at)
    missing = of_light.where("orphan").select(F.col("ref_key").alias("__key"), F.lit(True).alias("__missing")).distinct()
    judged = refs.where("ref_key is not null").join(verdict.withColumnRenamed("orphan", "__heavy"), "ref_key", "left").where("__heavy is null or __heavy")
    # No key begins with a line break, since keys are trimmed, so that a spread row meets nothing.
    spread = F.concat(F.lit("\n"), F.xxhash64(*refs.columns).cast("string"))
    judged = judged.withColumn("__key", F.when(F.col("__heavy").isNotNull(), spread).otherwise(F.col("ref_key")))
    return judged.join(missing, "__key", "left").where("__heavy or __missing").select(*refs.columns)


def orphan_report(refs: DataFrame, targets: DataFrame, by: list[str], heavy_at: int = HEAVY_AT) -> DataFrame:
    """The columns `by` (table and period), reference_count and orphan_count, from the counts of orphan_counts."""
    checked = orphan_counts(refs, targets, by, heavy_at)
    return checked.groupBy(*by).agg(F.sum("reference_count").alias("reference_count"), F.sum(F.when(F.col("orphan"), F.col("reference_count")).otherwise(0)).alias("orphan_count"))
