"""Roll-ups, shares, coverage and report columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status_rollup(df: DataFrame, measures: list[str], by: str = "result") -> DataFrame:
    """group_count and summed measures of each outcome; a sum over nulls only is null."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("group_count"), *[F.sum(m).alias(m) for m in measures])


def result_share(df: DataFrame, by: str = "result", total_label: str = "合计") -> DataFrame:
    """Outcome, group_count, share of all rows, and one total row; an empty table gives a total of 0 with share 0."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("group_count"))
    total = counts.agg(F.coalesce(F.sum("group_count"), F.lit(0)).alias("__all"))
    rows = counts.crossJoin(total).select(by, "group_count", (F.col("group_count").cast("double") / F.col("__all")).alias("share"))
    last = total.select(F.lit(total_label).alias(by), F.col("__all").alias("group_count"), F.when(F.col("__all") > 0, 1.0).otherwise(0.0).alias("share"))
    return rows.unionByName(last)


def period_rollup(df: DataFrame, date: str, grain: str, measures: list[str]) -> DataFrame:
    """period (yyyy-MM, yyyy-Qn or yyyy), row_count and summed measures of a date column; null dates are a period of their own."""
    forms = {"month": F.date_format(date, "yyyy-MM"), "quarter": F.concat(F.year(date).cast("string"), F.lit("-Q"), F.quarter(date).cast("string")), "year": F.year(date).cast("string")}
    return df.groupBy(forms[grain].alias("period")).agg(F.count(F.lit(1)).alias("row_count"), *[F.sum(m).alias(m) for m in measures])


def labelled_union(parts: dict[str, DataFrame], label: str = "source") -> DataFrame:
    """UNION ALL of frames of one schema, each with its label first."""
    out = None
    for name, df in parts.items():
        one = df.select(F.lit(name).alias(label), "*")
        out = one if out is None else out.unionByName(one)
    return out


def tall(df: DataFrame, name: str = "metric", value: str = "metric_value") -> DataFrame:
    """One row of numbers as (metric, value) rows; null counts as 0, as control totals report it."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(value)) for c in df.columns])
    return df.select(F.inline(pairs))


def disposition(result: Column | str, agreed: list[str], open_ended: list[str], one_sided: list[str]) -> Column:
    """What becomes of an outcome in a report: matched and removed, kept as difference, closed, or kept for review."""
    r = F.col(result) if isinstance(result, str) else result
    return F.when(r.isin(*agreed), "匹配剔除").when(r.isin(*open_ended), "保留差异").when(r.isin(*one_sided), "关闭").otherwise("保留复核")


def severity(result: Column | str) -> Column:
    """ok, warn or error by what the label contains, in this order."""
    r = F.col(result) if isinstance(result, str) else result
    return F.when(r.contains("差异") & ~r.contains("一致"), "error").when(r.contains("仅") | r.contains("未映射"), "warn").when(r.contains("差异"), "warn").otherwise("ok")
