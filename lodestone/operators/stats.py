"""Robust statistics: exact medians, outlier fences by the median absolute deviation, majority votes, key profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CONSISTENT = 1.4826


def fence(df: DataFrame, value: str, by: list[str], most: float = 3.5, least: int = 4) -> DataFrame:
    """Rows whose robust deviate is at most `most`; groups smaller than `least`, or without deviation, stay whole.

    Medians come from two aggregations joined back by group, not from windows: a group of any size is never sorted whole
    in one task's window.
    """
    centre = df.groupBy(*by).agg(F.median(value).alias("_m"), F.count("*").alias("_n"))
    # the spread carries what the centre found, so that both joins read the same shuffle and the centre is made once
    spread = df.join(centre, by).groupBy(*by).agg(F.median(F.abs(F.col(value) - F.col("_m"))).alias("_d"), F.first("_m").alias("_m"), F.first("_n").alias("_n"))
    inside = (F.col("_n") < least) | (F.col("_d") == 0) | (F.abs(F.col(value) - F.col("_m")) <= most * CONSISTENT * F.col("_d"))
    return df.join(spread, by).filter(inside).drop("_m", "_n", "_d")


def robust_summary(df: DataFrame, value: str, by: list[str], fence_from: int = 10, few: int = 3, wide: float = 1.5) -> DataFrame:
    """n, median, low and high of what the fence leaves, and whether that deserves little confidence: few values, or a wide range."""
    kept = fence(df, value, by, least=fence_from)
    out = kept.groupBy(*by).agg(F.count("*").alias("n"), F.median(value).alias("median"), F.min(value).alias("low"), F.max(value).alias("high"))
    return out.withColumn("low_confidence", (F.col("n") < few) | ((F.col("high") - F.col("low")) > wide * F.col("median")))


def majority_tokens(df: DataFrame, tokens: str, by: list[str], item: str) -> DataFrame:
    """(by..., token): tokens in at least half of a group's items."""
    total = df.groupBy(*by).agg(F.countDistinct(item).alias("_n"))
    seen = df.select(*by, item, F.explode(F.array_distinct(tokens)).alias("token")).groupBy(*by, "token").agg(F.countDistinct(item).alias("_c"))
    return seen.join(total, by).filter(F.col("_c") >= F.ceil(F.col("_n") / 2)).select(*by, "token")


def first_by(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """The first row of each group."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("_r = 1").drop("_r")


def unique_accept(df: DataFrame, by: list[str], candidate: str) -> DataFrame:
    """(by..., candidate) of groups with exactly one distinct candidate: ambiguous means none."""
    return df.groupBy(*by).agg(F.min(candidate).alias("_lo"), F.max(candidate).alias("_hi")).filter("_lo = _hi").select(*by, F.col("_lo").alias(candidate))


def keyset_page(df: DataFrame, key: str, after, limit: int) -> DataFrame:
    """The next `limit` rows after a cursor, by key."""
    return df.filter(F.col(key) > after).orderBy(key).limit(limit)
