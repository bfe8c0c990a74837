"""Set operations on frames and arrays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_grains(grains: dict[str, DataFrame]) -> DataFrame:
    """The grains under each other with their name; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn("grain", F.lit(name)) for name, df in grains.items()))


def appended(old: Column, new: Column) -> Column:
    """The old values in order, then new ones that are not there."""
    return F.array_union(F.coalesce(old, F.array().cast("array<string>")), F.coalesce(new, F.array().cast("array<string>")))


def same_set(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))


def both_ways(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side only, with the side's name."""
    return a.subtract(b).withColumn("side", F.lit("left")).union(b.subtract(a).withColumn("side", F.lit("right")))


def merged_by_priority(df: DataFrame, key: Column, priority: str, fill: list[str]) -> DataFrame:
    """One row per key, that of least priority, whose nulls are filled from the next ones."""
    w = Window.partitionBy("_key").orderBy(priority)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = df.withColumn("_key", key)
    filled = rows.withColumns({c: F.coalesce(F.col(c), F.first(c, ignorenulls=True).over(whole)) for c in fill})
    return filled.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "_key")


def shared_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that both frames have, once each."""
    return a.select(key).intersect(b.select(key))
