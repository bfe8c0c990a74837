"""Sequences, spans, paging and samples."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sequence_within(df: DataFrame, keys: list[str], *order: Column, name: str = "seq") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def suffixed(df: DataFrame, key: str, *order: Column, name: str = "unique_key") -> DataFrame:
    """The key, with -2, -3 and so on from its second row on. Numbers that another row's key ends with are left out, so that no two are the same."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    ends = df.select(F.regexp_extract(key, r"^(.*)-(\d+)$", 1).alias("_k"), F.regexp_extract(key, r"^(.*)-(\d+)$", 2).try_cast("int").alias("_n")).filter("_n >= 2")
    taken = ends.groupBy("_k").agg(F.array_sort(F.collect_set("_n")).alias("_taken"))
    rows = df.withColumn("_nth", nth).join(taken, F.col(key) == F.col("_k"), "left")
    free = F.aggregate(F.coalesce("_taken", F.array().cast("array<int>")), F.col("_nth"), lambda n, t: F.when(t <= n, n + 1).otherwise(n))
    return rows.withColumn(name, F.when(F.col("_nth") > 1, F.concat_ws("-", F.col(key), free)).otherwise(F.col(key))).drop("_nth", "_k", "_taken")


def next_boundary(df: DataFrame, keys: list[str], start: str, last: Column, name: str = "end") -> DataFrame:
    """The next row's start, for the last row the given end."""
    return df.withColumn(name, F.coalesce(F.lead(start).over(Window.partitionBy(*keys).orderBy(start)), last))


def clipped(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Ends cut at the next start; of rows with one start the longest stays."""
    longest = F.row_number().over(Window.partitionBy(*keys, start).orderBy(F.desc(end)))
    one = df.withColumn("_n", longest).filter("_n = 1").drop("_n")
    after = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    return one.withColumn(end, F.least(F.col(end), F.coalesce(after, F.col(end))))


def greedy_spans(spans: Column) -> Column:
    """Of (start, end) spans those that overlap none kept before, by start, the longer first."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("neg"))))
    kept = F.aggregate(
        order,
        F.struct(F.lit(-1).cast("long").alias("reach"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("out")),
        lambda acc, s: F.when(
            s["start"] >= acc["reach"],
            F.struct((-s["neg"]).cast("long").alias("reach"), F.concat(acc["out"], F.array(F.struct(s["start"].cast("long").alias("start"), (-s["neg"]).cast("long").alias("end")))).alias("out")),
        ).otherwise(acc),
    )
    return kept["out"]


def merged_intervals(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """(keys, start, end) of the union of intervals; touching ones join."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_new", F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0))
    marked = marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def gaps(islands: DataFrame, keys: list[str], start: str, end: str, least: int) -> DataFrame:
    """(keys, gap_start, gap_end) between merged intervals, of at least so many units."""
    after = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    return islands.select(*keys, F.col(end).alias("gap_start"), after.alias("gap_end")).filter(F.col("gap_end") - F.col("gap_start") >= least)


def out_of_order(df: DataFrame, keys: list[str], order: str, position: str) -> DataFrame:
    """Rows whose position is below the highest of the rows before."""
    top = F.max(position).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_top", top).filter(F.col(position) < F.col("_top")).drop("_top")


def consecutive(ordinals: Column) -> Column:
    """Of ordinals in order those that follow the last one kept by one, or begin anew at 1."""
    return F.aggregate(
        ordinals,
        F.array().cast("array<int>"),
        lambda kept, o: F.when((o == 1) | ((F.size(kept) > 0) & (o == F.element_at(kept, F.greatest(F.size(kept), F.lit(1))) + 1)), F.concat(kept, F.array(o.cast("int")))).otherwise(kept),
    )


def page_bounds(page: int | None, size: int | None, most: int = 50) -> tuple[int, int, int]:
    """(page, size, offset): size None is 20, below 1 is 1, over the most is the most; page below 1 is 1."""
    size = 20 if size is None else min(most, max(1, size))
    page = max(1, page or 1)
    return page, size, (page - 1) * size


def paged(df: DataFrame, order: list[Column], page: int | None = 1, size: int | None = 20, most: int = 50) -> DataFrame:
    _, size, offset = page_bounds(page, size, most)
    return df.orderBy(*order).offset(offset).limit(size)


def draw(ident: Column, seed: str) -> Column:
    """The order of a seeded draw: the md5 of seed and id."""
    return F.md5(F.concat(F.lit(seed + ":"), ident.cast("string")))


def sampled(df: DataFrame, ident: str, n: int, seed: str = "s") -> DataFrame:
    return df.orderBy(draw(F.col(ident), seed), ident).limit(n)


def stratified(df: DataFrame, ident: str, stratum: Column, n: int, seed: str = "s") -> DataFrame:
    """About n rows: an equal quota per stratum, at least one, then what is missing from the rest; null strata only in the rest."""
    rows = df.withColumns({"_s": stratum, "_d": draw(F.col(ident), seed)})
    count = rows.agg(F.countDistinct("_s")).first()[0]
    quota = max(1, n // max(1, count))
    rank = F.row_number().over(Window.partitionBy("_s").orderBy("_d", ident))
    ranked = rows.withColumn("_first", F.col("_s").isNotNull() & (rank <= quota))
    return ranked.orderBy(F.desc("_first"), "_d", ident).limit(n).drop("_s", "_d", "_first")


def top_per(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    """The first n rows per key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_r", rank).filter(F.col("_r") <= n).drop("_r")


#: Where a uniform draw makes a Poisson(1) count of 1, 2 and so on.
POISSON = tuple(sum(math.exp(-1) / math.factorial(k) for k in range(n + 1)) for n in range(7))


def resampled(df: DataFrame, row_id: str, replicates: int, seed: int = 1) -> DataFrame:
    """Each row once per replicate `_b`, with `_t`, how often it is drawn: a Poisson(1) count by the md5 of seed, replicate and the row's id. Equal rows are drawn each by itself."""
    rows = df.withColumn("_b", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    hexes = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_b").cast("string"), F.col(row_id).cast("string"))), 1, 8)
    u = F.conv(hexes, 16, 10).cast("double") / float(1 << 32)
    return rows.withColumn("_t", sum((F.when(u >= c, 1).otherwise(0) for c in POISSON), F.lit(0)))


def bootstrap_ranks(df: DataFrame, ident: str, value: str, weight: str, row_id: str, replicates: int = 1000, seed: int = 1, low: float = 0.025, high: float = 0.975) -> DataFrame:
    """(id, low, high): percentiles of the rank of sum(value)/sum(weight) over bootstrap replicates. Replicates are made and summed where the rows are; one row per replicate and id is shuffled."""
    drawn = resampled(df.select(ident, value, weight, row_id), row_id, replicates, seed).groupBy("_b", ident).agg((F.sum(F.col(value) * F.col("_t")) / F.nullif(F.sum(F.col(weight) * F.col("_t")), F.lit(0))).alias("_rate"))
    ranked = drawn.withColumn("_rank", F.rank().over(Window.partitionBy("_b").orderBy(F.desc_nulls_last("_rate"))))
    return ranked.groupBy(ident).agg(F.percentile("_rank", low).alias("low"), F.percentile("_rank", high).alias("high"))


def per_tier(df: DataFrame, tiers: DataFrame, person: str, ident: str, n: int, seed: str = "s") -> DataFrame:
    """The first n rows, in seeded order, of each person in a tier (tiers: person, tier); a row id counts once."""
    one = df.join(tiers.select(F.col(person), "tier"), person).groupBy(ident).agg(F.min(F.struct("tier", person)).alias("_t")).select(ident, "_t.*")
    return top_per(one, ["tier", person], n, draw(F.col(ident), seed), F.col(ident))
