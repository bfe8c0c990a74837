"""Bucket, ratio, percentile and agreement reports."""

from __future__ import annotations

import decimal
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "(unknown)"


def known(c: Column, missing: str = UNKNOWN) -> Column:
    return F.coalesce(c, F.lit(missing))


def terms(df: DataFrame, key: Column, size: int = 10, missing: str | None = None, name: str = "key") -> DataFrame:
    """Buckets by falling count, ties by key; null keys only with a label for them."""
    rows = df.select((known(key, missing) if missing else key).alias(name)).filter(F.col(name).isNotNull())
    return rows.groupBy(name).agg(F.count("*").alias("count")).orderBy(F.desc("count"), name).limit(size)


def nested_terms(df: DataFrame, outer: Column, inner: Column, size: int = 100) -> DataFrame:
    """(outer, inner, count, outer_count) of the largest outer buckets."""
    counts = df.groupBy(outer.alias("outer"), inner.alias("inner")).agg(F.count("*").alias("count"))
    totals = counts.groupBy("outer").agg(F.sum("count").alias("outer_count")).orderBy(F.desc("outer_count"), "outer").limit(size)
    return counts.join(totals, "outer")


def coverage(df: DataFrame, by: list[Column], **conditions: Column) -> DataFrame:
    """Per group the total, and for each condition its count and percentage (0 of no rows)."""
    total = F.count("*")
    out = [total.alias("total")]
    for name, c in conditions.items():
        out += [F.count_if(c).alias(name), F.when(total > 0, 100.0 * F.count_if(c) / total).otherwise(0.0).alias(f"{name}_pct")]
    return df.groupBy(*by).agg(*out)


def coverage_of(frames: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(grain, total, covered, pct) of frames under one condition each; 0 of no rows."""
    from functools import reduce

    one = [df.agg(F.count("*").alias("total"), F.count_if(c).alias("covered")).select(F.lit(name).alias("grain"), "*", F.when(F.col("total") > 0, 100.0 * F.col("covered") / F.col("total")).otherwise(0.0).alias("pct")) for name, (df, c) in frames.items()]
    return reduce(DataFrame.union, one)


def cardinality(df: DataFrame, c: str, exact: bool = False) -> DataFrame:
    """(distinct, values): distinct values, by sketch unless exact, and values that are there."""
    return df.agg((F.count_distinct(F.col(c)) if exact else F.approx_count_distinct(c)).alias("distinct"), F.count(c).alias("values"))


def agreement(pairs: DataFrame, a: str, b: str, by: list[str] | None = None) -> DataFrame:
    """Matches, total, rate, absolute difference in sum and mean over pairs without null, and the pairs with one."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    delta = F.when(both, F.abs(F.col(a) - F.col(b)))
    return pairs.groupBy(*(by or [])).agg(
        F.count_if(both & (F.col(a) == F.col(b))).alias("matches"),
        F.count("*").alias("total"),
        F.when(F.count_if(both) > 0, F.count_if(both & (F.col(a) == F.col(b))) / F.count_if(both)).alias("rate"),
        F.sum(delta).alias("abs_delta"),
        F.avg(delta).alias("mean_abs_delta"),
        F.count_if(~both).alias("null_pairs"),
    )


def order_statistics(df: DataFrame, c: str, ranks) -> tuple[int, dict[int, object]]:
    """(n, {rank: value}) of the values that are there, ranks from 0; `ranks` gives the wanted ones for n. Values are dealt to sorted ranges, written, and counted per range, so that no task and not the driver holds more than a range or one number each."""
    spark = df.sparkSession
    from lectern.functions.session import settled

    values = df.filter(F.col(c).isNotNull()).select(F.col(c).alias("_v"))
    held = settled(values.repartitionByRange("_v").withColumn("_p", F.spark_partition_id()))
    counts = sorted((r._p, r.n) for r in held.groupBy("_p").agg(F.count("*").alias("n")).collect())
    n, before, places = sum(k for _, k in counts), 0, {}
    wanted = sorted(set(ranks(n))) if n else []
    for part, k in counts:
        for r in wanted:
            if before <= r < before + k:
                places.setdefault(part, {})[r - before] = r
        before += k
    if not wanted:
        return n, {}
    at = F.row_number().over(Window.partitionBy("_p").orderBy("_v")) - 1
    pairs = spark.createDataFrame([(p, i, r) for p, rows in places.items() for i, r in rows.items()], "_p int, _i int, _r long")
    found = held.filter(F.col("_p").isin(*places)).withColumn("_i", at).join(F.broadcast(pairs), ["_p", "_i"])  # one row a rank
    return n, {r._r: r._v for r in found.collect()}


def percentile_linear(c: Column | str, p: float) -> Column:
    """Interpolated between neighbours at (n - 1) p, for groups of bounded size."""
    return F.percentile(c, p)


def percentiles_linear(df: DataFrame, c: str, ps: dict[str, float]) -> DataFrame:
    """One row of percentiles of a whole column, interpolated between neighbours at (n - 1) p."""
    n, held = order_statistics(df, c, lambda n: {int(k) for p in ps.values() for k in (math.floor((n - 1) * p), math.ceil((n - 1) * p))})

    def value(p: float) -> float | None:
        at = (n - 1) * p
        low, high = math.floor(at), math.ceil(at)
        return None if not n else float(held[low]) + (float(held[high]) - float(held[low])) * (at - low)

    return df.sparkSession.createDataFrame([tuple(value(p) for p in ps.values())], ", ".join(f"`{k}` double" for k in ps))


def percentile_index(df: DataFrame, c: str, qs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """The sorted values at int(n q), without interpolation: of a whole column by ranges, of groups by rank."""
    if not by:
        rank = lambda n, q: min(int(math.floor(n * q)), n - 1)
        n, held = order_statistics(df, c, lambda n: {rank(n, q) for q in qs.values()})
        kind = df.schema[c].dataType.simpleString()
        return df.sparkSession.createDataFrame([tuple(held[rank(n, q)] if n else None for q in qs.values())], ", ".join(f"`{k}` {kind}" for k in qs))
    w = Window.partitionBy(*by)
    ranked = df.filter(F.col(c).isNotNull()).select(*by, c, F.row_number().over(w.orderBy(c)).alias("_r"), F.count("*").over(w).alias("_n"))
    return ranked.groupBy(*by).agg(*(F.max(F.when(F.col("_r") == F.least(F.floor(F.col("_n") * q) + 1, F.col("_n")), F.col(c))).alias(name) for name, q in qs.items()))


def distribution(df: DataFrame, c: str, below: float) -> DataFrame:
    one = df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.min(c).alias("least"), F.max(c).alias("most"), (F.count_if(F.col(c) < below) / F.count(c)).alias("share_below"))
    return one.join(percentiles_linear(df, c, {"median": 0.5}), F.lit(True)).select("n", "mean", "median", "least", "most", "share_below")  # one row each


def histogram(df: DataFrame, c: str, edges: tuple[float, ...]) -> DataFrame:
    """Counts of half-open buckets, numbered from 0; empty ones too."""
    bucket = sum((F.when(F.col(c) >= e, 1).otherwise(0) for e in edges), F.lit(0)).alias("bucket")
    every = df.sparkSession.range(len(edges) + 1).select(F.col("id").cast("int").alias("bucket"))
    counts = df.filter(F.col(c).isNotNull()).groupBy(bucket).agg(F.count("*").alias("count"))
    return every.join(counts, "bucket", "left").select("bucket", F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def bottom(df: DataFrame, c: str, ident: str, k: int = 15) -> DataFrame:
    return df.orderBy(F.asc_nulls_last(c), ident).limit(k)


def weighted_top(df: DataFrame, key: str, score: Column, size: int) -> DataFrame:
    """Keys by falling weighted sum, then count, then key; keys of sum zero go after the cut."""
    sums = df.groupBy(key).agg(F.sum(score).alias("weighted"), F.count("*").alias("n"))
    return sums.orderBy(F.desc("weighted"), F.desc("n"), key).limit(size).filter("weighted <> 0")


def shares(df: DataFrame, group: Column, value: str) -> DataFrame:
    """Per group the share of each value among those that are not null."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(known(group).alias("group"), F.col(value).alias("value")).agg(F.count("*").alias("count"))
    return counts.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy("group")))


def exact_sums(df: DataFrame, key: Column, value: Column, name: str = "key", **conditions: Column) -> DataFrame:
    """Per key the rows (n), those of each condition, and the sum of doubles as they are written, rounded once (total; null without values).

    Digits are summed by power of ten, of which a key has some 600 at most, so no sum hangs on the order of rows or on how long, large or small a value is.
    """
    written = F.split(value.cast("double").cast("string"), "E")
    # 0.001 to 10,000,000 are written without a power: 17 digits end by the twentieth place
    digits, power = F.element_at(written, 1).try_cast("decimal(38,20)"), F.coalesce(F.get(written, F.lit(1)).try_cast("int"), F.lit(0))
    rows = df.select(key.alias(name), power.alias("_power"), digits.alias("_digits"), F.when(digits.isNull(), value).alias("_not_finite"), *(c.alias(k) for k, c in conditions.items()))
    parts = rows.groupBy(name, "_power").agg(F.count("*").alias("n"), F.sum("_digits").alias("_digits"), F.sum("_not_finite").alias("_not_finite"), *(F.count_if(k).alias(k) for k in conditions))
    held = F.collect_list(F.when(F.col("_digits").isNotNull(), F.struct("_power", "_digits")))
    sums = parts.groupBy(name).agg(F.sum("n").alias("n"), *(F.sum(k).alias(k) for k in conditions), held.alias("_held"), F.sum("_not_finite").alias("_not_finite"))

    @F.arrow_udf("double")
    def joined(lists: pa.Array) -> pa.Array:
        with decimal.localcontext() as context:
            context.prec = 1000
            return pa.array([float(sum(p["_digits"].scaleb(p["_power"]) for p in held)) if held else None for held in lists.to_pylist()], pa.float64())

    return sums.select(name, "n", *conditions, F.coalesce("_not_finite", joined("_held")).alias("total"))


def first_seen(df: DataFrame, keys: list[str], order: str, value: str, most: int = 3) -> DataFrame:
    """Per key the rows' count and the first distinct values: least order per value first, so that no long list is gathered."""
    firsts = df.groupBy(*keys, value).agg(F.min(order).alias("_o"), F.count("*").alias("_n"))
    total = firsts.groupBy(*keys).agg(F.sum("_n").alias("count"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_o", value))
    some = firsts.withColumn("_r", rank).filter(F.col("_r") <= most)
    lists = some.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", value))), lambda x: x[value]).alias("first_values"))
    return total.join(lists, keys)


def clusters(df: DataFrame, key: Column, raw: str, year: str) -> DataFrame:
    """Per cluster key: rows, distinct raws in order, least and greatest year."""
    return df.groupBy(key.alias("cluster")).agg(F.count("*").alias("total"), F.array_sort(F.collect_set(raw)).alias("raws"), F.min(year).alias("min_year"), F.max(year).alias("max_year"))


def dominant(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The most frequent value per group, ties by value, with its count and share."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("count"))
    w = Window.partitionBy(*by)
    rank = F.row_number().over(w.orderBy(F.desc("count"), value))
    return counts.withColumns({"share": F.col("count") / F.sum("count").over(w), "_r": rank}).filter("_r = 1").drop("_r")


def by_year(df: DataFrame, day: str, value: str) -> DataFrame:
    """Rows and the mean of a value per year."""
    return df.groupBy(F.year(day).cast("long").alias("year")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))


def profile(df: DataFrame, by: list[str], measures: list[str], counted: Column) -> DataFrame:
    """Per group the rows, those that meet a condition, and the mean of each measure."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(counted).alias("counted"), *(F.avg(m).alias(f"mean_{m}") for m in measures))


def crosstab(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    return df.groupBy(row).pivot(column, values).count().na.fill(0)


def probes(df: DataFrame, **checks: Column) -> DataFrame:
    """(probe, passed) of conditional aggregates over the whole frame."""
    one = df.agg(*(c.alias(k) for k, c in checks.items()))
    return one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("probe"), F.col(k).alias("passed")) for k in checks))).alias("p")).select("p.*")
