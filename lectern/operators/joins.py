"""Linking joins. Interval, as-of and chain joins run as windows over one shuffle by key instead of comparing pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.session import settled


MOST_DOUBLINGS = 40  # a chain of more than 2**40 links isn't one


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row per key, by the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def dated_lookup(probe: DataFrame, index: DataFrame, on: str, priority: Column, seq: str, value: str, into: str) -> DataFrame:
    """Adds the value of the index row with the same date, of least priority, then first seen; keeps what `into` holds already."""
    best = first_by(index.select(F.col(on).alias("_on"), priority.alias("_p"), F.col(seq).alias("_s"), F.col(value).alias("_v")), ["_on"], F.col("_p"), F.col("_s"))
    found = probe.join(best.select("_on", "_v"), probe[on] == F.col("_on"), "left")
    held = F.col(into) if into in probe.columns else F.lit(None)
    return found.withColumn(into, F.coalesce(held, F.col("_v"))).drop("_on", "_v")


def earliest_successor(df: DataFrame, key: str, day: str, ident: str, days: int = 60) -> DataFrame:
    """Adds `successor`: of rows with the same key dated after this one, within so many days, the earliest (then least id). A range window, no self-join."""
    number = F.datediff(F.col(day), F.lit("1970-01-01"))
    ahead = Window.partitionBy(key).orderBy("_day").rangeBetween(1, days)
    return df.withColumn("_day", number).withColumn("successor", F.min(F.struct("_day", F.col(ident).alias("_id"))).over(ahead)["_id"]).drop("_day")


def chain_ends(links: DataFrame, source: str, target: str) -> DataFrame:
    """(source, end, hops): where following the links ends, by pointer doubling; every round halves what is left. Links need one target each; a cycle is an error."""
    now = links.select(F.col(source).alias("source"), F.col(target).alias("end"), F.lit(1).cast("long").alias("hops"))
    for _ in range(MOST_DOUBLINGS):
        step = now.select(F.col("source").alias("_s"), F.col("end").alias("_e"), F.col("hops").alias("_h"))
        new = now.join(step, now["end"] == step["_s"], "left").select("source", F.coalesce("_e", "end").alias("end"), (F.col("hops") + F.coalesce("_h", F.lit(0))).alias("hops"), F.col("_s").isNotNull().alias("_moved"))
        new = settled(new)
        if new.filter("_moved").limit(1).count() == 0:
            return new.drop("_moved")
        now = new.drop("_moved")
    raise ValueError("the links hold a cycle")


def as_of(probe: DataFrame, build: DataFrame, key: str, at: str, build_at: str, values: list[str], strict: bool = False) -> DataFrame:
    """Adds the values of the last build row of the same key at or (strict) before the probe's position: both sides in one sorted window."""
    left = probe.select("*", F.col(at).alias("_at"), F.lit(0 if strict else 1).alias("_side"))
    right = build.select(F.col(key), F.col(build_at).alias("_at"), F.lit(1 if strict else 0).alias("_side"), F.struct(*values).alias("_v"))
    both = left.unionByName(right, allowMissingColumns=True)
    seen = F.last("_v", ignorenulls=True).over(Window.partitionBy(key).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("_v", seen).filter(F.col("_side") == (0 if strict else 1)).select(*probe.columns, *(F.col("_v")[v].alias(v) for v in values))


def lookup_cascade(probe: DataFrame, aliases: DataFrame, raw: str, alias: str, ident: str, tiers: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Adds (match, via): tiers are tried in order, each an equi-join of a derived key; in a tier the alias that was registered first wins (column seq). Every spelling is looked up once, whatever the number of rows that have it; null matches nothing."""
    out = probe.select(raw).filter(F.col(raw).isNotNull()).distinct().withColumns({"match": F.lit(None).cast(aliases.schema[ident].dataType), "via": F.lit(None).cast("string")})
    for name, (probe_key, alias_key) in tiers.items():
        table = aliases.withColumn("_key", alias_key).filter("_key is not null").groupBy("_key").agg(F.min(F.struct("seq", F.col(ident).alias("_id")))["_id"].alias("_id"))
        out = out.withColumn("_probe", probe_key)
        out = out.join(table, out["_probe"] == table["_key"], "left")
        out = out.withColumns({"via": F.when(F.col("match").isNull() & F.col("_id").isNotNull(), name).otherwise(F.col("via")), "match": F.coalesce("match", "_id")}).drop("_probe", "_key", "_id")
    found = out.select(F.col(raw).alias("_raw"), "match", "via")
    return probe.join(found, probe[raw] == found["_raw"], "left").drop("_raw")


def longest_prefix(probe: DataFrame, aliases: DataFrame, raw: str, alias: str, ident: str) -> DataFrame:
    """Adds `match`: the id of the longest alias that the text starts with, ending at a space or the end. Prefixes at spaces are exploded and equi-joined."""
    parts = F.split(F.col(raw), " ")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), " "))
    table = aliases.select(F.col(alias).alias("_a"), F.col(ident).alias("_id")).distinct()
    hits = probe.select(raw).distinct().withColumn("_a", F.explode(prefixes)).join(table, "_a").groupBy(raw).agg(F.max(F.struct(F.length("_a").alias("n"), (F.lit(0) - F.col("_id")).alias("o"), F.col("_id").alias("i")))["i"].alias("match"))
    return probe.join(hits, raw, "left")


def fuzzy_names(probe: DataFrame, names: DataFrame, raw: str, name: str, ident: str, tokens) -> DataFrame:
    """(raw, id): names with as many tokens (two or more), whose sorted tokens differ by one edit in all.

    Then one token differs, by one edit, and the others are equal in their places. Tokens one edit apart are equal once a character is left out of one of them or both, so candidates meet under the other tokens and a form of the one that differs; a token that many names share brings nobody together.
    """
    forms = lambda t: F.array_distinct(F.transform(F.sequence(F.lit(0), F.length(t)), lambda k: F.when(k == 0, t).otherwise(F.concat(F.substring(t, F.lit(1), k - 1), F.substring(t, k + 1, F.length(t))))))

    def keyed(rows: DataFrame, held: str) -> DataFrame:
        c = F.col(held)
        at = rows.withColumn("_k", F.explode(F.sequence(F.lit(1), F.size(c))))
        others = F.concat(F.slice(c, F.lit(1), F.col("_k") - 1), F.array(F.lit("")), F.slice(c, F.col("_k") + 1, F.size(c)))
        return at.withColumn("_f", F.explode(forms(F.element_at(c, F.col("_k"))))).withColumn("_t", F.concat_ws(" ", "_k", F.array_join(others, " "), "_f")).drop("_k", "_f")

    a = probe.select(raw).distinct().withColumn("_p", F.array_sort(tokens(F.col(raw)))).filter(F.size("_p") >= 2)
    b = names.select(F.col(name).alias("_n"), F.col(ident).alias("_id")).withColumn("_q", F.array_sort(tokens(F.col("_n")))).filter(F.size("_q") >= 2)
    total = F.aggregate(F.zip_with("_p", "_q", lambda x, y: F.levenshtein(x, y)), F.lit(0), lambda s, d: s + d)
    near = keyed(a, "_p").join(keyed(b, "_q"), "_t").filter((F.size("_p") == F.size("_q")) & (total == 1))
    return near.select(raw, F.col("_id").alias(ident)).distinct()


def active_mandate(mandates: Column, year: Column) -> Column:
    """Whether any (from, to) interval, open where null, holds the year; no mandates: true; none with a date: false."""
    holds = F.exists(mandates, lambda m: (m["from"].isNotNull() | m["to"].isNotNull()) & (F.coalesce(m["from"], year) <= year) & (F.coalesce(m["to"], year) >= year))
    return F.when(F.coalesce(F.size(mandates), F.lit(0)) <= 0, F.lit(True)).otherwise(holds)


def key_report(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, place) with place both, left or right."""
    x, y = a.select(key).distinct().withColumn("_l", F.lit(1)), b.select(key).distinct().withColumn("_r", F.lit(1))
    return x.join(y, key, "full_outer").select(key, F.when(F.col("_l").isNull(), "right").when(F.col("_r").isNull(), "left").otherwise("both").alias("place"))


def orphans(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows whose key is not among the new ones."""
    return old.join(new.select(key), key, "left_anti")


def unclaimed(points: DataFrame, claims: DataFrame, key: str, at: str, claim_at: str, band: int) -> DataFrame:
    """Points without a claim of the same key within the band: bins of the band's width, each looked at with its neighbours."""
    p = points.withColumn("_bin", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.floor(F.col(at) / band) + d)))
    c = claims.select(F.col(key).alias("_k"), F.col(claim_at).alias("_c"), F.floor(F.col(claim_at) / band).alias("_b"))
    near = p.join(c, (p[key] == c["_k"]) & (p["_bin"] == c["_b"]) & (F.abs(F.col(at) - F.col("_c")) <= band)).select(*points.columns).distinct()
    return points.join(near, points.columns, "left_anti")
