"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

Documents are counted into cells (source, language, topic) with their tokens. Raking turns the cells' tokens into weights whose marginals by source, language and topic meet target shares. A document's ratio is its cell's weight over its cell's tokens; a hash of the id decides, the same way in every run.

With a `budget`, a share of all tokens, its probability is the ratio times the one factor at which the budget is kept in expectation; probabilities stop at one, what they would exceed it by goes to the other cells, and there is no floor. So a rare value does not settle how much of the corpus stays. Without a budget the probability is the ratio over the largest ratio, at least `floor`, and one rare value lowers all others.

Targets are shares that need not be given: by default they are the observed shares to the power `temper` (below one: rarer values gain). Given targets name values of a marginal; values without a target keep their tempered share of what is left.

The cell table holds a row per cell, whatever the number of documents; it is aggregated before the shuffle, and small next to the documents. Each round's table is written to the shared folder.

Nulls: a null source or language is a value of its own, shown as null; a null text is empty, with no tokens, and counts as one token so that it can be drawn. Repeated rows share their fate, being drawn by id; a null id is drawn as text ''. An empty table gives no rows. Columns of the input that clash with added ones are replaced; further columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import discard, stored

MARGINALS = ("source", "lang", "topic")
TEMPER = 0.8
ROUNDS = 8
FLOOR = 0.05
BUDGET = 0.6


def token_count(text: Column) -> Column:
    """Words of a text, at least one."""
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")), F.lit(1)).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic by form: credentials or addresses, numbers, many lines, long or short prose."""
    t = F.coalesce(text, F.lit(""))
    head = F.length(t)
    lines = head - F.length(F.translate(t, "\n", "")) + 1
    return (
        F.when(t.contains("://") | t.contains("@"), "addressed")
        .when(t.rlike(r"[0-9]{4}"), "numeric")
        .when(head < 400, "short")
        .when(lines * 200 > head, "listed")
        .when(head >= 6000, "long")
        .otherwise("prose")
    )


def counted(docs: DataFrame, topic: Column | None = None, tokens: Column | None = None) -> DataFrame:
    """The documents with their topic and tokens."""
    return docs.withColumns({"topic": topic_of(F.col("text")) if topic is None else topic, "tokens": token_count(F.col("text")) if tokens is None else tokens})


def targets_of(cells: DataFrame, marginal: str, given: dict | None, temper: float) -> DataFrame:
    """(value, share): shares of a marginal that sum to one."""
    sums = cells.groupBy(marginal).agg(F.sum("tokens").cast("double").alias("t"))
    named = F.lit(None).cast("double")
    for value, share in (given or {}).items():
        named = F.when(F.col(marginal).eqNullSafe(F.lit(value)), F.lit(float(share))).otherwise(named)
    shares = sums.select(F.col(marginal).alias("value"), named.alias("named"), F.pow("t", F.lit(temper)).alias("free"))
    named_, free = shares.agg(F.coalesce(F.sum("named"), F.lit(0.0)), F.sum(F.when(F.col("named").isNull(), F.col("free")))).first()
    left = max(0.0, 1.0 - named_)
    whole = named_ + left if free else named_  # shares sum to one, whatever was given
    return shares.select("value", (F.coalesce("named", F.lit(left) * F.col("free") / F.lit(free or 1.0)) / F.lit(whole or 1.0)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """The cells with a weight whose marginals meet the targets; weights sum to the cells' tokens. Goals stand on the cells, so that a step is one aggregation and one join with its sums."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    for m, shares in targets.items():
        goal = shares.select(F.col("value").alias("_v"), (F.col("share") * F.lit(total)).alias(f"goal_{m}"))
        now = now.join(goal, now[m].eqNullSafe(goal["_v"])).drop("_v")
    held = now = stored(now, "goals")
    for k in range(rounds):
        for m in targets:
            sums = now.groupBy(F.col(m).alias("_v")).agg(F.sum("weight").alias("_s"))
            now = now.join(sums, now[m].eqNullSafe(sums["_v"])).withColumn("weight", F.col("weight") * F.col(f"goal_{m}") / F.col("_s")).drop("_v", "_s")
        now = stored(now, f"rake-{k}")
        discard(held)
        held = now
    return now


def marginals(mixed: DataFrame, targets: dict[str, dict] | None = None, temper: float = TEMPER) -> DataFrame:
    """(marginal, value, target, reached): the share of each value that was aimed at, and that of the tokens that the probabilities let one expect. They differ where raking has not settled or probabilities stop at a bound."""
    cells = mixed.groupBy(*MARGINALS).agg(F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("probability")).alias("_kept"))
    whole = cells.agg(F.sum("_kept")).first()[0] or 1.0
    parts = []
    for m in MARGINALS:
        aim = targets_of(cells, m, (targets or {}).get(m), temper)
        got = cells.groupBy(F.col(m).alias("_v")).agg((F.sum("_kept") / F.lit(whole)).alias("reached"))
        parts.append(aim.join(got, aim["value"].eqNullSafe(got["_v"])).select(F.lit(m).alias("marginal"), "value", F.col("share").alias("target"), "reached"))
    return parts[0].union(parts[1]).union(parts[2])


def factor_of(raked: DataFrame, budget: float) -> float:
    """The factor on ratios at which probabilities of at most one keep a share `budget` of the tokens. Each step fits the cells below one to what those at one leave; the set at one only grows, so the last step is exact."""
    size = F.col("ratio") * F.col("tokens")
    tokens, weight = raked.agg(F.sum("tokens"), F.sum(size)).first()
    if not weight:
        return 1.0
    factor, full = budget * tokens / weight, 0
    while True:
        below = F.col("ratio") * F.lit(factor) < 1.0
        at_one, free = raked.agg(F.coalesce(F.sum(F.when(~below, F.col("tokens"))), F.lit(0)), F.sum(F.when(below, size))).first()
        if at_one <= full or not free:
            return factor
        factor, full = (budget * tokens - at_one) / free, at_one


def drawn(doc_id: Column, seed: int) -> Column:
    """A number from 0 to below 1, by the id: the first 52 bits of an md5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13), 16, 10).cast("long") / float(1 << 52)


def mix(docs: DataFrame, targets: dict[str, dict] | None = None, temper: float = TEMPER, rounds: int = ROUNDS, floor: float = FLOOR, seed: int = 17, topic: Column | None = None, tokens: Column | None = None, budget: float | None = None) -> DataFrame:
    """The documents with topic, tokens, ratio, probability and whether each is kept; `budget` is the share of tokens to keep, and then `floor` is not used."""
    rows = counted(docs, topic, tokens)
    cells = stored(rows.groupBy(*MARGINALS).agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens")), "cells")
    shares = {m: stored(targets_of(cells, m, (targets or {}).get(m), temper), f"targets-{m}") for m in MARGINALS}
    raked = rake(cells, shares, rounds).select(*(F.col(m).alias(f"_{m}") for m in MARGINALS), (F.col("weight") / F.col("tokens")).alias("ratio"), "tokens")
    if budget is None:
        most = raked.agg(F.max("ratio")).first()[0] or 1.0
        probability = F.greatest(F.lit(floor), F.col("ratio") / F.lit(most))
    else:
        probability = F.col("ratio") * F.lit(factor_of(raked, budget))
    rates = raked.drop("tokens").withColumn("probability", F.least(F.lit(1.0), probability))
    plain = rows.drop("ratio", "probability", "kept")
    joined = plain.join(rates, [plain[m].eqNullSafe(rates[f"_{m}"]) for m in MARGINALS]).drop(*(f"_{m}" for m in MARGINALS))
    return joined.withColumn("kept", drawn(F.col("doc_id"), seed) < F.col("probability"))
