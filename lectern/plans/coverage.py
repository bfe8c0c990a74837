"""Coverage of a text by claimed spans, and reports over coded or extracted records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import line_of, preview

SPANS = "array<struct<start:int,end:int>>"


def union_of(claims: Column, size: Column) -> Column:
    """Claims (start, end) cut to the text, sorted and joined where they touch."""
    cut = F.transform(claims, lambda c: F.struct(F.greatest(c["start"], F.lit(0)).cast("int").alias("start"), F.least(c["end"], size).cast("int").alias("end")))
    sorted_ = F.array_sort(F.filter(cut, lambda c: c["end"] > c["start"]))

    def step(done: Column, c: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], c["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (c["start"] <= F.get(done, F.size(done) - 1)["end"]), grown).otherwise(F.concat(done, F.array(c)))

    return F.coalesce(F.aggregate(sorted_, F.array().cast(SPANS), step), F.array().cast(SPANS))


def gaps_of(merged: Column, size: Column) -> Column:
    """What lies before, between and after merged spans."""
    ends = F.concat(F.array(F.lit(0)), F.transform(merged, lambda s: s["end"]))
    starts = F.concat(F.transform(merged, lambda s: s["start"]), F.array(size.cast("int")))
    return F.filter(F.zip_with(ends, starts, lambda e, s: F.struct(e.alias("start"), s.alias("end"))), lambda g: g["end"] > g["start"])


def covered(df: DataFrame, text: str = "text", claims: str = "claims", least: int = 20) -> DataFrame:
    """Adds `coverage`: body_chars, claimed_chars, claimed_pct (1 of an empty text) and gaps of at least so many characters that are not all white space, with lines and a preview."""
    body = F.coalesce(F.col(text), F.lit(""))
    size = F.length(body)
    rows = df.withColumn("_merged", union_of(F.col(claims), size))
    claimed = F.aggregate("_merged", F.lit(0), lambda s, c: s + (c["end"] - c["start"]))
    piece = lambda g: F.substring(body, g["start"] + 1, g["end"] - g["start"])
    gaps = F.filter(gaps_of(F.col("_merged"), size), lambda g: (g["end"] - g["start"] >= least) & (F.trim(F.regexp_replace(piece(g), r"\s+", "")) != ""))
    shown = F.transform(gaps, lambda g: F.struct(g["start"].alias("start"), g["end"].alias("end"), line_of(body, g["start"]).alias("first_line"), line_of(body, g["end"] - 1).alias("last_line"), preview(piece(g)).alias("preview")))
    return rows.withColumn("coverage", F.struct(size.alias("body_chars"), claimed.alias("claimed_chars"), F.round(F.when(size > 0, claimed / size).otherwise(1.0), 6).alias("claimed_pct"), shown.alias("gaps"))).drop("_merged")


def below(df: DataFrame, margin: float, most: int = 3) -> DataFrame:
    """Documents below a coverage, worst first, with their first gaps."""
    pct = F.col("coverage.claimed_pct")
    return df.filter(pct < margin).select("document_id", pct.alias("claimed_pct"), F.slice("coverage.gaps", 1, most).alias("gaps")).orderBy("claimed_pct", "document_id")


def year_drift(codings: DataFrame) -> DataFrame:
    """Per year: codings, counts per score and without one, mean DQI, and the share of fragments that were not found."""
    score = lambda v: F.count_if(F.col("hawkins") == v)
    return codings.filter("year is not null").groupBy("year").agg(
        F.count("*").alias("n"), score(0).alias("h0"), score(1).alias("h1"), score(2).alias("h2"), F.count_if(F.col("hawkins").isNull()).alias("h_err"), F.coalesce(F.avg("dqi_level"), F.lit(0.0)).alias("dqi_mean"),
        F.coalesce(100.0 * F.sum("missed") / F.nullif(F.sum("markers"), F.lit(0)), F.lit(0.0)).alias("missed_pct"),
    )


def run_summary(calls: DataFrame) -> DataFrame:
    """Totals of a run's calls by kind: calls, errors, repaired answers, tokens, mean latency, cost."""
    return calls.groupBy("kind").agg(F.count("*").alias("calls"), F.count_if(F.col("error").isNotNull()).alias("errors"), F.count_if("parse_repaired").alias("repaired"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.avg("latency_ms").alias("latency_ms"), F.sum("cost_usd").alias("cost_usd"))


def clean_entry(hawkins: Column, voice: Column, dqi: Column, vparty: Column) -> Column:
    """Whether a coding is whole: all parts without errors, the voice only where there are markers."""
    fine = lambda part: part.isNotNull() & part["error"].isNull()
    marked = F.coalesce(F.size(hawkins["markers"]), F.lit(0)) > 0
    return fine(hawkins) & fine(dqi) & fine(vparty) & (~marked | fine(voice))


def within_budget(calls: DataFrame, order: str, cost: str, cap: float) -> DataFrame:
    """Calls in order as long as the cost of those before stays below the cap. Costs are summed per block first, so that no single task orders all rows."""
    from pyspark.sql import Window

    rows = calls.withColumn("_b", F.floor(F.col(order) / 10_000))
    blocks = rows.groupBy("_b").agg(F.sum(cost).alias("_c"))
    before = blocks.withColumn("_before", F.coalesce(F.sum("_c").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    own = F.coalesce(F.sum(cost).over(Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return rows.join(before.select("_b", "_before"), "_b").withColumn("_o", own).filter(F.col("_before") + F.col("_o") < cap).drop("_b", "_before", "_o")


def grain_text(grain: str) -> Column:
    """The text that is embedded for a record of a grain."""
    parts = {
        "agenda_items": [F.col("title")],
        "speeches": [F.col("text")],
        "interpellations": [F.col("topic"), F.col("question_text")],
        "questions": [F.col("topic"), F.col("text")],
        "committee_meetings": [F.col("purpose"), F.array_join(F.transform("agenda_items", lambda a: a["title"]), "\n")],
        "reports": [F.col("title"), F.array_join(F.transform("headings", lambda h: h["text"]), "\n")],
    }[grain]
    return F.concat_ws("\n", *(F.nullif(p, F.lit("")) for p in parts))


def to_embed(records: DataFrame, prior: DataFrame, grain: str, dimensions: int = 1024, least: int = 100, most: int = 8000) -> DataFrame:
    """(record_id, text, fingerprint) of records whose vector must be made: long enough, and without a prior vector of the same text and size."""
    from lectern.functions.text import fingerprint

    rows = records.select("record_id", F.substring(grain_text(grain), 1, most).alias("text")).filter(F.length("text") >= least).withColumn("fingerprint", fingerprint(F.col("text")))
    held = prior.filter(F.size("vector") == dimensions).select("record_id", F.col("text_fingerprint").alias("fingerprint"))
    return rows.join(held, ["record_id", "fingerprint"], "left_anti")
