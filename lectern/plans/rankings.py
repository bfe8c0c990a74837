"""Canonical rankings over coded speeches, pinned to a version by name.

A coding row: record_id, person_id, party, cycle, session_date, context, words, hawkins (0 to 2), confidence, voice, dqi struct of six codings, markers array<struct<framework, kind, complete>>, econ and cultural with party_econ and party_cultural.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Who is ranked, and how sure a coding must be.
LEAST_SPEECHES, LEAST_WORDS, LEAST_CONFIDENCE = 10, 5000, 0.7


def eligible(codings: DataFrame, least_words: int = 100) -> DataFrame:
    """Codings of speeches long enough, sure enough and in the speaker's own voice."""
    return codings.filter((F.col("words") >= least_words) & (F.col("confidence") > LEAST_CONFIDENCE) & (F.coalesce("voice", F.lit("first_person")) == "first_person"))


def markers(framework: str, kinds: list[str] | None = None, complete: bool = False) -> Column:
    """Number of a speech's markers of a framework."""

    def test(m: Column) -> Column:
        ok = m["framework"] == framework
        if kinds:
            ok = ok & m["kind"].isin(kinds)
        return ok & m["complete"] if complete else ok

    return F.greatest(F.coalesce(F.size(F.filter("markers", test)), F.lit(0)), F.lit(0))


def ranked(codings: DataFrame, measure: Column, by: str = "person_id", least_speeches: int = LEAST_SPEECHES, least_words: int = LEAST_WORDS) -> DataFrame:
    """Per speaker or party: rate per 1000 words (primary), mean, 75th percentile and sum of the measure, and three ranks."""
    rows = codings.withColumn("_m", measure.cast("double"))
    sums = rows.groupBy(by).agg(F.count("*").alias("speeches"), F.sum("words").alias("words"), F.sum("_m").alias("total"), F.avg("_m").alias("mean"), F.percentile("_m", 0.75).alias("p75"))
    kept = sums.filter((F.col("speeches") >= least_speeches) & (F.col("words") >= least_words)).withColumn("per_kword", 1000 * F.col("total") / F.col("words"))
    rank = lambda c: F.rank().over(Window.orderBy(F.desc(c)))  # noqa: E731  one row a speaker
    return kept.withColumns({"rank_rate": rank("per_kword"), "rank_mean": rank("mean"), "rank_p75": rank("p75")})


def kinds_table(codings: DataFrame, framework: str, kinds: list[str], by: str = "person_id") -> DataFrame:
    """Markers of a framework per kind and speaker."""
    rows = codings.select(by, F.explode("markers").alias("m")).filter(F.col("m.framework") == framework).select(by, F.col("m.kind").alias("kind"))
    return rows.groupBy(by).pivot("kind", kinds).count().na.fill(0)


# What the six deliberation codings are worth, each from 0 to 1.
JUSTIFICATION_MOST, RESPECT_MOST = 3.0, 2.0
CONTENT = {"none": 0.0, "group_interest": 0.33, "mixed": 0.5, "common_good": 1.0}
CONSTRUCTIVE = {"positional": 0.0, "alternative_proposal": 0.66, "mediating_proposal": 1.0}
RESPECT = ("respect_for_groups", "respect_for_demands", "respect_for_counterarguments")
# The years in which a conspiracy marker can occur; the marker kinds of the breakdowns; when the default window of alignment begins.
ERAS = {"parallel_state": (2017, None)}
VPARTY = ("opposition_delegitimization", "media_hostility", "judiciary_attack", "minority_scapegoating", "democratic_norms_rejection")
ALIGNMENT = ("pro_russia_alignment", "nato_skeptic", "anti_atlanticist", "anti_american", "china_aligned", "ukraine_skeptic")
REFERENTS = ("nation", "civilisation", "family", "sovereignty", "ethnic_group")
ALIGNMENT_SINCE = "2022-02-24"


def dqi_parts(dqi: Column = None) -> dict[str, Column]:
    """The six codings of deliberation, each brought to 0 to 1."""
    d = F.col("dqi") if dqi is None else dqi
    worth = lambda c, values: F.element_at(F.create_map(*(F.lit(x) for kv in values.items() for x in kv)), c)
    return {
        "level_of_justification": d["level_of_justification"] / JUSTIFICATION_MOST,
        "content_of_justification": worth(d["content_of_justification"], CONTENT),
        **{k: d[k] / RESPECT_MOST for k in RESPECT},
        "constructive_politics": worth(d["constructive_politics"], CONSTRUCTIVE),
    }


def dqi_composite(weights: dict[str, float] | None = None) -> Column:
    """The weighted mean of the six codings, equal weights by default; null where one is missing."""
    parts = dqi_parts()
    w = {k: (weights or {}).get(k, 1.0) for k in parts}
    return sum((c * F.lit(w[k]) for k, c in parts.items()), F.lit(0.0)) / F.lit(sum(w.values()))


def with_means(ranking: DataFrame, codings: DataFrame, parts: dict[str, Column], by: str = "person_id") -> DataFrame:
    """A ranking with the mean of each part."""
    return ranking.join(codings.groupBy(by).agg(*(F.avg(c).alias(k) for k, c in parts.items())), by, "left")


def with_kinds(ranking: DataFrame, codings: DataFrame, framework: str, kinds: tuple[str, ...], by: str = "person_id") -> DataFrame:
    """A ranking with the number of markers of each kind."""
    return ranking.join(kinds_table(codings, framework, list(kinds), by), by, "left").na.fill(0, list(kinds))


def out_of_era(codings: DataFrame, framework: str = "conspiracy", by: str = "person_id") -> DataFrame:
    """Whether any marker of a speaker was coded outside the years of its kind."""
    rows = codings.select(by, F.year("session_date").alias("_y"), F.explode("markers").alias("m")).filter(F.col("m.framework") == framework)
    outside = F.lit(False)
    for kind, (first, last) in ERAS.items():
        outside = outside | ((F.col("m.kind") == kind) & ((F.col("_y") < (first or 0)) | (F.col("_y") > (last or 9999))))
    return rows.groupBy(by).agg(F.coalesce(F.max(outside), F.lit(False)).alias("out_of_era"))


def quarters(codings: DataFrame, measure: Column, by: str = "person_id") -> DataFrame:
    """The rate per 1000 words by quarter."""
    return codings.groupBy(by, F.date_trunc("quarter", "session_date").cast("date").alias("quarter")).agg((1000 * F.sum(measure) / F.sum("words")).alias("per_kword"))


def referents(codings: DataFrame, by: str = "person_id") -> DataFrame:
    """Completed securitising moves by what they are said to save."""
    rows = codings.select(by, F.explode("markers").alias("m")).filter((F.col("m.framework") == "securitization") & F.col("m.complete"))
    return rows.groupBy(by).pivot("m.kind", list(REFERENTS)).count().na.fill(0)


def axis_gap(axis: str, definition: str = "quadrant_flip") -> Column:
    """How far a speech stands from its party on an axis (columns axis and party_axis): raw difference, in standard deviations or as a percentile of the party's speeches of that cycle, or whether the sign differs."""
    speech, party = F.col(axis), F.col(f"party_{axis}")
    own = Window.partitionBy("party", "cycle")
    ways = {
        "raw_delta": speech - party,
        "z_score": (speech - party) / F.nullif(F.stddev(axis).over(own), F.lit(0.0)),
        "percentile": F.when(speech.isNotNull(), F.percent_rank().over(own.orderBy(speech))),
        "quadrant_flip": F.when(speech.isNotNull() & party.isNotNull(), ((speech > 0) & (party < 0)) | ((speech < 0) & (party > 0))).cast("int"),
    }
    return ways[definition].cast("double")


def cross_axis(codings: DataFrame, axes: tuple[str, ...] = ("econ", "cultural"), definition: str = "quadrant_flip", least_speeches: int = LEAST_SPEECHES) -> DataFrame:
    """Speakers by the rate of speeches that stand apart from their party on any of the axes, with the mean gap on each and both gaps' quadrant. Speeches count where an axis and its party value are there."""
    known = codings.filter(sum(((F.col(a).isNotNull() & F.col(f"party_{a}").isNotNull()).cast("int") for a in axes), F.lit(0)) > 0)
    rows = known.withColumns({f"_{a}": axis_gap(a, definition) for a in axes})
    size = F.greatest(*(F.abs(F.coalesce(f"_{a}", F.lit(0.0))) for a in axes), F.lit(0.0))
    out = rows.groupBy("person_id").agg(F.count("*").alias("speeches"), F.sum("words").alias("words"), F.sum(size).alias("total"), *(F.avg(f"_{a}").alias(f"{a}_gap") for a in axes)).filter(F.col("speeches") >= least_speeches)
    return out.withColumn("per_kword", 1000 * F.col("total") / F.col("words")).withColumn("rank_rate", F.rank().over(Window.orderBy(F.desc("per_kword"))))


def divergence(codings: DataFrame, a: Column, b: Column, by: str = "person_id") -> DataFrame:
    """Per speaker the difference of two measures: raw, as z scores, as percentile ranks, and whether their quadrants flip."""
    means = codings.groupBy(by).agg(F.avg(a).alias("a"), F.avg(b).alias("b"))
    s = means.agg(F.avg("a").alias("ma"), F.stddev("a").alias("sa"), F.avg("b").alias("mb"), F.stddev("b").alias("sb"), F.percentile("a", 0.5).alias("da"), F.percentile("b", 0.5).alias("db")).first()
    z = lambda c, m, sd: (F.col(c) - F.lit(m)) / F.lit(sd) if sd else F.lit(0.0)
    return means.select(by, (F.col("a") - F.col("b")).alias("raw"), (z("a", s.ma, s.sa) - z("b", s.mb, s.sb)).alias("z"), (F.percent_rank().over(Window.orderBy("a")) - F.percent_rank().over(Window.orderBy("b"))).alias("percentile"), ((F.col("a") >= F.lit(s.da)) != (F.col("b") >= F.lit(s.db))).alias("flips"))


def party_shift(codings: DataFrame, measure: Column, cycle: Column, first: str, second: str) -> DataFrame:
    """Per party the word-weighted mean of a measure in the second cycle less that in the first."""
    mean = lambda c: F.sum(F.when(F.col("_c") == c, measure * F.col("words"))) / F.sum(F.when(F.col("_c") == c, F.col("words")))
    return codings.withColumn("_c", cycle).groupBy("party").agg((mean(second) - mean(first)).alias("shift"))


def party_position(codings: DataFrame, registry: DataFrame, values: list[str]) -> DataFrame:
    """Codings with the values of their party's latest cycle that began by the speech's date (party, cycle, value...). One sorted window of both sides, no pairs."""
    from lectern.operators.joins import as_of

    dated = registry.select("party", F.col("cycle").cast("date").alias("_from"), *values)
    return as_of(codings.withColumn("_day", F.col("session_date").cast("date")), dated, "party", "_day", "_from", values).drop("_day")


def manifesto_divergence(codings: DataFrame, measure: Column, registry: DataFrame, replicates: int = 200) -> DataFrame:
    """Per party the word-weighted mean of a measure less that of the registry's value at each speech's date, with a bootstrap interval of the mean: rows weighted by Poisson draws of their id."""
    rows = party_position(codings.withColumn("_m", measure.cast("double")), registry, ["value"]).filter("value is not null and _m is not null")
    mean = rows.groupBy("party").agg((F.sum(F.col("_m") * F.col("words")) / F.sum("words")).alias("mean"), (F.sum(F.col("value") * F.col("words")) / F.sum("words")).alias("registry"), F.count("*").alias("speeches"))
    from lectern.operators.windows import resampled

    drawn = resampled(rows, "record_id", replicates).groupBy("_b", "party").agg((F.sum(F.col("_m") * F.col("words") * F.col("_t")) / F.nullif(F.sum(F.col("words") * F.col("_t")), F.lit(0))).alias("_mean"))
    spread = drawn.groupBy("party").agg(F.percentile("_mean", 0.025).alias("low"), F.percentile("_mean", 0.975).alias("high"))
    return mean.join(spread, "party", "left").withColumn("divergence", F.col("mean") - F.col("registry"))


def register_shift(codings: DataFrame, measure: Column, by: str = "person_id") -> DataFrame:
    """Per speaker and delivery context the mean; flagged where contexts differ by over 1.5 pooled standard deviations."""
    groups = codings.groupBy(by, "context").agg(F.avg(measure).alias("mean"), F.var_samp(measure).alias("var"), F.count("*").alias("n"))
    w = Window.partitionBy(by)
    pooled = F.sqrt(F.sum(F.col("var") * (F.col("n") - 1)).over(w) / F.nullif(F.sum(F.col("n") - 1).over(w), F.lit(0)))
    spread = F.max("mean").over(w) - F.min("mean").over(w)
    return groups.withColumns({"spread": spread, "flagged": F.coalesce(spread > 1.5 * pooled, F.lit(False))})


def with_marker(codings: DataFrame, framework: str, kind: str, sort: str = "date", limit: int = 100) -> DataFrame:
    """Speeches that carry a marker, newest, densest or surest first."""
    count = markers(framework, [kind])
    order = {"date": F.desc("session_date"), "density": F.desc(count / F.col("words")), "confidence": F.desc("confidence")}[sort]
    return codings.filter(count > 0).orderBy(order, "record_id").limit(limit)


def _speakers(codings: DataFrame, framework: str, kinds: tuple[str, ...], measure: Column | None = None, complete: bool = False) -> DataFrame:
    rows = eligible(codings)
    return with_kinds(ranked(rows, markers(framework, list(kinds), complete) if measure is None else measure), rows, framework, kinds)


# Kinds of markers.
FEAR = ("existential_threat", "civilisational_decline", "invasion", "demographic_replacement", "economic_collapse", "cultural_extinction", "enemy_within")
FALLACIES = ("false_dichotomy", "strawman", "ad_hominem", "equivocation", "hasty_generalisation", "whataboutism", "appeal_to_emotion", "slippery_slope", "loaded_question", "red_herring", "circular_reasoning")
CONSPIRACY = ("parallel_state", "soros_conspiracy", "globalist_cabal", "deep_state", "cultural_marxism", "they_dont_want_you_to_know", "false_flag_accusation", "hidden_hand", "replacement_theory", "medical_conspiracy")
DISRUPTION = ("heckling", "interruption", "walkout", "mic_cut")


def most_securitizing(codings: DataFrame, referent: tuple[str, ...] = ()) -> DataFrame:
    """Completed moves, of the given referents if any, with their breakdown."""
    rows = eligible(codings)
    return ranked(rows, markers("securitization", list(referent) or None, complete=True)).join(referents(rows), "person_id", "left").na.fill(0, list(REFERENTS))


def most_pro_russia(codings: DataFrame, since: str = ALIGNMENT_SINCE, kinds: tuple[str, ...] = ALIGNMENT) -> DataFrame:
    return _speakers(codings.filter(F.col("session_date") >= F.lit(since).cast("date")), "geopolitical_alignment", kinds)


def most_conspiracy_framing(codings: DataFrame, kinds: tuple[str, ...] = CONSPIRACY) -> DataFrame:
    return _speakers(codings, "conspiracy", kinds).join(out_of_era(eligible(codings)), "person_id", "left").na.fill(False, ["out_of_era"])


def highest_dqi(codings: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """By the mean composite, with the mean of each coding."""
    rows = eligible(codings).filter(dqi_composite(weights).isNotNull())
    return with_means(ranked(rows, dqi_composite(weights)), rows, dqi_parts())


RANKINGS: dict[str, Callable[..., DataFrame]] = {
    "most_populist_politicians@v1": lambda c: ranked(eligible(c), (F.col("hawkins") >= 1).cast("int")),
    "most_anti_pluralist_politicians@v1": lambda c: _speakers(c, "vparty", VPARTY, (markers("vparty") > 0).cast("int")),
    "most_fearmongering@v1": lambda c: _speakers(c, "fear", FEAR),
    "rhetorical_fallacy_density@v1": lambda c, kinds=FALLACIES: _speakers(c, "fallacy", kinds),
    "most_securitizing@v1": most_securitizing,
    "most_conspiracy_framing@v1": most_conspiracy_framing,
    "most_pro_russia@v1": most_pro_russia,
    "highest_dqi_speakers@v1": highest_dqi,
    "cross_axis_divergence@v1": lambda c, **more: cross_axis(eligible(c), **more),
    "party_manifesto_divergence@v1": lambda c, registry: manifesto_divergence(eligible(c), F.col("econ"), registry),
    "politician_register_shift@v1": lambda c: register_shift(eligible(c), F.col("hawkins")),
    "audience_disruption_index@v1": lambda c: with_kinds(ranked(c, markers("audience", list(DISRUPTION))), c, "audience", DISRUPTION),
    "speeches_with_marker@v1": lambda c, framework="vparty", kind=VPARTY[0], **more: with_marker(eligible(c), framework, kind, **more),
    "party_rhetoric_shift@v1": lambda c, first="2016", second="2020": party_shift(eligible(c), F.col("hawkins"), F.year("session_date").cast("string"), first, second),
}
