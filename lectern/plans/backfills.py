"""Backfills: registry ids written onto records, under one overwrite policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import fold, fold_aggressive, peel, person_tokens, tokens
from lectern.operators.joins import active_mandate, fuzzy_names, longest_prefix, lookup_cascade

# Labels that are no persons, in lower case.
NOT_PERSONS = ("<chair narration>", "din sală", "din sala", "din sal", "guvernul", "guvern", "guvernul româniei", "voci", "voci din sală", "voci din sala", "vocea din sală", "aplauze")


def overwritten(old: Column, new: Column, force: bool = False) -> tuple[Column, Column]:
    """(value, action): filled where empty, same or mismatch kept, replaced or cleared only if forced."""
    has_old, has_new = old.isNotNull(), new.isNotNull()
    action = F.when(~has_old & has_new, "filled").when(~has_old, "unmatched").when(has_new & (old == new), "same").when(has_new, "replaced" if force else "mismatch").otherwise("cleared" if force else "kept")
    value = (F.when(has_new | F.lit(True), new) if force else F.coalesce(old, new))
    return value, action


def bag(c: Column) -> Column:
    return F.array_join(F.array_sort(tokens(c)), " ")


def institutions(probe: DataFrame, aliases: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds (match, via): exact, case, diacritic, then token-set equality; aliases have alias, id and seq."""
    tiers = {
        "exact": (F.col(raw), F.col("alias")),
        "case": (F.lower(raw), F.lower("alias")),
        "diacritic": (F.lower(fold(F.col(raw))), F.lower(fold(F.col("alias")))),
        "token_set": (F.nullif(bag(F.col(raw)), F.lit("")), F.nullif(bag(F.col("alias")), F.lit(""))),
    }
    return lookup_cascade(probe, aliases, raw, "alias", "id", tiers)


def ministries(probe: DataFrame, aliases: DataFrame, raw: str = "raw") -> DataFrame:
    """As institutions, with token sets of three tokens or more; then the longest alias that begins the text at a space."""
    long = lambda c: F.when(F.size(tokens(c)) >= 3, bag(c))
    tiers = {
        "exact": (F.col(raw), F.col("alias")),
        "case": (F.lower(raw), F.lower("alias")),
        "diacritic": (F.lower(fold(F.col(raw))), F.lower(fold(F.col("alias")))),
        "token_set": (long(F.col(raw)), long(F.col("alias"))),
    }
    found = lookup_cascade(probe, aliases, raw, "alias", "id", tiers)
    folded = found.withColumn("_f", F.lower(fold(F.col(raw)))).withColumnsRenamed({"match": "_m", "via": "_v"})
    numbered = aliases.select(F.lower(fold(F.col("alias"))).alias("_fa"), F.col("seq").alias("_q"), F.col("id").alias("_i"))
    hits = longest_prefix(folded, numbered, "_f", "_fa", "_q").withColumnRenamed("match", "_hit")
    named = hits.join(numbered.select(F.col("_q").alias("_hit"), F.col("_i")).distinct(), "_hit", "left")
    return named.withColumns({"match": F.coalesce("_m", "_i"), "via": F.coalesce("_v", F.when(F.col("_i").isNotNull(), "prefix"))}).drop("_f", "_m", "_v", "_hit", "_i")


def addressees(probe: DataFrame, ministry_aliases: DataFrame, institution_aliases: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds (match, via): the ministry, else the institution."""
    first = ministries(probe, ministry_aliases, raw).withColumnsRenamed({"match": "_mm", "via": "_mv"})
    both = institutions(first, institution_aliases, raw)
    return both.withColumns({"via": F.coalesce("_mv", "via"), "match": F.coalesce("_mm", "match")}).drop("_mm", "_mv")


def speakers(docs: DataFrame) -> DataFrame:
    """(document_id, year, path, raw, name, person_id) of every speaker that a body names: of activities, proposers, interpellations with their answers, questions and rosters."""
    who = lambda path, s: F.struct(F.lit(path).alias("path"), s["raw"].alias("raw"), s["name"].alias("name"), s["person_id"].alias("person_id"))
    some = lambda c: F.coalesce(c, F.array())
    acts = F.flatten(F.transform(some(F.col("body.agenda_items")), lambda a: some(a["activities"])))
    asked, questions = F.col("body.interpellations"), F.col("body.questions")
    meetings = F.flatten(F.transform(some(F.col("body.committees")), lambda c: some(c["meetings"])))
    lists = [
        F.transform(acts, lambda a: F.when(a["speaker"].isNotNull(), who("activity", a["speaker"]))), F.transform(acts, lambda a: F.when(a["proposed_by"].isNotNull(), who("proposer", a["proposed_by"]))),
        F.transform(some(asked), lambda q: F.when(q["questioner"].isNotNull(), who("questioner", q["questioner"]))), F.transform(some(asked), lambda q: F.when(q["response"]["speaker"].isNotNull(), who("response", q["response"]["speaker"]))),
        F.transform(some(questions), lambda q: F.when(q["questioner"].isNotNull(), who("question", q["questioner"]))), F.flatten(F.transform(meetings, lambda m: F.transform(some(m["roster"]), lambda r: F.when(r["speaker"].isNotNull(), who("roster", r["speaker"]))))),
    ]
    return docs.select("document_id", F.col("metadata.year").alias("year"), F.explode(F.array_compact(F.concat(*lists))).alias("s")).select("document_id", "year", "s.*")


def persons(probe: DataFrame, registry: DataFrame, raw: str = "raw", year: str = "year") -> DataFrame:
    """Adds (match, via). The name is peeled first; then it must equal a registered one as it is, but for case, or folded; else be the same set of two tokens or more; else differ by one edit in all.

    Each tier yields the one person it finds, or of several the one whose mandate is active in the year; otherwise the next tier is tried. Names that differ only by case or marks count as homonyms of each other.
    registry: id, canonical_name, aliases, mandates array<struct<from:int,to:int>>.
    """
    spelled = F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))
    key = lambda c: F.lower(fold_aggressive(c))
    bag_of = lambda c: F.when(F.size(person_tokens(c)) >= 2, F.array_join(F.array_sort(person_tokens(c)), " "))
    names = registry.select("id", "mandates", F.explode(F.array_distinct(spelled)).alias("name")).filter("name is not null")
    asked = probe.select(F.col(raw).alias("_raw"), F.col(year).cast("int").alias("_year")).distinct().withColumn("_name", peel(F.col("_raw")))
    asked = asked.filter((F.length("_name") >= 2) & ~F.lower("_name").isin(*NOT_PERSONS))

    def tier(rank: int, pairs: DataFrame, via: Column) -> DataFrame:
        each = pairs.select("_raw", "_year", "id", F.when(F.col("_year").isNotNull(), active_mandate(F.col("mandates"), F.col("_year"))).alias("_active"), via.alias("_via"))
        one = each.groupBy("_raw", "_year", "id").agg(F.max("_active").alias("_active"), F.min("_via").alias("_via"))
        found = one.groupBy("_raw", "_year").agg(F.count("*").alias("n"), F.count_if("_active").alias("active"), F.max("id").alias("only"), F.max(F.when(F.col("_active"), F.col("id"))).alias("holder"), F.min("_via").alias("via"))
        chosen = F.when(F.col("n") == 1, F.col("only")).when(F.col("active") == 1, F.col("holder"))
        return found.select("_raw", "_year", F.lit(rank).alias("_rank"), chosen.alias("match"), "via").filter("match is not null")

    same = asked.join(names, key(F.col("_name")) == key(F.col("name")))
    how = F.when(F.col("_name") == F.col("name"), "1exact").when(F.lower("_name") == F.lower("name"), "2case").otherwise("3diacritic")
    sets_ = asked.join(names, bag_of(F.col("_name")) == bag_of(F.col("name")))
    first = tier(1, same, how).unionByName(tier(2, sets_, F.lit("4token_set")))
    done = first.select(F.col("_raw").alias("_r"), F.col("_year").alias("_y"))
    left = asked.join(done, (F.col("_raw") == F.col("_r")) & F.col("_year").eqNullSafe(F.col("_y")), "left_anti")  # the last tier is for those without a match
    near = fuzzy_names(left.select("_name").distinct(), names, "_name", "name", "id", person_tokens)
    fuzzy = left.join(near, "_name").join(registry.select("id", "mandates").dropDuplicates(["id"]), "id")
    every = first.unionByName(tier(3, fuzzy, F.lit("5fuzzy")))
    best = every.groupBy("_raw", "_year").agg(F.min_by(F.struct("match", F.substring("via", 2, 20).alias("via")), "_rank").alias("_b"))
    on = probe[raw].eqNullSafe(best["_raw"]) & probe[year].cast("int").eqNullSafe(best["_year"])
    return probe.join(best, on, "left").select(*probe.columns, F.col("_b.match").alias("match"), F.col("_b.via").alias("via"))


def government_votes(votes: DataFrame, force: bool = False) -> DataFrame:
    """Votes of items that cite an ordinance, or whose title names one, get the government as proposer where none is written."""
    cites = F.exists("refs.types", lambda t: t.isin("oug", "og")) | F.coalesce(F.col("agenda_title").rlike(r"(?iu)ordonan[țt]"), F.lit(False))
    new = F.struct(F.lit("guvern").alias("person_id"), F.lit("Guvernul").alias("name"), F.lit(True).alias("is_government"))
    old = F.col("proposed_by")
    return votes.withColumn("proposed_by", F.when(cites & (F.lit(force) | old.isNull()), new).otherwise(old))


def stubs(unresolved: DataFrame, name: str, year: str, taken: DataFrame) -> DataFrame:
    """New registry rows for unresolved names: clustered by folded tokens, the most frequent spelling as name, the id from the tokens with the first number from 2 on that is free where it is taken."""
    keyed = unresolved.withColumn("_k", F.array_join(F.array_sort(person_tokens(F.col(name))), "-")).filter("_k <> ''")
    spelled = keyed.groupBy("_k", name).agg(F.count("*").alias("_n"), F.min(year).alias("_a"), F.max(year).alias("_b"))
    best = spelled.groupBy("_k").agg(F.max_by(name, F.struct("_n", name)).alias("canonical_name"), F.sum("_n").alias("count"), F.min("_a").alias("from"), F.max("_b").alias("to"))
    # the numbers that stand after each key already; the bare id counts as 1
    numbers = taken.select(F.regexp_replace("id", r"-\d+$", "").alias("_k"), F.coalesce(F.regexp_extract("id", r"-(\d+)$", 1).try_cast("int"), F.lit(1)).alias("_u"))
    used = numbers.groupBy("_k").agg(F.array_sort(F.collect_set("_u")).alias("_used"))
    clash = best.join(used, "_k", "left")
    held = F.array_contains("_used", 1)
    free = F.array_min(F.array_except(F.sequence(F.lit(2), F.size("_used") + 2), F.col("_used")))
    return clash.select(F.when(held, F.concat_ws("-", F.col("_k"), free)).otherwise(F.col("_k")).alias("id"), "canonical_name", "count", "from", "to")
