"""Registries of people: rows from other lists merged in by name or by an outside id, and candidates for that id scored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import fold_aggressive, person_tokens

# Words of a candidate's description with their weights; points for the birth date; bounds of a sure match.
DESCRIPTIONS = (
    ("president of romania", 10), ("prime minister", 10), ("deputy prime minister", 8), ("minister of", 8), ("speaker of", 8), ("president of the senate", 8), ("president of the chamber", 8), ("senator", 6), ("deputy", 6),
    ("member of the european parliament", 6), ("member of the chamber of deputies", 6), ("member of the romanian senate", 6), ("politician", 4), ("statesman", 4), ("political", 2),
    ("researcher", -5), ("scientist", -5), ("athlete", -5), ("footballer", -5), ("musician", -5), ("actor", -5), ("disambiguation page", -100),
)
SAME_DAY, SAME_YEAR, OTHER_YEAR = 20, 5, -10
BY_BIRTH, BY_DESCRIPTION, LEAD, LEAST_ALONE = 25, 8, 5, 4


def name_key(c: Column) -> Column:
    """What names of one person share: their folded tokens in order."""
    return F.nullif(F.array_join(F.array_sort(person_tokens(c)), " "), F.lit(""))


def base_id(c: Column) -> Column:
    """An id from a name: folded words joined by hyphens."""
    return F.nullif(F.regexp_replace(F.regexp_replace(F.lower(fold_aggressive(c)), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(""))


def minted(new: DataFrame, taken: DataFrame, name: str) -> DataFrame:
    """Adds `id`: from the name, with -2, -3 and so on where it is taken or comes again. Numbers go on after the highest that is taken."""
    used = taken.select(F.regexp_replace("id", r"-\d+$", "").alias("_b"), F.coalesce(F.regexp_extract("id", r"-(\d+)$", 1).try_cast("int"), F.lit(1)).alias("_n")).groupBy("_b").agg(F.max("_n").alias("_m"))
    numbered = new.withColumn("_b", base_id(F.col(name))).withColumn("_k", F.row_number().over(Window.partitionBy("_b").orderBy(name)))
    number = F.col("_k") + F.coalesce("_m", F.lit(0))
    return numbered.join(used, "_b", "left").withColumn("id", F.when(number > 1, F.concat_ws("-", "_b", number)).otherwise(F.col("_b"))).drop("_b", "_k", "_m")


def spellings(registry: DataFrame) -> DataFrame:
    """(key, id) of every name of a registry; a key goes to its first entry."""
    names = F.concat(F.array("canonical_name"), F.coalesce(F.array("diacritic_form"), F.array().cast("array<string>")), F.coalesce("aliases", F.array().cast("array<string>")))
    rows = registry.select("id", F.explode(names).alias("_n")).select("id", name_key(F.col("_n")).alias("key")).filter("key is not null")
    return rows.groupBy("key").agg(F.min("id").alias("id"))


def merged_mandates(registry: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new entries, counts). Rows (name, legislature, role, party, from, to) are grouped by name key; keys that the registry has are skipped, the others become entries with their distinct mandates by date."""
    keyed = rows.filter(F.trim("name") != "").withColumn("key", name_key(F.col("name"))).filter("key is not null")
    mandate = F.struct("from", "to", "legislature", "role", "party")
    one = keyed.groupBy("key", "legislature", "role", "party").agg(F.min(F.struct("from", "to")).alias("_d"), F.min("name").alias("name")).select("key", "name", "legislature", "role", "party", "_d.*")
    people = one.groupBy("key").agg(F.min("name").alias("canonical_name"), F.array_sort(F.collect_list(mandate)).alias("mandates"))
    held = spellings(registry)
    fresh = minted(people.join(held.select("key"), "key", "left_anti"), registry, "canonical_name")
    entries = fresh.select("id", "canonical_name", F.col("canonical_name").alias("diacritic_form"), F.array().cast("array<string>").alias("aliases"), F.lit(None).cast("string").alias("wikidata_qid"), F.lit(None).cast("string").alias("birth_date"), "mandates")
    counts = people.join(held.select("key", F.lit(True).alias("_held")), "key", "left").agg(F.count_if(F.col("_held").isNull()).alias("added"), F.coalesce(F.sum(F.when(F.col("_held").isNull(), F.size("mandates"))), F.lit(0)).alias("mandates_added"), F.count_if("_held").alias("skipped"))
    return entries, counts


def merged_outside(registry: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows (qid, label_en, label_ro, birth_date) with `action` and `id`: skip (no label, id known, or the entry has another), augment (an entry of that name lacks the id) or add (with a new id)."""
    label, other = F.trim(F.coalesce("label_en", F.lit(""))), F.nullif("label_ro", F.lit(""))
    known = registry.filter("wikidata_qid is not null").select(F.col("wikidata_qid").alias("qid"), F.lit(True).alias("_known")).distinct()
    held = spellings(registry)
    first = F.row_number().over(Window.partitionBy("qid").orderBy("label_en", "label_ro"))
    named = rows.withColumns({"_en": name_key(label), "_ro": name_key(other), "_bad": F.col("qid").isNull() | (label == "") | (label == F.col("qid")), "_nth": first})
    found = named.join(known, "qid", "left").join(held.select(F.col("key").alias("_en"), F.col("id").alias("_a")), "_en", "left").join(held.select(F.col("key").alias("_ro"), F.col("id").alias("_b")), "_ro", "left").withColumn("_id", F.coalesce("_a", "_b"))
    has = registry.select(F.col("id").alias("_id"), F.col("wikidata_qid").alias("_qid"))
    placed = found.join(has, "_id", "left")
    turn = F.row_number().over(Window.partitionBy("_id").orderBy("qid"))  # an entry takes one id
    again = F.row_number().over(Window.partitionBy(F.coalesce("_en", "qid")).orderBy("qid"))  # and a name makes one entry
    action = F.when(F.col("_bad") | F.coalesce("_known", F.lit(False)) | (F.col("_nth") > 1), "skip").when(F.col("_id").isNull(), F.when(again == 1, "add").otherwise("skip")).when(F.col("_qid").isNull() & (turn == 1), "augment").otherwise("skip")
    told = placed.withColumn("action", action)
    fresh = minted(told.filter("action = 'add'").select(F.col("qid").alias("_q"), label.alias("_name")), registry, "_name").select("_q", F.col("id").alias("_new"))
    out = told.join(fresh, (F.col("qid") == F.col("_q")) & (F.col("action") == "add"), "left")
    return out.select(*rows.columns, "action", F.coalesce("_new", "_id").alias("id"))


def augmented(registry: DataFrame, merged: DataFrame) -> DataFrame:
    """The registry with ids and missing birth dates of the augmenting rows, and the added entries."""
    day = F.when(F.length("birth_date") >= 10, F.substring("birth_date", 1, 10))
    gained = merged.filter("action = 'augment'").select("id", F.col("qid").alias("_q"), day.alias("_d"))
    old = registry.join(gained, "id", "left").withColumns({"wikidata_qid": F.coalesce("wikidata_qid", "_q"), "birth_date": F.coalesce(F.nullif("birth_date", F.lit("")), "_d")}).select(registry.columns)
    new = merged.filter("action = 'add'").select("id", F.trim("label_en").alias("canonical_name"), F.coalesce(F.nullif("label_ro", F.lit("")), F.trim("label_en")).alias("diacritic_form"), F.array().cast("array<string>").alias("aliases"), F.col("qid").alias("wikidata_qid"), day.alias("birth_date"))
    return old.unionByName(new, allowMissingColumns=True)


def candidate_score(description: Column, candidate_birth: Column, registry_birth: Column) -> Column:
    """Points for the words of a description, and for a birth date that is the same, of the same year, or of another."""
    low = F.lower(F.coalesce(description, F.lit("")))
    words = sum((F.when(F.contains(low, F.lit(w)), points).otherwise(0) for w, points in DESCRIPTIONS), F.lit(0))
    a, b = F.substring(candidate_birth, 1, 10), F.substring(registry_birth, 1, 10)
    both = (F.length(a) >= 4) & (F.length(b) >= 4)
    return words + F.when(F.coalesce(both, F.lit(False)), F.when(a == b, SAME_DAY).when(F.substring(a, 1, 4) == F.substring(b, 1, 4), SAME_YEAR).otherwise(OTHER_YEAR)).otherwise(0)


def suggestions(people: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per person (id, birth_date) the best candidate (id, qid, description, birth_date): its score, how it matched, how many others there are, and a status: ok, ambiguous or no_match. Disambiguation pages don't count."""
    real = candidates.filter(~F.contains(F.lower(F.coalesce("description", F.lit(""))), F.lit("disambiguation"))).dropDuplicates(["id", "qid"])
    rows = real.join(people.select("id", F.col("birth_date").alias("_born")), "id").withColumn("score", candidate_score(F.col("description"), F.col("birth_date"), F.col("_born")))
    described = candidate_score(F.col("description"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    rank = Window.partitionBy("id").orderBy(F.desc("score"), "qid")
    top = rows.withColumns({"_r": F.row_number().over(rank), "_next": F.lead("score").over(rank), "alternates": F.count("*").over(Window.partitionBy("id")) - 1, "_d": described}).filter("_r = 1")
    ok = ((F.col("score") >= BY_DESCRIPTION) & (F.col("_next").isNull() | (F.col("score") - F.col("_next") >= LEAD))) | (F.col("_next").isNull() & (F.col("_d") >= LEAST_ALONE))
    via = F.when(F.col("score") >= BY_BIRTH, "exact_name+birth").when(F.col("score") >= BY_DESCRIPTION, "exact_name+desc").otherwise("exact_name")
    best = top.select("id", "qid", "score", via.alias("matched_via"), "alternates", F.when(ok, "ok").otherwise("ambiguous").alias("status"))
    return people.select("id").join(best, "id", "left").withColumn("status", F.coalesce("status", F.lit("no_match")))
