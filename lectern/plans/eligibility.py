"""Which speeches are coded, embedded or sampled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import collapsed, words

# Labels that are no speakers to be coded, as they are written, and parts of those that samples leave out, in lower case.
NOT_CODED = ("<chair narration>", "Din sală", "Din sala", "Voci", "Voci din sală", "Voci din sala", "Guvernul", "Aplauze", "Rumoare")
NOT_SAMPLED = ("<chair narration>", "din sală", "din sala", "voci", "guvernul", "aplauze", "rumoare")
LEAST_CHARS, MOST_WORDS, CLIP = 100, 800, 8000


def codable_speaker(name: Column, raw: Column) -> Column:
    """Whether neither name nor raw form is one of the labels; those without any pass."""
    label = lambda c: F.coalesce(F.trim(c), F.lit("")).isin(*NOT_CODED)
    return ~label(name) & ~label(raw)


def sampled_speaker(name: Column, raw: Column) -> Column:
    """Whether there is a name that holds none of the parts."""
    who = F.lower(F.trim(F.coalesce(F.nullif(name, F.lit("")), raw, F.lit(""))))
    return (who != "") & ~reduce(lambda a, b: a | b, (F.contains(who, F.lit(p)) for p in NOT_SAMPLED))


def codable(speeches: DataFrame, most_words: int = MOST_WORDS) -> tuple[DataFrame, DataFrame]:
    """(to code, too long): speeches with an id, a speaker to be coded and 100 characters or more once white space is collapsed, split at the number of words. Columns record_id, text, speaker_name, speaker_raw."""
    rows = speeches.filter((F.coalesce("record_id", F.lit("")) != "") & codable_speaker(F.col("speaker_name"), F.col("speaker_raw"))).withColumn("text", collapsed(F.col("text")))
    long = rows.filter(F.length("text") >= LEAST_CHARS).withColumn("words", words(F.col("text")))
    return long.filter(F.col("words") <= most_words), long.filter(F.col("words") > most_words)


def pool(speeches: DataFrame, least_words: int, most_words: int) -> DataFrame:
    """Speeches that samples draw from."""
    n = words(F.col("text"))
    return speeches.filter(F.col("record_id").isNotNull() & sampled_speaker(F.col("speaker_name"), F.col("speaker_raw")) & n.between(least_words, most_words))


def embeddable(text: Column) -> Column:
    """The text to embed, cut to 8000 characters; null if the whole is shorter than 100."""
    return F.when(F.length(text) >= LEAST_CHARS, F.substring(text, 1, CLIP))
