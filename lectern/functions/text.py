"""Folding, tokens, similarity, fingerprints and ids, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with marks and their base letters, for the Latin letters of the corpus.
MARKED = "àáâãäåāăąçćčďèéêëēĕėęěìíîïĩīĭįñńņňòóôõöōŏőŕřśŝşšșţťțùúûüũūŭůűųýÿžźżÀÁÂÃÄÅĀĂĄÇĆČĎÈÉÊËĒĔĖĘĚÌÍÎÏĨĪĬĮİÑŃŅŇÒÓÔÕÖŌŎŐŔŘŚŜŞŠȘŢŤȚÙÚÛÜŨŪŬŮŰŲÝŸŽŹŻ"
PLAIN = "aaaaaaaaacccdeeeeeeeeeiiiiiiiinnnnoooooooorrsssssttt" + "uuuuuuuuuuyyzzzAAAAAAAAACCCDEEEEEEEEEIIIIIIIIINNNNOOOOOOOORRSSSSSTTTUUUUUUUUUUYYZZZ"
# Characters that stand for letters in badly converted person names.
MOJIBAKE = "„∫˛ºªþÞ™Ðð‡šŠŽžÓ"
MOJIBAKE_FOR = "astsStTSIiaoOeeI"
# Honorifics, and titles, that may stand before a name, in lower case.
HONORIFICS = ("domnișoara", "domnisoara", "domnişoara", "domnul", "doamna", "dl.", "dna.", "dl", "dna")
TITLES = (
    "deputat", "deputata", "deputatã", "deputatul", "senator", "senatorul", "senatoare", "ministru", "ministrul", "ministrului", "secretar", "secretarul",
    "președinte", "presedinte", "preşedinte", "președintele", "presedintele", "preşedintele", "vicepreședinte", "vicepresedinte", "vicepreşedinte",
    "viceprim-ministru", "viceprim", "prim-ministru", "premier", "europarlamentar",
)


def fold(c: Column) -> Column:
    """Strict fold: base letters for marked ones; combining marks and replacement characters are dropped."""
    plain = F.regexp_replace(F.translate(c, MARKED, PLAIN), "[\\u0300-\\u036f\\ufffd]", "")
    return F.when(c.rlike("[^\\x00-\\x7f]"), plain).otherwise(c)


def fold_aggressive(c: Column) -> Column:
    """The fold for person names, which also mends misconverted letters."""
    return fold(F.translate(c, MOJIBAKE, MOJIBAKE_FOR))


def tokens(c: Column) -> Column:
    """Distinct tokens of the lower-case fold, split at all but letters, digits and underscores."""
    return F.array_distinct(F.filter(F.split(F.lower(fold(c)), "[^\\p{L}\\p{N}_]+"), lambda x: x != ""))


def person_tokens(c: Column) -> Column:
    """Distinct tokens of a name: split at white space and hyphens, stripped to a-z and 0-9, two characters or more."""
    parts = F.transform(F.split(F.lower(fold_aggressive(c)), "[\\s-]+"), lambda x: F.regexp_replace(x, "[^a-z0-9]", ""))
    return F.array_distinct(F.filter(parts, lambda x: F.length(x) >= 2))


def peel(c: Column) -> Column:
    """A name without one honorific, one title, what follows a comma, and points at its end; white space is collapsed."""
    out = F.trim(c)
    for group in (HONORIFICS, TITLES):
        out = F.regexp_replace(out, "(?iu)^(?:" + "|".join(x.replace(".", "\\.") for x in group) + ")(?: \\s*|$)", "")
    out = F.trim(F.regexp_replace(F.substring_index(out, ",", 1), "\\s+", " "))
    return F.trim(F.regexp_replace(out, "[.:]+$", ""))


def capped_distance(a: Column, b: Column, cap: int) -> Column:
    """Edit distance, cap + 1 where it is over the cap."""
    d = F.levenshtein(a, b, cap)
    return F.when(d < 0, F.lit(cap + 1)).otherwise(d)


def words(c: Column) -> Column:
    """Number of words between white space; 0 for null and blank texts."""
    return F.size(F.filter(F.split(F.coalesce(c, F.lit("")), "\\s+"), lambda w: w != ""))


def analyzed(c: Column, folded: bool = True) -> Column:
    """Search tokens: runs of letters and digits in lower case, folded if asked; stemming isn't done."""
    low = F.lower(c)
    return F.regexp_extract_all(fold(low) if folded else low, F.lit("[\\p{L}\\p{N}]+"), 0)


def collapsed(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "\\s+", " "))


def fingerprint(c: Column) -> Column:
    """First 12 hex digits of the sha256 of the text with white space collapsed; texts are taken to be in composed form."""
    return F.substring(F.sha2(collapsed(c), 256), 1, 12)


def overlap(a: Column, b: Column) -> Column:
    """Size of the intersection over the smaller set; 0 where either is empty."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


def preview(c: Column, most: int = 200) -> Column:
    """Collapsed text, cut to `most` characters with an ellipsis."""
    t = collapsed(c)
    return F.when(F.length(t) > most, F.concat(F.substring(t, 1, most - 1), F.lit("…"))).otherwise(t)


def line_of(c: Column, offset: Column) -> Column:
    """1-based line of a 0-based offset."""
    head = F.substring(c, F.lit(1), offset.cast("int"))
    return F.length(head) - F.length(F.replace(head, F.lit("\n"), F.lit(""))) + 1


# RFC 4648 base32 letters in lower case.
BASE32 = "abcdefghijklmnopqrstuvwxyz234567"


def short_id(*parts: Column) -> Column:
    """Ten base32 letters: the first six bytes of the sha256 of the parts joined by a bar."""
    bits = F.lpad(F.conv(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 12), 16, 2), 48, "0")
    padded = F.rpad(bits, 50, "0")
    letters = [F.substring(F.lit(BASE32), F.conv(F.substring(padded, 1 + 5 * i, 5), 2, 10).cast("int") + 1, F.lit(1)) for i in range(10)]
    return F.concat(*letters)


def slug(title: Column, short: Column, most: int = 60) -> Column:
    """The first eight folded words of a title joined by hyphens, cut to `most` characters, then the short id."""
    words_ = F.regexp_replace(F.regexp_replace(F.lower(fold(F.coalesce(title, F.lit("")))), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    head = F.regexp_replace(F.substring(F.array_join(F.slice(F.split(words_, "-"), 1, 8), "-"), 1, most), "-+$", "")
    return F.when(head == "", short).otherwise(F.concat_ws("-", head, short))


def committee_slug(c: Column) -> Column:
    """Lower case; letters and digits stay with their marks, spaces and hyphens become hyphens, all else goes."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(c), "[^\\p{L}\\p{N} -]", ""), "[ -]+", "-"), "^-+|-+$", "")


def safe_date(c: Column) -> Column:
    """The string, or null where its first ten characters are no date."""
    return F.when(F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd").isNotNull(), c)
