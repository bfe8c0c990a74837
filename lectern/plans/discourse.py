"""Discourse codings of speeches made flat: scores, kinds, voices, DQI codings and where the evidence stands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.extract import quoted_at
from lectern.plans.grains import or_else

EVIDENCE = "struct<text:string>"
MARKER = f"struct<kind:string,value:string,marker_confidence:double,rationale_short:string,evidence:{EVIDENCE}>"
FRAMEWORK = f"struct<score:int,framework_confidence:double,framework_version:string,rationale:string,markers:array<{MARKER}>>"
VOICE = f"struct<classifications:array<struct<voice:string,marker_id:string,attributed_to:string,voice_confidence:double,rationale_short:string,voice_evidence:{EVIDENCE}>>>"
DQI = (
    "struct<level_of_justification:int,respect_for_groups:int,respect_for_demands:int,respect_for_counterarguments:int,content_of_justification:string,constructive_politics:string,"
    f"framework_confidence:double,framework_version:string,rationale:string,markers:array<{MARKER}>>"
)
PAYLOAD = f"hawkins {FRAMEWORK}, vparty {FRAMEWORK}, voice {VOICE}, dqi {DQI}, text_fingerprint string, _meta struct<producer:string>"
PRODUCER = "flash-lite"  # Fixed value: the producer where an entry names none.


def parsed(payload: Column) -> Column:
    """A producer's JSON entry; parts that don't fit are null."""
    return F.from_json(payload, PAYLOAD, {"mode": "PERMISSIVE"})


def _kept(markers: Column) -> Column:
    return F.filter(markers, lambda m: m["kind"].isNotNull())


def framework(part: Column) -> Column:
    """score, confidence, version, marker_count (of all entries), distinct kinds in order, and the markers that have a kind; null without the part."""
    kinds = F.array_distinct(F.transform(_kept(part["markers"]), lambda m: m["kind"]))
    return F.when(
        part.isNotNull(),
        F.struct(
            part["score"].alias("score"), part["framework_confidence"].alias("framework_confidence"), or_else(part["framework_version"]).alias("framework_version"), or_else(part["rationale"]).alias("rationale"),
            F.when(part["markers"].isNotNull(), F.size(part["markers"])).alias("marker_count"), F.when(F.size(kinds) > 0, kinds).alias("marker_kinds"), F.when(F.size(kinds) > 0, _kept(part["markers"])).alias("markers"),
        ),
    )


def voice(part: Column) -> Column:
    """The voice found most often (ties to the first seen), the voices in order, and the entries; null where none has a voice."""
    known = F.filter(part["classifications"], lambda c: c["voice"].isNotNull())
    names = F.transform(known, lambda c: c["voice"])
    seen = F.array_distinct(names)
    ranked = F.array_sort(F.transform(seen, lambda v, i: F.struct((-F.size(F.filter(names, lambda n: n == v))).alias("n"), i.alias("i"), v.alias("v"))))
    return F.when(F.size(known) > 0, F.struct(F.get(ranked, F.lit(0))["v"].alias("dominant_voice"), seen.alias("voices_seen"), known.alias("classifications")))


def dqi(part: Column) -> Column:
    codings = ("level_of_justification", "respect_for_groups", "respect_for_demands", "respect_for_counterarguments", "content_of_justification", "constructive_politics", "framework_confidence")
    kept = _kept(part["markers"])
    return F.when(part.isNotNull(), F.struct(*(part[c].alias(c) for c in codings), or_else(part["framework_version"]).alias("framework_version"), or_else(part["rationale"]).alias("rationale"), F.when(F.size(kept) > 0, kept).alias("markers")))


def flattened(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds `discourse`, its producer and its text's fingerprint."""
    rows = df.withColumn("_p", parsed(F.col(payload)))
    p = F.col("_p")
    any_part = p["hawkins"].isNotNull() | p["voice"].isNotNull() | p["dqi"].isNotNull() | p["vparty"].isNotNull()
    return rows.withColumns(
        {
            "discourse": F.struct(framework(p["hawkins"]).alias("hawkins"), framework(p["vparty"]).alias("vparty"), voice(p["voice"]).alias("voice"), dqi(p["dqi"]).alias("dqi")),
            "discourse_producer": F.coalesce(p["_meta"]["producer"], F.when(any_part, PRODUCER)),
            "discourse_text_fingerprint": p["text_fingerprint"],
        }
    ).drop("_p")


def evidence(df: DataFrame, ident: str, text: str, markers: Column) -> DataFrame:
    """(id, kind, evidence, char_range): where each marker's evidence stands in its speech, null where it isn't found."""
    rows = df.select(ident, F.col(text).alias("_t"), F.explode(markers).alias("m"))
    return rows.select(ident, F.col("m.kind").alias("kind"), F.col("m.evidence.text").alias("evidence"), quoted_at(F.col("_t"), F.col("m.evidence.text")).alias("char_range"))


def missing_evidence(found: DataFrame, ident: str) -> DataFrame:
    """Per record the evidence texts that don't stand in its speech."""
    return found.filter(F.col("char_range").isNull() & (F.coalesce("evidence", F.lit("")) != "")).groupBy(ident).agg(F.array_sort(F.collect_set("evidence")).alias("fragments_not_found"))


def attached(records: DataFrame, entries: DataFrame) -> DataFrame:
    """Records with their entries' payload by record_id, null where there is none."""
    return records.join(entries.select("record_id", "payload"), "record_id", "left")
