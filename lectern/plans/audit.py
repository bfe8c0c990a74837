"""Playback checks: whether what was extracted stands in the source text, and whether the served grains are what was extracted.

Checks take flat frames: `records` (document_id, record_id, kind, position, span_end, ...) joined with `bodies` (document_id, body) on the document. Each gives issues (document_id, record_id, kind, detail).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import fold, overlap, peel, person_tokens
from lectern.operators.joins import unclaimed

# Speaker headers, headers that are no speakers, and phrases at which votes open.
HEADERS = (
    r"##[^\S\n]+\*\*\s*([^*\n]+?)\s*\*\*\s*[–\-]\s*_[^_\n]+_\s*\*\*:\*\*",
    r"##[^\S\n]+\*\*\s*([^*\n]+?)\s*\*\*\s*:?",
    r"\*\*\s*([^*\n]+?)\s*\*\*\s*[–\-]\s*_[^_\n]+_\s*\*\*:\*\*",
    r"\*\*\s*([^*\n]+?)\s*\*\*\s*[–\-]\s*_[^_\n]+_\s*:",
)
NO_SPEAKERS = (
    r"(?iu)(?:PARTEA|PA\s*R\s*T\s*E\s*A|DEZBATERI\s+PARLAMENTARE|(?:[ȘŞSª™�]|fi)EDIN[ȚŢTÞfi]+E\s+COMUNE|[ȘŞSª™�]edin[țţtþfi]+a\s+(?:din\s+ziua|comun[ăaã])|[ȘŞSª™�]edin[țţtþfi]+a\s+(?:a\s+început|începe)|SESIUNEA|SUMAR|STENOGRAMA|"
    r"CAMERA\s+DEPUTA[ȚŢTÞfi]+ILOR|SENATUL|EDITOR|A\s*B\s*O\s*N\s*A\s*M\s*E\s*N\s*T\s*E|MONITORUL\s+OFICIAL|ISSN|RAPOARTE\s+DE\s+ACTIVITATE|LISTA\s+ÎNTREB[ĂA]RILOR|LISTA\s+ÎNTREB[ÃA]RILOR|LISTA\s+INTREBARILOR|SINTEZA\s+LUCR[ĂÃA]RILOR)"
)
VOTE_OPENS = (
    r"(?iu)\bSupun(?:em)?\s+votului\b|\bV[ăa]\s+rog\s+s[ăa]\s+v[ăa]\s+preg[ăa]ti[țt]i\s+(?:de|pentru)\s+vot\b|\bS[ăa]\s+înceap[ăa]\s+votul\b|\bTrecem\s+la\s+vot\b|\bV[ăa]\s+rog\s+s[ăa]\s+vota[țt]i\b|"
    r"\bCine\s+este\s+pentru\b|\bCine\s+(?:e|este)\s+împotriv[ăa]\b|\bCine\s+se\s+ab[țt]ine\b"
)
# How far checks look ahead, how near a record must stand to a header, and the least share of shared name tokens.
HEADER_REACH, NAME_REACH, VOTE_REACH, TEXT_HEAD, NEAR, LEAST_OVERLAP = 200, 600, 300, 80, 100, 0.5
EVENTS = ("narrator", "procedural", "vote", "deferral")
NARRATION = "<chair narration>"


def _issues(rows: DataFrame, kind: str, detail: Column) -> DataFrame:
    return rows.select("document_id", "record_id", F.lit(kind).alias("kind"), detail.cast("string").alias("detail"))


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def placed(records: DataFrame, bodies: DataFrame) -> DataFrame:
    return records.join(bodies.select("document_id", "body"), "document_id").withColumn("_in", F.col("position").between(0, F.length("body") - 1))


def no_speaker(name: Column) -> Column:
    """Whether a header names a section: by its words, or because it is written in spaced letters."""
    words = F.filter(F.split(F.trim(name), r"\s+"), lambda w: w != "")
    single = F.size(F.filter(words, lambda w: F.length(w) == 1))
    return name.rlike(NO_SPEAKERS) | ((F.size(words) >= 3) & (single >= F.greatest(F.lit(3), F.floor(F.size(words) / 2))))


def header_at(body: Column, position: Column) -> Column:
    """The name in the speaker header that begins at a position or up to 30 blanks after it; null without one."""
    head = F.substring(body, (position + 1).cast("int"), F.lit(HEADER_REACH))
    found = [F.when(head.rlike(p), F.trim(F.regexp_extract(head, p, 1))) for p in (rf"(?s)\A\s{{0,30}}{h}[^\S\n]*(?:\n|\z)" for h in HEADERS)]
    return F.coalesce(*found)


def name_overlap(a: Column, b: Column) -> Column:
    bare = lambda c: person_tokens(F.regexp_replace(peel(c), r"[:;,.()]+$", ""))
    return overlap(bare(a), bare(b))


def speeches(records: DataFrame, bodies: DataFrame) -> DataFrame:
    """Speeches that have no span, lie outside the body, stand under another speaker's header or under none, or whose text isn't what stands there. What goes on after an event needs no header, nor does narration.

    records: also parent (the agenda item), speaker_raw, speaker_name, text.
    """
    before = F.lag("kind").over(Window.partitionBy("document_id", "parent").orderBy(F.coalesce("position", F.lit(0)), "record_id"))
    rows = placed(records.withColumn("_before", before), bodies).filter("kind = 'speech'")
    inside = rows.filter("_in").withColumn("_header", header_at(F.col("body"), F.col("position")))
    told = inside.filter(F.coalesce(F.trim("speaker_raw") != NARRATION, F.lit(True)) & ~F.coalesce(no_speaker(F.col("_header")), F.lit(False)))
    name = F.coalesce(F.nullif("speaker_name", F.lit("")), F.col("speaker_raw"), F.lit(""))
    head = F.substring(F.trim(F.coalesce("text", F.lit(""))), 1, TEXT_HEAD)
    slab = F.substring(F.col("body"), (F.col("position") + 1).cast("int"), (F.col("span_end") - F.col("position")).cast("int"))
    flat = lambda c: F.regexp_replace(c, r"\s+", " ")
    spanned = told.filter(F.col("span_end").isNotNull() & (F.col("span_end") <= F.length("body")) & (head != ""))
    return _all(
        [
            _issues(rows.filter("position is null"), "span_missing", F.lit(None)),
            _issues(rows.filter("position is not null and not _in"), "position_oor_sidecar", F.col("position")),
            _issues(told.filter(F.col("_header").isNotNull() & (name_overlap(F.col("_header"), name) < LEAST_OVERLAP)), "speaker_mismatch", F.col("_header")),
            _issues(told.filter(F.col("_header").isNull() & ~F.coalesce(F.col("_before").isin(*EVENTS), F.lit(False))), "invented_or_misplaced_speech", F.col("position")),
            _issues(spanned.filter(~slab.contains(head) & ~flat(slab).contains(flat(head))), "span_text_mismatch", head),
        ]
    )


def dropped_turns(headers: DataFrame, starts: DataFrame, excluded: DataFrame) -> DataFrame:
    """Speaker headers (document_id, position, name) that no record's start lies near, outside the excluded intervals (document_id, start, end)."""
    spans = excluded.select("document_id", "start", "end")
    open_ = headers.filter(~no_speaker(F.col("name")))
    edges = open_.select("document_id", "position", F.lit(1).alias("side"), F.col("name")).unionByName(spans.select("document_id", F.col("start").alias("position"), F.lit(0).alias("side"), "end"), allowMissingColumns=True)
    reach = F.max("end").over(Window.partitionBy("document_id").orderBy("position", "side").rowsBetween(Window.unboundedPreceding, 0))
    outside = edges.withColumn("_reach", reach).filter("side = 1 and (_reach is null or _reach <= position)").select("document_id", "position", "name")
    lost = unclaimed(outside, starts.select("document_id", F.col("position").alias("start")), "document_id", "position", "start", NEAR)
    return lost.select("document_id", F.lit(None).cast("string").alias("record_id"), F.lit("dropped_turn").alias("kind"), F.col("name").alias("detail"))


def title_form(c: Column) -> Column:
    """Lower case without marks, line breaks and odd hyphens."""
    low = F.regexp_replace(F.lower(c), r"<\s*br\s*/?\s*>", " ")
    return F.regexp_replace(fold(F.regexp_replace(low, "[\\u2010-\\u2015\\u2212\\u00ad]", "-")), r"\s+", " ")


def agenda_titles(records: DataFrame, bodies: DataFrame) -> DataFrame:
    """Titles of which neither head (with or without pages), tail nor middle stands in the body."""
    rows = records.filter(F.trim("title") != "").join(bodies.select("document_id", title_form(F.col("body")).alias("_b")), "document_id").withColumn("_t", title_form(F.trim("title")))
    bare = F.rtrim(F.regexp_replace("_t", r"\s+\d+(?:\s*[-–]\s*\d+)?\s*$", ""))
    size, half = F.length("_t"), F.floor(F.length("_t") / 2).cast("int")
    pieces = [F.substring("_t", 1, 40), F.nullif(F.substring(bare, 1, 40), F.lit("")), F.when(size >= 60, F.substring(F.col("_t"), size - 39, F.lit(40))), F.when(size >= 90, F.substring(F.col("_t"), half - 14, F.lit(30)))]
    stands = reduce(lambda a, b: a | b, (F.coalesce(F.col("_b").contains(p), F.lit(False)) for p in pieces))
    return _issues(rows.filter(~stands), "agenda_title_not_in_body", F.substring("title", 1, 80))


def questioners(records: DataFrame, bodies: DataFrame) -> DataFrame:
    """Interpellations whose questioner is named, by name or by half of its longer tokens, nowhere near their start."""
    rows = placed(records.filter("position is not null"), bodies)
    named = rows.filter(F.col("_in") & (F.coalesce("speaker_name", F.lit("")) != ""))
    chunk = F.lower(fold(F.substring(F.col("body"), (F.col("position") + 1).cast("int"), F.lit(NAME_REACH))))
    name = F.lower(fold(F.regexp_replace(peel(F.col("speaker_name")), r"[:;,.()]+$", "")))
    parts = F.filter(F.split(name, r"[\s-]+"), lambda t: F.length(t) >= 3)
    seen = F.size(F.filter(parts, lambda t: F.contains(chunk, t)))
    enough = (F.size(parts) > 0) & (seen >= F.greatest(F.lit(1), F.floor(F.size(parts) / 2)))
    missing = named.filter(~((name != "") & F.contains(chunk, name)) & ~enough)
    return _all([_issues(rows.filter(~F.col("_in")), "position_oor_sidecar", F.col("position")), _issues(missing, "interpellation_questioner_missing", F.col("speaker_name"))])


def questions(records: DataFrame, bodies: DataFrame) -> DataFrame:
    """Questions whose registration number doesn't stand in their span."""
    rows = placed(records.filter("position is not null and span_end is not null"), bodies)
    window = F.substring(F.col("body"), (F.col("position") + 1).cast("int"), (F.col("span_end") - F.col("position")).cast("int"))
    lost = rows.filter(F.col("_in") & (F.coalesce("regnum", F.lit("")) != "") & ~F.contains(window, F.col("regnum")))
    return _all([_issues(rows.filter(~F.col("_in")), "position_oor_sidecar", F.col("position")), _issues(lost, "question_regnum_missing", F.col("regnum"))])


def votes(records: DataFrame, bodies: DataFrame) -> DataFrame:
    """Votes without an opening phrase near their start."""
    rows = placed(records.filter("position is not null"), bodies).filter("_in")
    window = F.substring(F.col("body"), (F.col("position") + 1).cast("int"), F.lit(VOTE_REACH))
    return _issues(rows.filter(~window.rlike(VOTE_OPENS)), "vote_open_missing", F.col("position"))


def served(hits: DataFrame, extracted: DataFrame, documents: DataFrame) -> DataFrame:
    """Whether served records (document_id, grain, record_id, position) are those extracted (document_id, record_id) and add up to the documents' counts (document_id, body_chars, counts map<grain, n>)."""
    doubled = hits.groupBy("document_id", "record_id").agg(F.count("*").alias("n")).filter("n > 1")
    sized = hits.join(documents.select("document_id", "body_chars"), "document_id")
    good = (F.col("position") >= 0) & (F.col("position") < F.col("body_chars"))
    last = F.last(F.when(good, F.col("position")), ignorenulls=True).over(Window.partitionBy("document_id").orderBy(F.col("seq"), "record_id").rowsBetween(Window.unboundedPreceding, -1))
    ordered = sized.withColumn("seq", F.coalesce("seq", F.lit(0)) if "seq" in sized.columns else F.lit(0)).withColumn("_last", last)
    want = documents.select("document_id", F.explode("counts").alias("grain", "want"))
    have = hits.groupBy("document_id", "grain").agg(F.count("*").alias("have"))
    differ = want.join(have, ["document_id", "grain"], "left").filter(F.coalesce("have", F.lit(0)) != F.coalesce("want", F.lit(0)))
    both = ["document_id", "record_id"]
    return _all(
        [
            _issues(doubled, "dup_record_id", F.col("n")),
            _issues(sized.filter("position is null"), "missing_position", F.lit(None)),
            _issues(sized.filter(F.col("position").isNotNull() & ~good), "position_oor", F.col("position")),
            _issues(ordered.filter(good & (F.col("position") < F.col("_last"))), "non_monotonic", F.col("position")),
            differ.select("document_id", F.lit(None).cast("string").alias("record_id"), F.lit("count_mismatch").alias("kind"), F.concat_ws(":", "grain", "want", F.coalesce("have", F.lit(0))).alias("detail")),
            _issues(extracted.select(*both).distinct().join(hits.select(*both), both, "left_anti"), "missing_in_es", F.lit(None)),
            _issues(hits.select(*both).distinct().join(extracted.select(*both), both, "left_anti"), "orphan_in_es", F.lit(None)),
        ]
    )


def idempotent(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows that two runs over the same input don't share, with the run they are of; none if a run repeats itself."""
    return first.exceptAll(second).withColumn("run", F.lit(1)).unionByName(second.exceptAll(first).withColumn("run", F.lit(2)))


def occurrences(speeches_: DataFrame, bodies: DataFrame, raw: str, around: int = 200) -> DataFrame:
    """Where a raw speaker form stands, with the text around it."""
    rows = placed(speeches_.filter(F.col("speaker_raw") == raw), bodies).filter("_in")
    begin = F.greatest(F.col("position") - around, F.lit(0))
    return rows.select("document_id", "record_id", "position", F.substring(F.col("body"), (begin + 1).cast("int"), (F.col("position") - begin + around).cast("int")).alias("excerpt"))


def versions(docs: DataFrame) -> DataFrame:
    """(component, version, documents) over the documents' maps of component versions."""
    return docs.select(F.explode("extraction.extractor_versions").alias("component", "version")).groupBy("component", "version").agg(F.count("*").alias("documents"))
