"""The nine flat grains of nested sidecar documents.

A sidecar is one row of SIDECAR. Every grain is a narrow projection: the arrays that it needs are exploded, parents' columns are copied in, and Parquet reads no other branch of the tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import committee_slug, safe_date

SPEAKER = "struct<raw:string,name:string,title:string,role:string,party_group:string,person_id:string>"
REFS = "array<struct<type:string,raw:string,prefix:string,number:string,year:int,name:string,char_offsets:array<int>,title:string,motion_kind:string,resolved_to:struct<char_offsets:array<int>>>>"
SPAN = "struct<chars:array<int>,lines:array<int>,content_sha:string>"
ACTIVITY = (
    f"struct<id:string,type:string,text:string,slug:string,content_fingerprint:string,delivery_mode:string,speaker:{SPEAKER},references_mentioned:{REFS},motion_text:string,motion_type:string,voting_method:string,"
    f"outcome:string,defers_to:string,resolves:array<string>,quorum_announced:boolean,proposed_by:{SPEAKER},counts:struct<`for`:string,against:int,abstain:int,not_voting:int,total_voting:int>,source_span:{SPAN}>"
)
SIDECAR = (
    "schema_version string, document_id string, content_sha string, document_type string, "
    "metadata struct<issue:string,part:string,published:string,chamber:string,session_type:string,session_date:string,legislature:string,year:int>, "
    "extraction struct<extractor:string,extracted_at:string,extractor_versions:map<string,string>>, coverage struct<body_chars:int,claimed_chars:int,claimed_pct:double>, "
    "body struct<session:struct<chambers_present:array<string>>,chamber:string,"
    f"agenda_items:array<struct<id:string,ordinal:int,title:string,category:string,outcome:string,confidence_type:string,requested_by_group:string,reexamination_reason:string,slug:string,content_fingerprint:string,topics:struct<`primary`:array<string>,secondary:array<string>>,primary_references:{REFS},activities:array<{ACTIVITY}>,source_span:{SPAN}>>,"
    f"interpellations:array<struct<id:string,interpellation_number:string,questioner:{SPEAKER},addressed_to:string,addressed_to_normalized:string,topic:string,question_text:string,response:struct<speaker:{SPEAKER},text:string>,response_deferred:boolean,genre:string,delivery_mode:string,slug:string,content_fingerprint:string,source_span:{SPAN}>>,"
    f"questions:array<struct<id:string,registration_number:string,registration_date:string,questioner:{SPEAKER},addressee:struct<name:string,ministry:string,ministry_normalized:string,institutional_normalized:string>,topic:string,question_text:string,delivery_mode:string,slug:string,content_fingerprint:string,source_span:{SPAN}>>,"
    f"committees:array<struct<id:string,name:string,kind:string,joint_with:array<string>,meetings:array<struct<id:string,dates:array<string>,format:string,purpose:string,slug:string,content_fingerprint:string,agenda:array<struct<ordinal:int,title:string,committee_role:string,outcome_text:string,vote_summary:struct<outcome:string>,primary_references:{REFS}>>,roster:array<struct<speaker:{SPEAKER},mode:string,intra_committee_role:string>>,source_span:{SPAN}>>>>,"
    "report:struct<id:string,issuing_body:string,issuing_body_normalized:string,title:string,slug:string,content_fingerprint:string,reporting_period:struct<`from`:string,`to`:string>,received_at:struct<session_date:string,session_kind:string,received_in_document:string>>,"
    "headings:array<struct<level:int,text:string>>>, _corrupt_record string"
)
# The least length of a substantive speech, and paths by grain.
SUBSTANTIVE = 100
URLS = {"speeches": "/discurs/", "agenda_items": "/agenda/", "interpellations": "/interpelare/", "committee_meetings": "/comisie/", "reports": "/raport/"}


def read_sidecars(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(documents, rejects) of a folder of JSON files, one document each."""
    rows = spark.read.schema(SIDECAR).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path).withColumn("source_file", F.input_file_name())
    good = F.col("_corrupt_record").isNull() & F.col("document_id").isNotNull()
    return rows.filter(good), rows.filter(~good)


def or_else(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def _chamber() -> Column:
    present = F.col("body.session.chambers_present")
    return or_else(F.col("metadata.chamber"), F.when(F.size(present) > 0, F.array_join(present, ", ")))


def _parent() -> list[Column]:
    m = F.col("metadata")
    return [_chamber().alias("chamber"), safe_date(or_else(m["session_date"], m["published"])).alias("session_date"), m["session_type"].alias("session_type"), m["legislature"].alias("legislature"), m["year"].alias("year"), m["issue"].alias("issue")]


def _common(record: Column, mark: Column) -> list[Column]:
    return [record.alias("record_id"), F.col("document_id"), F.coalesce(mark, F.col("content_sha")).alias("content_fingerprint"), F.col("content_sha").alias("content_sha_source"), F.col("extraction.extractor_versions").alias("extractor_versions"), F.col("schema_version")]


def position(span: Column) -> Column:
    return F.get(span["chars"], F.lit(0)).cast("int")


def url(grain: str, slug: Column) -> Column:
    return F.when(F.nullif(slug, F.lit("")).isNotNull(), F.concat(F.lit(URLS[grain]), slug))


def flat_refs(refs: Column) -> Column:
    """types, bills, laws, codes, ougs, ogs and raw texts of references, each once in order of appearance."""
    dated = lambda r: F.concat(r["number"], F.lit("/"), r["year"].cast("string"))
    has = lambda r: (F.coalesce(r["number"], F.lit("")) != "") & (F.coalesce(r["year"], F.lit(0)) != 0)
    pick = lambda kind, value, test: F.coalesce(F.array_distinct(F.transform(F.filter(refs, lambda r: (r["type"] == kind) & test(r)), value)), F.array().cast("array<string>"))
    each = lambda value: F.coalesce(F.array_distinct(F.filter(F.transform(refs, value), lambda x: F.coalesce(x, F.lit("")) != "")), F.array().cast("array<string>"))
    return F.struct(
        each(lambda r: or_else(r["type"], F.lit("unknown"))).alias("types"),
        pick("bill", lambda r: F.concat(or_else(r["prefix"], F.lit("PL-x")), F.lit(":"), dated(r)), has).alias("bills"),
        pick("law", dated, has).alias("laws"),
        pick("code", lambda r: or_else(r["name"], r["raw"]), lambda r: or_else(r["name"], r["raw"]).isNotNull()).alias("codes"),
        pick("oug", dated, has).alias("ougs"),
        pick("og", dated, has).alias("ogs"),
        each(lambda r: r["raw"]).alias("raw"),
    )


def ref_keys(refs: Column) -> Column:
    """Keys prefix-or-type:number/year, else the raw text, each once."""
    has = lambda r: (F.coalesce(r["number"], F.lit("")) != "") & (F.coalesce(r["year"], F.lit(0)) != 0)
    key = lambda r: F.when(has(r), F.concat(or_else(r["prefix"], r["type"], F.lit("unknown")), F.lit(":"), r["number"], F.lit("/"), r["year"].cast("string"))).otherwise(r["raw"])
    return F.coalesce(F.array_distinct(F.filter(F.transform(refs, key), lambda x: F.coalesce(x, F.lit("")) != "")), F.array().cast("array<string>"))


def speaker(s: Column, mode: Column) -> Column:
    return F.struct(s["person_id"].alias("person_id"), s["raw"].alias("name_raw"), or_else(s["name"], s["raw"]).alias("name_search"), s["title"].alias("title"), s["role"].alias("role"), s["party_group"].alias("party_group_at_time"), mode.alias("delivery_mode"))


def government(s: Column) -> Column:
    """person_id, name and whether it is the government; null without a proposer."""
    name = or_else(s["name"], s["raw"])
    is_it = F.coalesce(s["person_id"] == "guvern", F.lit(False)) | F.coalesce(F.lower(F.trim(name)).isin("guvern", "guvernul"), F.lit(False)) | F.coalesce(s["role"] == "guvern", F.lit(False))
    return F.when(s.isNotNull(), F.struct(s["person_id"].alias("person_id"), name.alias("name"), is_it.alias("is_government")))


def documents(df: DataFrame) -> DataFrame:
    acts = F.flatten(F.transform("body.agenda_items", lambda a: F.coalesce(a["activities"], F.array().cast(f"array<{ACTIVITY}>"))))
    n = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    kind = lambda k: n(F.filter(acts, lambda a: a["type"] == k))
    m = F.col("metadata")
    title = or_else(
        F.col("body.report.title"),
        F.array_join(F.filter(F.array(or_else(m["chamber"]), F.concat(F.lit("MO "), F.coalesce(m["issue"], F.lit("")), F.lit("/"), F.coalesce(m["year"].cast("string"), F.lit(""))), or_else(m["session_date"], m["published"])), lambda x: x.isNotNull()), " · "),
    )
    tail = F.regexp_replace("document_id", "^mo://", "")
    return df.select(
        *_common(F.col("document_id"), F.col("content_sha")), *_parent(), m["part"].alias("part"), safe_date(m["published"]).alias("published"), F.col("document_type"), title.alias("title"),
        n(F.col("body.agenda_items")).alias("agenda_count"), kind("speech").alias("speech_count"), kind("vote").alias("vote_count"), n(F.col("body.interpellations")).alias("interpellation_count"), n(F.col("body.questions")).alias("question_count"),
        F.coalesce(F.aggregate(F.transform("body.committees", lambda c: n(c["meetings"])), F.lit(0), lambda s, x: s + x), F.lit(0)).alias("committee_count"), F.when(F.col("body.report").isNotNull(), 1).otherwise(0).alias("report_count"),
        F.struct(F.col("coverage.claimed_pct").alias("claimed_pct"), F.col("coverage.body_chars").alias("body_chars")).alias("coverage"), or_else(F.col("body.report.slug"), F.replace(tail, F.lit("/"), F.lit("-"))).alias("slug"), F.concat(F.lit("/mo/"), tail).alias("url_path"),
    )


def _exploded(df: DataFrame, array: str) -> DataFrame:
    return df.withColumn("x", F.explode(array)).filter(F.coalesce(F.col("x.id"), F.lit("")) != "")


def agenda_items(df: DataFrame) -> DataFrame:
    x = F.col("x")
    people = F.array_distinct(F.filter(F.transform(x["activities"], lambda a: a["speaker"]["person_id"]), lambda p: F.coalesce(p, F.lit("")) != ""))
    votes = F.filter(x["activities"], lambda a: a["type"] == "vote")
    refs = flat_refs(x["primary_references"])
    return _exploded(df, "body.agenda_items").select(
        *_common(x["id"], x["content_fingerprint"]), *_parent(), x["ordinal"].alias("ordinal"), position(x["source_span"]).alias("position_in_document"),
        *(x[c].alias(c) for c in ("category", "title", "outcome", "confidence_type", "requested_by_group", "reexamination_reason")), F.coalesce(x["topics"]["primary"], F.array().cast("array<string>")).alias("topics_primary"),
        F.struct(*(refs[k].alias(k) for k in ("types", "bills", "laws", "codes", "raw"))).alias("refs"), F.coalesce(people, F.array().cast("array<string>")).alias("speaker_person_ids"),
        F.struct(F.greatest(F.coalesce(F.size(votes), F.lit(0)), F.lit(0)).alias("total_votes"), F.coalesce(F.array_distinct(F.filter(F.transform(votes, lambda v: v["outcome"]), lambda o: F.coalesce(o, F.lit("")) != "")), F.array().cast("array<string>")).alias("outcomes")).alias("vote_summary"),
        x["slug"].alias("slug"), url("agenda_items", x["slug"]).alias("url_path"),
    )


def _activities(df: DataFrame, kind: str) -> DataFrame:
    kept = F.filter("item.activities", lambda a: (a["type"] == kind) & (F.coalesce(a["id"], F.lit("")) != ""))
    return df.withColumn("item", F.explode("body.agenda_items")).select("*", F.posexplode(kept).alias("at", "x"))


def speeches(df: DataFrame) -> DataFrame:
    """One row per speech; `position_in_agenda` counts the item's speeches from 1."""
    x, item = F.col("x"), F.col("item")
    text = F.coalesce(x["text"], F.lit(""))
    return _activities(df, "speech").select(
        *_common(x["id"], x["content_fingerprint"]), *_parent(), item["ordinal"].alias("agenda_ordinal"), item["title"].alias("agenda_title"), item["category"].alias("agenda_category"), item["outcome"].alias("agenda_outcome"),
        speaker(x["speaker"], x["delivery_mode"]).alias("speaker"), text.alias("text"), F.length(text).alias("text_length"), (F.length(text) >= SUBSTANTIVE).alias("is_substantive"), (F.col("at") + 1).alias("position_in_agenda"), position(x["source_span"]).alias("position_in_document"),
        flat_refs(x["references_mentioned"]).alias("refs"), x["slug"].alias("slug"), url("speeches", x["slug"]).alias("url_path"),
    )


def votes(df: DataFrame) -> DataFrame:
    x, item = F.col("x"), F.col("item")
    c = x["counts"]
    refs = flat_refs(item["primary_references"])
    return _activities(df, "vote").select(
        *_common(x["id"], x["content_fingerprint"]), *_parent(), item["ordinal"].alias("agenda_ordinal"), item["title"].alias("agenda_title"), item["category"].alias("agenda_category"), position(x["source_span"]).alias("position_in_document"),
        *(x[k].alias(k) for k in ("motion_type", "voting_method", "outcome")),
        F.struct(c["for"].try_cast("int").alias("for"), F.coalesce(c["for"] == "unanimous", F.lit(False)).alias("for_unanimous"), c["against"].alias("against"), c["abstain"].alias("abstain"), c["not_voting"].alias("not_voting"), c["total_voting"].alias("total")).alias("counts"),
        x["quorum_announced"].alias("quorum_met"), F.coalesce(x["outcome"] == "deferred", F.lit(False)).alias("deferred"), x["defers_to"].alias("defers_to"), F.coalesce(x["resolves"], F.array().cast("array<string>")).alias("resolves"),
        F.struct(*(refs[k].alias(k) for k in ("types", "bills", "laws"))).alias("refs"), government(x["proposed_by"]).alias("proposed_by"), F.concat(F.lit("/vot/"), F.substring_index(x["slug"], "-", -1)).alias("url_path"),
    )


def interpellations(df: DataFrame) -> DataFrame:
    x = F.col("x")
    answer = F.when(x["response"].isNotNull(), F.struct(speaker(x["response"]["speaker"], F.lit(None).cast("string")).alias("speaker"), x["response"]["text"].alias("text")))
    return _exploded(df, "body.interpellations").select(
        *_common(x["id"], x["content_fingerprint"]), *_parent(), x["interpellation_number"].alias("interpellation_number"), position(x["source_span"]).alias("position_in_document"), speaker(x["questioner"], F.lit(None).cast("string")).alias("questioner"),
        *(x[k].alias(k) for k in ("addressed_to", "addressed_to_normalized", "topic", "question_text", "response_deferred", "genre", "delivery_mode")), answer.alias("response"), x["slug"].alias("slug"), url("interpellations", x["slug"]).alias("url_path"),
    )


def questions(df: DataFrame) -> DataFrame:
    x = F.col("x")
    to = x["addressee"]
    return _exploded(df, "body.questions").select(
        *_common(x["id"], x["content_fingerprint"]), or_else(F.col("body.chamber"), F.col("metadata.chamber")).alias("chamber"), x["registration_number"].alias("regnum"), safe_date(x["registration_date"]).alias("regdate"), position(x["source_span"]).alias("position_in_document"),
        speaker(x["questioner"], F.lit(None).cast("string")).alias("questioner"), F.struct(or_else(to["ministry"], to["name"]).alias("raw"), to["ministry_normalized"].alias("ministry_normalized"), to["institutional_normalized"].alias("institutional_normalized")).alias("addressee"),
        x["topic"].alias("topic"), x["question_text"].alias("text"), x["delivery_mode"].alias("delivery_mode"),
    )


def committee_meetings(df: DataFrame) -> DataFrame:
    """A meeting carries its committee's own fields, not the committee with all its meetings."""
    own = lambda c: F.transform(c["meetings"], lambda x: F.struct(F.struct(*(c[k].alias(k) for k in ("id", "name", "kind", "joint_with"))).alias("c"), x.alias("x")))
    held = F.flatten(F.filter(F.transform("body.committees", own), lambda m: m.isNotNull()))
    rows = df.withColumn("m", F.explode(held)).filter(F.coalesce(F.col("m.x.id"), F.lit("")) != "")
    c, x = F.col("m.c"), F.col("m.x")
    agenda = F.transform(x["agenda"], lambda a: F.struct(a["ordinal"].alias("ordinal"), a["title"].alias("title"), a["committee_role"].alias("role"), a["vote_summary"]["outcome"].alias("outcome"), a["outcome_text"].alias("outcome_text"), ref_keys(a["primary_references"]).alias("primary_references")))
    roster = F.transform(x["roster"], lambda r: F.struct(r["speaker"]["person_id"].alias("person_id"), or_else(r["speaker"]["name"], r["speaker"]["raw"]).alias("name"), r["mode"].alias("status"), r["intra_committee_role"].alias("role"), r["speaker"]["party_group"].alias("party_group_at_time")))
    return rows.select(
        *_common(x["id"], x["content_fingerprint"]), or_else(c["id"], committee_slug(F.trim(c["name"]))).alias("committee_id"), c["name"].alias("committee_name"), c["kind"].alias("committee_kind"), F.coalesce(c["joint_with"], F.array().cast("array<string>")).alias("joint_with"),
        safe_date(F.get(x["dates"], F.lit(0))).alias("meeting_date"), position(x["source_span"]).alias("position_in_document"), x["format"].alias("format"), x["purpose"].alias("purpose"), agenda.alias("agenda_items"), roster.alias("roster"),
    )


def reports(df: DataFrame) -> DataFrame:
    r = F.col("body.report")
    record = or_else(r["id"], F.col("document_id"))
    return df.filter(r.isNotNull()).select(
        *_common(record, r["content_fingerprint"]), *(r[k].alias(k) for k in ("issuing_body", "issuing_body_normalized", "title")), F.struct(safe_date(r["reporting_period"]["from"]).alias("from"), safe_date(r["reporting_period"]["to"]).alias("to")).alias("reporting_period"),
        F.struct(safe_date(r["received_at"]["session_date"]).alias("session_date"), r["received_at"]["session_kind"].alias("session_kind"), r["received_at"]["received_in_document"].alias("received_in_document")).alias("received_at"),
        F.col("body.headings").alias("headings"), url("reports", r["slug"]).alias("url_path"),
    )


def persons(registry: DataFrame) -> DataFrame:
    """Registry rows with their dates made safe."""
    dated = F.transform("mandates", lambda m: m.withField("from", safe_date(m["from"])).withField("to", safe_date(m["to"])))
    return registry.filter("id is not null").withColumns({"mandates": dated, "birth_date": safe_date(F.col("birth_date")), "slug": F.col("id"), "url_path": F.concat(F.lit("/politicieni/"), F.col("id"))})


GRAINS = {"documents": documents, "agenda_items": agenda_items, "speeches": speeches, "votes": votes, "interpellations": interpellations, "questions": questions, "committee_meetings": committee_meetings, "reports": reports}


def project(df: DataFrame, grains: list[str] | None = None) -> dict[str, DataFrame]:
    """The grains by name; an unknown name is an error."""
    if unknown := set(grains or []) - set(GRAINS):
        raise ValueError(f"unknown grains: {sorted(unknown)}")
    return {name: GRAINS[name](df) for name in (grains or GRAINS)}


def child_ids(grains: dict[str, DataFrame]) -> DataFrame:
    """(document_id, grain, ids) of the child records."""
    rows = [df.select("document_id", F.lit(name).alias("grain"), "record_id") for name, df in grains.items() if name != "documents"]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out.groupBy("document_id", "grain").agg(F.array_sort(F.collect_list("record_id")).alias("ids"))
