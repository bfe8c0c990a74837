"""Queries that run the grains, the store of named queries, links and reports over documents nested from the driver's tables.

An order is a document, its lines are agenda items with a speech and a vote each; conversations are registers of questions, parts make committees.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions import agenda, citations, rules, sittings, text
from lectern.operators import aggregates, joins, windows
from lectern.plans import audit, backfills, coverage, eligibility, grains, lifecycle, linking, named, rankings, registry, reports
from lectern.queries import query, table



@cache
def schema() -> T.StructType:
    return T.StructType.fromDDL(grains.SIDECAR)


def shaped(kind: T.DataType, value) -> Column:
    """A column of a type from nested dicts, lists and columns; what is left out is null."""
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(value, dict):
        return F.struct(*(shaped(f.dataType, value.get(f.name)).alias(f.name) for f in kind.fields))
    if isinstance(value, list):
        return F.array(*(shaped(kind.elementType, v) for v in value)).cast(kind)
    return (value if isinstance(value, Column) else F.lit(value)).cast(kind)


def _type(path: str) -> T.DataType:
    kind: T.DataType = schema()
    for name in path.split("."):
        kind = kind[name].dataType
        kind = kind.elementType if isinstance(kind, T.ArrayType) else kind
    return kind


#: The columns of a line that its agenda item is made of.
LINE = ("l_linenumber", "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_returnflag", "l_linestatus")


def _item(x: Column, speech_texts: bool, votes: bool) -> dict:
    """The agenda item of a line."""
    at = x["l_linenumber"] * 100
    who = {"person_id": F.concat(F.lit("s"), x["l_suppkey"]), "raw": F.concat(F.lit("Domnul "), x["l_suppkey"]), "name": F.concat(F.lit("Supplier "), x["l_suppkey"]), "party_group": F.when(x["l_suppkey"] % 5 != 0, x["l_linestatus"])}
    document = F.concat(F.lit("mo://"), x["l_orderkey"])
    span = {"chars": [at, at + 90]}
    speech = {"id": F.concat(document, F.lit("#agenda-"), x["l_linenumber"], F.lit("#act-1")), "type": "speech", "text": F.repeat(F.lit("ab "), x["l_quantity"].cast("int") * 2), "speaker": who, "source_span": span, "references_mentioned": [{"type": "law", "raw": F.concat(F.lit("Legea "), x["l_suppkey"]), "number": x["l_suppkey"].cast("string"), "year": 2001, "char_offsets": [0, 9]}, {"type": "unknown", "raw": "art. 5", "char_offsets": [x["l_linenumber"] * 5, x["l_linenumber"] * 5 + 6]}]}
    if not speech_texts:
        speech = {k: v for k, v in speech.items() if k not in ("text", "references_mentioned")}
    vote = {"id": F.concat(document, F.lit("#agenda-"), x["l_linenumber"], F.lit("#vote-1")), "type": "vote", "outcome": F.when(x["l_returnflag"] == "R", "deferred").otherwise("approved"), "counts": {"for": F.when(x["l_tax"] == 0, "unanimous").otherwise(x["l_quantity"].cast("int").cast("string")), "against": x["l_linenumber"], "abstain": 0}, "source_span": {"chars": [at + 90, at + 99]}, "slug": F.concat(F.lit("vot-"), x["l_partkey"])}
    return {
        "id": F.concat(document, F.lit("#agenda-"), x["l_linenumber"]), "ordinal": x["l_linenumber"], "title": F.concat(F.lit("Proiect de lege "), x["l_partkey"]), "category": x["l_returnflag"], "outcome": x["l_linestatus"], "slug": F.concat(F.lit("punct-"), x["l_partkey"]),
        "topics": {"primary": [x["l_returnflag"]]}, "source_span": {"chars": [at, at + 99]}, "activities": [speech, vote] if votes else [speech],
        "primary_references": [{"type": "bill", "raw": F.concat(F.lit("L "), x["l_partkey"]), "prefix": F.when(x["l_returnflag"] == "A", "L"), "number": x["l_partkey"].cast("string"), "year": F.when(x["l_linenumber"] < 7, 2000 + x["l_linenumber"]), "char_offsets": [0, 5]}],
    }


def sidecars(spark, sf, speech_texts: bool = True, votes: bool = True) -> DataFrame:
    """Documents of orders, with their lines as agenda items; without texts, or without votes, where a query reads none. Lines are gathered as they are, and items made in place."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*LINE))).alias("_lines"))
    nested = lines.select("l_orderkey", F.transform("_lines", lambda x: shaped(_type("body.agenda_items"), _item(x, speech_texts, votes))).alias("items"))
    orders = table(spark, sf, "orders").join(nested, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    body = shaped(_type("body"), {"session": {"chambers_present": ["Camera", "Senat"]}}).withField("agenda_items", F.col("items"))
    fields = {
        "schema_version": "1", "document_id": F.concat(F.lit("mo://"), "o_orderkey"), "content_sha": F.sha2(F.col("o_orderkey").cast("string"), 256), "document_type": "plenary_stenogram",
        "metadata": {"issue": F.col("o_orderkey").cast("string"), "part": "II", "published": day, "chamber": F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), "session_date": F.when(F.col("o_orderkey") % 3 != 0, day), "year": F.year("o_orderdate")},
        "coverage": {"body_chars": 1000, "claimed_pct": 0.5},
    }
    return orders.select(*(shaped(f.dataType, fields.get(f.name)).alias(f.name) if f.name not in ("body", "extraction") else (body if f.name == "body" else F.struct(F.lit("regex").alias("extractor"), F.lit("now").alias("extracted_at"), F.create_map(F.lit("agenda"), F.col("o_orderstatus")).alias("extractor_versions"))).alias(f.name) for f in schema().fields))


def registers(spark, sf) -> DataFrame:
    """Question registers of conversations, and synthesis, report and interpellation documents of parts."""
    question = {"id": F.concat(F.lit("q-"), "conv_id", F.lit("-"), "turn"), "registration_number": F.col("turn").cast("string"), "registration_date": F.when(F.col("turn") % 2 == 0, "2019-02-03").otherwise("2019-02-30"), "question_text": F.col("text"), "topic": F.col("role"), "questioner": {"raw": F.col("role"), "person_id": F.col("role")}, "addressee": {"name": "Ministrul", "ministry": F.when(F.col("turn") % 3 == 0, "").otherwise("Sănătății")}, "source_span": {"chars": [F.col("turn") * 10]}}
    rows = table(spark, sf, "conversations").filter("conv_id is not null").select("conv_id", "turn", shaped(_type("body.questions"), question).alias("q"))
    nested = rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "q"))), lambda x: x["q"]).alias("questions"))
    return _documents(nested.withColumn("_body", shaped(_type("body"), {"chamber": "senat"}).withField("questions", F.col("questions"))), F.col("conv_id"), "question_register")


def _documents(rows: DataFrame, ident: Column, kind: str) -> DataFrame:
    fields = {"document_id": F.concat(F.lit(f"{kind}://"), ident), "content_sha": "sha", "document_type": kind, "metadata": {"chamber": "camera", "published": "2019-01-01", "year": 2019}}
    return rows.select(*((F.col("_body") if f.name == "body" else shaped(f.dataType, fields.get(f.name))).alias(f.name) for f in schema().fields))


def syntheses(spark, sf) -> DataFrame:
    """Committee syntheses: a document per brand, a committee per type, a meeting per part. Parts are gathered as they are, and meetings made in place."""
    meeting = lambda p: {"id": F.concat(F.lit("cmt-"), p["p_partkey"]), "dates": [F.when(p["p_size"] % 2 == 0, "2020-01-05").otherwise("2020-13-05")], "format": p["p_brand"], "purpose": p["p_name"], "agenda": [{"ordinal": 1, "title": p["p_name"], "vote_summary": {"outcome": "approved"}, "primary_references": [{"type": "law", "raw": "x", "number": p["p_size"].cast("string"), "year": 2000}]}], "roster": [{"speaker": {"name": p["p_type"], "person_id": "p"}, "mode": "physical"}], "source_span": {"chars": [p["p_size"]]}}
    per = table(spark, sf, "part").groupBy("p_brand", "p_type").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p_size", "p_name", "p_brand", "p_type"))).alias("parts"))
    nested = per.groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_type", "parts"))).alias("types"))
    committee = lambda t: shaped(_type("body.committees"), {"name": t["p_type"], "kind": "permanent"}).withField("meetings", F.transform(t["parts"], lambda p: shaped(_type("body.committees.meetings"), meeting(p))))
    return _documents(nested.withColumn("_body", shaped(_type("body"), {}).withField("committees", F.transform("types", committee))), F.col("p_brand"), "committee_synthesis")


def store(spark, sf) -> named.Store:
    docs = sidecars(spark, sf)
    return named.Store(grains.project(docs, ["documents", "agenda_items", "speeches", "votes"]))


ITEMS = """items AS (SELECT l.*, o.*, 'mo://' || l_orderkey AS document_id, 'mo://' || l_orderkey || '#agenda-' || l_linenumber AS item_id, CAST(l_quantity AS INTEGER) * 6 AS text_length,
  coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'Camera, Senat') AS chamber, strftime(o_orderdate, '%Y-%m-%d') AS day, year(o_orderdate) AS year, CASE WHEN l_suppkey % 5 <> 0 THEN l_linestatus END AS party
  FROM lineitem l JOIN orders o ON o_orderkey = l_orderkey)"""


# ---- grains

@query("""SELECT 'mo://' || o_orderkey AS record_id, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'Camera, Senat') AS chamber, strftime(o_orderdate, '%Y-%m-%d') AS session_date, count(l_linenumber) AS agenda_count, count(l_linenumber) AS speech_count, count(l_linenumber) AS vote_count,
  coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus || ' · ' END, '') || 'MO ' || o_orderkey || '/' || year(o_orderdate) || ' · ' || strftime(o_orderdate, '%Y-%m-%d') AS title, CAST(o_orderkey AS VARCHAR) AS slug, '/mo/' || o_orderkey AS url_path
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderstatus, o_orderdate""")
def p2_documents(spark, sf):
    rows = grains.documents(sidecars(spark, sf))
    return rows.select("record_id", "chamber", "session_date", *(F.col(c).cast("long").alias(c) for c in ("agenda_count", "speech_count", "vote_count")), "title", "slug", "url_path")


@query(f"""WITH {ITEMS} SELECT item_id AS record_id, document_id, l_linenumber AS ordinal, l_linenumber * 100 AS position_in_document, 'Proiect de lege ' || l_partkey AS title, l_returnflag AS category, l_returnflag AS topics,
  CASE WHEN l_linenumber < 7 THEN coalesce(CASE WHEN l_returnflag = 'A' THEN 'L' END, 'PL-x') || ':' || l_partkey || '/' || (2000 + l_linenumber) ELSE '' END AS bills, 's' || l_suppkey AS people, 1 AS total_votes, CASE WHEN l_returnflag = 'R' THEN 'deferred' ELSE 'approved' END AS outcomes, '/agenda/punct-' || l_partkey AS url_path, chamber, day AS session_date FROM items""")
def p3_agenda_items(spark, sf):
    rows = grains.agenda_items(sidecars(spark, sf, speech_texts=False))
    joined = lambda c, name: F.array_join(c, ",").alias(name)
    return rows.select("record_id", "document_id", "ordinal", "position_in_document", "title", "category", joined("topics_primary", "topics"), joined("refs.bills", "bills"), joined("speaker_person_ids", "people"), F.col("vote_summary.total_votes").alias("total_votes"), joined("vote_summary.outcomes", "outcomes"), "url_path", "chamber", "session_date")


@query(f"""WITH {ITEMS} SELECT item_id || '#act-1' AS record_id, l_linenumber AS agenda_ordinal, l_returnflag AS agenda_category, 's' || l_suppkey AS person_id, 'Supplier ' || l_suppkey AS name_search, party, text_length, text_length >= 100 AS is_substantive, 1 AS position_in_agenda, l_linenumber * 100 AS position_in_document, l_suppkey || '/2001' AS laws, chamber, day AS session_date FROM items""")
def p4_speeches(spark, sf):
    rows = grains.speeches(sidecars(spark, sf, votes=False))
    return rows.select("record_id", "agenda_ordinal", "agenda_category", "speaker.person_id", "speaker.name_search", F.col("speaker.party_group_at_time").alias("party"), "text_length", "is_substantive", "position_in_agenda", "position_in_document", F.array_join("refs.laws", ",").alias("laws"), "chamber", "session_date")


@query(f"""WITH {ITEMS} SELECT item_id || '#vote-1' AS record_id, CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS votes_for, l_tax = 0 AS unanimous, l_linenumber AS against, l_returnflag = 'R' AS deferred, '/vot/' || l_partkey AS url_path, 'Proiect de lege ' || l_partkey AS agenda_title FROM items""")
def p5_votes(spark, sf):
    rows = grains.votes(sidecars(spark, sf))
    return rows.select("record_id", F.col("counts.for").alias("votes_for"), F.col("counts.for_unanimous").alias("unanimous"), F.col("counts.against").alias("against"), "deferred", "url_path", "agenda_title")


@query("""SELECT 'q-' || conv_id || '-' || turn AS record_id, CAST(turn AS VARCHAR) AS regnum, CASE WHEN turn % 2 = 0 THEN '2019-02-03' END AS regdate, CASE WHEN turn % 3 = 0 THEN 'Ministrul' ELSE 'Sănătății' END AS addressee, role AS topic, sha256(coalesce(text, '')) AS text_sha256, CAST(turn * 10 AS INTEGER) AS position, 'senat' AS chamber FROM conversations WHERE conv_id IS NOT NULL""")
def p7_questions(spark, sf):
    rows = grains.questions(registers(spark, sf))
    return rows.select("record_id", "regnum", "regdate", F.col("addressee.raw").alias("addressee"), "topic", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), F.col("position_in_document").alias("position"), "chamber")


@query("""SELECT 'cmt-' || p_partkey AS record_id, p_type AS committee_name, regexp_replace(regexp_replace(lower(p_type), '[^\\p{L}\\p{N} -]', '', 'g'), '[ -]+', '-', 'g') AS committee_id, CASE WHEN p_size % 2 = 0 THEN '2020-01-05' END AS meeting_date, p_name AS purpose, 'law:' || p_size || '/2000' AS refs, p_type AS people FROM part""")
def p8_committee_meetings(spark, sf):
    rows = grains.committee_meetings(syntheses(spark, sf))
    return rows.select("record_id", "committee_name", "committee_id", "meeting_date", "purpose", F.array_join(F.flatten(F.transform("agenda_items", lambda a: a["primary_references"])), ",").alias("refs"), F.array_join(F.transform("roster", lambda r: r["name"]), ",").alias("people"))


@query("SELECT 'committee_synthesis://' || p_brand AS record_id, count(*) AS committee_count FROM part GROUP BY p_brand")
def p2_committee_counts(spark, sf):
    return grains.documents(syntheses(spark, sf)).select("record_id", F.col("committee_count").cast("long").alias("committee_count"))


def _reports(spark, sf) -> DataFrame:
    report = {"title": F.col("p_name"), "issuing_body": F.col("p_brand"), "slug": F.col("p_type"), "id": F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("r-"), "p_partkey")), "reporting_period": {"from": "2019-01-01", "to": "2019-02-31"}}
    return _documents(table(spark, sf, "part").withColumn("_body", shaped(_type("body"), {"report": report, "headings": [{"level": 1, "text": F.col("p_type")}]})), F.col("p_partkey"), "report_facsimile")


@query("SELECT CASE WHEN p_size % 2 = 0 THEN 'r-' || p_partkey ELSE 'report_facsimile://' || p_partkey END AS record_id, p_name AS title, p_brand AS issuing_body, '2019-01-01' AS period_from, CAST(NULL AS VARCHAR) AS period_to, '/raport/' || p_type AS url_path, p_type AS headings FROM part")
def p9_reports(spark, sf):
    rows = grains.reports(_reports(spark, sf))
    return rows.select("record_id", "title", "issuing_body", F.col("reporting_period.from").alias("period_from"), F.col("reporting_period.to").alias("period_to"), "url_path", F.array_join(F.transform("headings", lambda h: h["text"]), ",").alias("headings"))


@query("""SELECT 'i-' || event_id AS record_id, 'u' || user_id AS person_id, event_type AS topic, CASE WHEN value > 50 THEN 'r' || event_id END AS answer, CAST(event_id AS INTEGER) AS position, '/interpelare/i' || event_id AS url_path FROM events""")
def p6_interpellations(spark, sf):
    e = table(spark, sf, "events")
    record = {"id": F.concat(F.lit("i-"), "event_id"), "topic": F.col("event_type"), "questioner": {"person_id": F.concat(F.lit("u"), "user_id")}, "source_span": {"chars": [F.col("event_id")]}, "slug": F.concat(F.lit("i"), "event_id")}
    kind = _type("body.interpellations")
    one = shaped(kind, record).withField("response", F.when(F.col("value") > 50, shaped(kind["response"].dataType, {"text": F.concat(F.lit("r"), "event_id"), "speaker": {"raw": "x"}})))
    nested = e.groupBy("user_id").agg(F.collect_list(one).alias("l"))
    docs = _documents(nested.withColumn("_body", shaped(_type("body"), {}).withField("interpellations", F.col("l"))), F.col("user_id"), "plenary_stenogram")
    return grains.interpellations(docs).select("record_id", "questioner.person_id", "topic", F.col("response.text").alias("answer"), F.col("position_in_document").alias("position"), "url_path")


@query("SELECT 'c' || c_custkey AS id, c_name AS canonical_name, '/politicieni/c' || c_custkey AS url_path, CASE WHEN c_custkey % 2 = 0 THEN '1960-02-01' END AS birth_date FROM customer")
def p10_persons(spark, sf):
    rows = table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_name").alias("canonical_name"), F.when(F.col("c_custkey") % 2 == 0, "1960-02-01").otherwise("1960-02-31").alias("birth_date"), F.array(F.struct(F.lit("2000-01-01").alias("from"), F.lit(None).cast("string").alias("to"))).alias("mandates"))
    return grains.persons(rows).select("id", "canonical_name", "url_path", "birth_date")


@query(f"""WITH {ITEMS} SELECT document_id, grain, count(*) AS n FROM (SELECT document_id, unnest(['agenda_items', 'speeches', 'votes']) AS grain FROM items) GROUP BY ALL""")
def p25_child_ids(spark, sf):
    return grains.child_ids(grains.project(sidecars(spark, sf), ["agenda_items", "speeches", "votes"])).select("document_id", "grain", F.size("ids").cast("long").alias("n"))


# ---- named queries over the store

@query(f"WITH {ITEMS} SELECT coalesce(party, '(unknown)') AS party, CAST(year AS INTEGER) AS year, count(*) AS n, sum(count(*)) OVER (PARTITION BY coalesce(party, '(unknown)')) AS party_n FROM items WHERE text_length >= 100 GROUP BY 1, 2")
def n12_store(spark, sf):
    out = named.run(store(spark, sf), "agg_speeches_by_party_year").aggregations["party_year"]
    return out.select(F.col("outer").alias("party"), F.col("inner").alias("year"), F.col("count").alias("n"), F.col("outer_count").alias("party_n"))


@query(f"WITH {ITEMS}, u AS (SELECT item_id AS record_id, l_linenumber * 100 AS position FROM items WHERE l_orderkey = 1 UNION ALL SELECT item_id || '#act-1', l_linenumber * 100 FROM items WHERE l_orderkey = 1 UNION ALL SELECT item_id || '#vote-1', l_linenumber * 100 + 90 FROM items WHERE l_orderkey = 1) SELECT record_id, position FROM u ORDER BY position, record_id LIMIT 10")
def n3_store(spark, sf):
    return named.run(store(spark, sf), "list_document_children", {"document_id": "mo://1", "page_size": 10}).hits.select("record_id", "position")


@query("SELECT 'mo://' || o_orderkey AS record_id, strftime(o_orderdate, '%Y-%m-%d') AS session_date, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'Camera, Senat') AS chamber FROM orders WHERE o_orderkey = 7")
def n4_store(spark, sf):
    return named.run(store(spark, sf), "get_document", {"document_id": "mo://7"}).select("record_id", "session_date", "chamber")


@query("WITH d AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, 'mo://' || o_orderkey AS record_id, o_orderstatus FROM orders) SELECT record_id FROM d WHERE day = '1996-05-03' AND o_orderstatus = 'F' ORDER BY record_id LIMIT 20")
def n5_store(spark, sf):
    return named.run(store(spark, sf), "list_documents_by_date", {"date": "1996-05-03", "chamber": "F"}).hits.select("record_id")


@query(f"WITH {ITEMS} SELECT item_id AS record_id, 'Proiect de lege ' || l_partkey AS title FROM items WHERE item_id = 'mo://7#agenda-1'")
def n6_agenda_item(spark, sf):
    return named.run(store(spark, sf), "get_agenda_item", {"record_id": "mo://7#agenda-1"}).select("record_id", "title")


@query(f"WITH {ITEMS} SELECT item_id || '#act-1' AS record_id, text_length FROM items WHERE item_id = 'mo://7#agenda-1'")
def n7_speech(spark, sf):
    return named.run(store(spark, sf), "get_speech", {"record_id": "mo://7#agenda-1#act-1"}).select("record_id", "text_length")


@query(f"""WITH {ITEMS}, s AS (SELECT * FROM items WHERE l_suppkey = 7 AND text_length >= 100),
f AS (SELECT 'chamber' AS facet, chamber AS key, count(*) AS count FROM s GROUP BY 2 UNION ALL SELECT 'year', CAST(year AS VARCHAR), count(*) FROM s GROUP BY 2 UNION ALL SELECT 'party', coalesce(party, '(unknown)'), count(*) FROM s GROUP BY 2)
SELECT * FROM f UNION ALL SELECT 'hits', record_id, 1 FROM (SELECT item_id || '#act-1' AS record_id FROM s ORDER BY day DESC, 1 LIMIT 20)""")
def n8_person_page(spark, sf):
    page = named.run(store(spark, sf), "person_page", {"person_slug": "s7"})
    parts = [page.aggregations[k].select(F.lit(k).alias("facet"), F.col("key").cast("string").alias("key"), "count") for k in ("chamber", "year", "party")]
    hits = page.hits.select(F.lit("hits").alias("facet"), F.col("record_id").alias("key"), F.lit(1).cast("long").alias("count"))
    return parts[0].union(parts[1]).union(parts[2]).union(hits)


@query("""SELECT 'cmt-' || p_partkey AS record_id, CASE WHEN p_size % 2 = 0 THEN '2020-01-05' END AS meeting_date FROM part WHERE p_type = (SELECT min(p_type) FROM part) ORDER BY meeting_date DESC NULLS LAST, record_id LIMIT 20""")
def n10_committee_meetings(spark, sf):
    rows = grains.committee_meetings(syntheses(spark, sf))
    first = table(spark, sf, "part").agg(F.min(text.committee_slug(F.trim("p_type")))).first()[0]
    return named.run(named.Store({"committee_meetings": rows}), "list_committee_meetings", {"committee_id": first}).hits.select("record_id", "meeting_date")


@query("SELECT 'r-' || p_partkey AS record_id, p_name AS title FROM part WHERE p_size % 2 = 0 AND p_partkey = (SELECT min(p_partkey) FROM part WHERE p_size % 2 = 0)")
def n11_report(spark, sf):
    rows = grains.reports(_reports(spark, sf))
    first = table(spark, sf, "part").filter("p_size % 2 = 0").agg(F.min("p_partkey")).first()[0]
    return named.run(named.Store({"reports": rows}), "get_report", {"record_id": f"r-{first}"}).select("record_id", "title")


@query(f"WITH {ITEMS} SELECT item_id || '#act-1' AS record_id FROM items WHERE text_length >= 100 AND chamber = 'F' AND day BETWEEN '1995-01-01' AND '1995-06-30' AND 's' || l_suppkey = 's7' ORDER BY day DESC, 1 LIMIT 20")
def n1_search_filters(spark, sf):
    """Without words, hits come newest first."""
    return named.run(store(spark, sf), "search_speeches", {"speaker_person_id": "s7", "chamber": "F", "date_from": "1995-01-01", "date_to": "1995-06-30"}).hits.select("record_id")


# ---- links

def _entries(spark, sf) -> DataFrame:
    return linking.vote_entries(sidecars(spark, sf))


LINKS = f"""{ITEMS}, v AS (SELECT document_id, l_linenumber - 1 AS seq, l_linenumber, day, CAST(day AS DATE) AS d, l_returnflag = 'R' AS deferred, 'bill:' || coalesce(CASE WHEN l_returnflag = 'A' THEN 'L' END, '?') || ':' || l_partkey || '/' || (2000 + l_linenumber) AS match_key FROM items WHERE l_linenumber < 7),
n AS (SELECT a.*, (SELECT min(struct_pack(d := b.d, doc := b.document_id, seq := b.seq)) FROM v b WHERE b.match_key = a.match_key AND b.d > a.d AND b.d <= a.d + 60) AS nx FROM v a WHERE a.deferred)"""


@query(f"WITH {LINKS} SELECT document_id, match_key, count(*) AS n FROM v GROUP BY ALL")
def j4_match_keys(spark, sf):
    return _entries(spark, sf).groupBy("document_id", "match_key").agg(F.count("*").alias("n"))


@query(f"WITH {LINKS} SELECT document_id, nx.doc AS defers_to FROM n WHERE nx IS NOT NULL")
def j5_forward_links(spark, sf):
    forward, _ = linking.vote_links(_entries(spark, sf))
    return forward.select("document_id", "defers_to")


@query(f"WITH {LINKS} SELECT document_id, CAST(count(*) AS INTEGER) AS pairs_written FROM n WHERE nx IS NOT NULL GROUP BY 1")
def b9_link_votes(spark, sf):
    """The documents that linking changes, after write-back."""
    return linking.link_votes(sidecars(spark, sf)).filter("pairs_written > 0").select("document_id", "pairs_written")


@query(f"WITH {ITEMS} SELECT document_id, CAST(count(*) FILTER (l_linenumber >= 2) AS INTEGER) AS resolved, CAST(count(*) FILTER (l_linenumber = 1) AS INTEGER) AS unresolved FROM items GROUP BY 1 HAVING count(*) FILTER (l_linenumber >= 2) > 0")
def b10_link_references(spark, sf):
    """Bare articles of speeches resolved to the law cited before them."""
    return linking.link_references(sidecars(spark, sf)).select("document_id", "resolved", "unresolved")


@query("""WITH r AS (SELECT doc_id, [n_chars % 7, n_chars % 11, n_chars % 13] AS ends, n_chars % 12 AS p FROM documents), e AS (SELECT doc_id, list_filter(ends, lambda x: x <= p) AS l FROM r)
SELECT doc_id, CASE WHEN len(l) > 0 THEN list_max(l) END AS anchor_end FROM e""")
def j6_nearest_anchor(spark, sf):
    """Each document's bare article takes the act that ends last before it."""
    d = table(spark, sf, "documents")
    kind = T.StructType.fromDDL(f"r {grains.REFS}")["r"].dataType.elementType
    acts = [shaped(kind, {"type": t, "char_offsets": [0, (F.col("n_chars") % n).cast("int")]}) for t, n in (("law", 7), ("code", 11), ("bill", 13))]
    bare = shaped(kind, {"type": "unknown", "raw": "art. 3", "char_offsets": [(F.col("n_chars") % 12).cast("int"), F.lit(99)]})
    refs = linking.anchored(F.array(*acts, bare))
    return d.select("doc_id", F.element_at(refs, -1)["resolved_to"]["char_offsets"][1].cast("long").alias("anchor_end"))


@query("""SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey % 2 = 0 WHEN s_suppkey % 3 = 1 THEN true ELSE s_suppkey >= 50 END AS active FROM supplier""")
def j12_mandate_overlap(spark, sf):
    s = table(spark, sf, "supplier")
    none = F.array().cast("array<struct<`from`:int,`to`:int>>")
    k = F.col("s_suppkey")
    dated = F.array(F.struct(F.lit(1990).alias("from"), F.when(k % 2 == 0, 2010).otherwise(1999).alias("to")))
    open_ = F.array(F.struct(F.when(k >= 50, 2001).otherwise(2009).alias("from"), F.lit(None).cast("int").alias("to")))
    return s.select(k.alias("k"), joins.active_mandate(F.when(k % 3 == 0, dated).when(k % 3 == 1, none).otherwise(open_), F.lit(2005)).alias("active"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'c' || c_custkey WHEN c_custkey % 4 = 1 THEN 'c' || c_custkey END AS match, CASE c_custkey % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'case' END AS via FROM customer""")
def j11_persons(spark, sf):
    """Customers looked up as they are written, in capitals behind titles, and under names that nobody has."""
    c = table(spark, sf, "customer").withColumn("name", F.concat(F.lit("Om "), F.translate(F.col("c_custkey").cast("string"), "0123456789", "abcdefghij"), F.lit(" Popescu")))
    people = c.select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("name").alias("canonical_name"), F.array().cast("array<string>").alias("aliases"), F.array().cast("array<struct<`from`:int,`to`:int>>").alias("mandates"))
    k = F.col("c_custkey") % 4
    raw = F.when(k == 0, F.concat(F.lit("Domnul deputat "), "name", F.lit(", PSD"))).when(k == 1, F.concat(F.lit("Doamna "), F.upper("name"))).when(k == 2, F.lit("Din sală")).otherwise(F.concat(F.lit("Nimeni Altul "), F.col("c_custkey")))
    return backfills.persons(c.select("c_custkey", raw.alias("raw"), F.lit(2001).alias("year")), people).select("c_custkey", "match", "via")


# ---- reports, filters and text rules over the tables

@query("""SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE length(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))) >= 100 AND len(list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda w: w <> '')) <= 800 AND source <> 'src3'""")
def f8_codable(spark, sf):
    """Long enough speeches of speakers that are coded; one source stands for the chair's narration."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    rows = d.select(F.col("doc_id").cast("string").alias("record_id"), "doc_id", "text", F.when(F.col("source") == "src3", "<chair narration>").otherwise(F.col("source")).alias("speaker_name"), F.lit(None).cast("string").alias("speaker_raw"))
    return eligibility.codable(rows)[0].select("doc_id")


@query("SELECT doc_id FROM documents WHERE source <> 'src4' AND len(list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda w: w <> '')) BETWEEN 50 AND 200")
def f10_pool(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("doc_id").cast("string").alias("record_id"), "text", F.when(F.col("source") == "src4", "Voci din sală").otherwise(F.col("source")).alias("speaker_name"), F.lit(None).cast("string").alias("speaker_raw"))
    return eligibility.pool(d, 50, 200).select("doc_id")


@query("SELECT doc_id, CASE WHEN length(text) >= 100 THEN sha256(substr(text, 1, 8000)) END AS embedded FROM documents")
def f9_embeddable(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2(eligibility.embeddable(F.col("text")), 256).alias("embedded"))


@query("""SELECT year(o_orderdate) AS year, count(*) AS n, count(*) FILTER (o_custkey % 4 = 0) AS h0, count(*) FILTER (o_custkey % 4 = 1) AS h1, count(*) FILTER (o_custkey % 4 = 2) AS h2, count(*) FILTER (o_custkey % 4 = 3) AS h_err, round(avg(o_custkey % 5), 6) AS dqi_mean, round(100.0 * sum(o_custkey % 3) / sum(3), 6) AS missed_pct FROM orders GROUP BY 1""")
def a12_year_drift(spark, sf):
    k = F.col("o_custkey")
    rows = table(spark, sf, "orders").select(F.year("o_orderdate").cast("long").alias("year"), F.when(k % 4 < 3, k % 4).alias("hawkins"), (k % 5).alias("dqi_level"), (k % 3).alias("missed"), F.lit(3).alias("markers"))
    return coverage.year_drift(rows).withColumns({"dqi_mean": F.round("dqi_mean", 6), "missed_pct": F.round("missed_pct", 6)})


@query(f"""WITH {ITEMS} SELECT 'agenda_items' AS name, count(*) AS value FROM items UNION ALL SELECT 'votes', count(*) FROM items UNION ALL SELECT 'unknown_references', count(*) FROM items UNION ALL SELECT 'unknown_resolved', 0
UNION ALL SELECT 'reference:bill', count(*) FROM items UNION ALL SELECT 'reference:law', count(*) FROM items UNION ALL SELECT 'reference:unknown', count(*) FROM items UNION ALL SELECT 'category:' || l_returnflag, count(*) FROM items GROUP BY 1 UNION ALL SELECT 'outcome:' || l_linestatus, count(*) FROM items GROUP BY 1
UNION ALL SELECT 'type:plenary_stenogram', count(*) FROM orders UNION ALL SELECT 'schema:1', count(*) FROM orders""")
def a18_smoke(spark, sf):
    return reports.smoke(sidecars(spark, sf)).filter("value > 0 or name = 'unknown_resolved'")


@query(f"""WITH {ITEMS}, d AS (SELECT document_id, count(*) AS speeches, min(o_orderkey) % 5 AS headers FROM items GROUP BY 1) SELECT document_id, CAST(headers AS INTEGER) AS headers, CAST(speeches AS INTEGER) AS speeches, CASE WHEN headers > 0 THEN round(speeches / headers, 6) END AS capture FROM d
UNION ALL SELECT 'mo://' || o_orderkey, CAST(o_orderkey % 5 AS INTEGER), 0, CASE WHEN o_orderkey % 5 > 0 THEN 0.0 END FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def a21_speech_coverage(spark, sf):
    bodies = table(spark, sf, "orders").select(F.concat(F.lit("mo://"), "o_orderkey").alias("document_id"), F.expr("repeat('## **Ion**\n text\n', cast(o_orderkey % 5 as int))").alias("body_text"))
    rows, _ = reports.speech_coverage(sidecars(spark, sf), bodies)
    return rows.select("document_id", "headers", "speeches", F.round("capture", 6).alias("capture"))


@query("""WITH m AS (SELECT user_id AS model, avg(CAST(value > 50 AS INT)) AS h, avg(CAST(value > 20 AS INT)) AS d, sum(value) / count(*) AS c FROM events GROUP BY 1) SELECT model, row_number() OVER (ORDER BY h DESC, d DESC, c, model) AS place FROM m""")
def a9_benchmark(spark, sf):
    """Costs are summed exactly, so that equal ones tie whatever the order of the rows."""
    v = F.col("value")
    sums = aggregates.exact_sums(table(spark, sf, "events"), F.col("user_id"), v, "model", known=v.isNotNull(), h=v > 50, d=v > 20)
    rate = lambda c: F.col(c) / F.nullif("known", F.lit(0))
    rows = sums.select("model", rate("h").alias("h_rate"), rate("d").alias("d_rate"), F.col("total").alias("cost_usd"), F.col("n").alias("n_total"))
    from pyspark.sql import Window

    ordered = reports.benchmark(rows)
    order = [F.desc("h_rate"), F.desc("d_rate"), F.asc("cost_per_speech"), F.asc_nulls_last("model")]
    return ordered.select("model", F.row_number().over(Window.orderBy(*order)).cast("long").alias("place"))


@query("""WITH p AS (SELECT o_orderpriority AS tier, o_custkey % 3 AS g, CASE WHEN o_orderkey % 7 > 0 THEN o_orderkey % 3 END AS c FROM orders), x AS (SELECT tier, g, c FROM p UNION ALL SELECT NULL, g, c FROM p)
SELECT tier, count(*) FILTER (c IS NOT NULL AND g = c) AS matches, count(*) AS total, CAST(sum(abs(g - c)) AS BIGINT) AS abs_delta, count(*) FILTER (c IS NULL) AS null_pairs FROM x GROUP BY tier""")
def a10_agreement_by_tier(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("tier"), (F.col("o_custkey") % 3).alias("g"), F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderkey") % 3).alias("c"))
    return reports.agreement_by_tier(rows, "g", "c").select("tier", "matches", "total", "abs_delta", "null_pairs")


@query("""SELECT 'totals' AS part, '' AS key, count(*) AS count FROM events UNION ALL SELECT 'errors', ['hawkins', 'voice', 'dqi', 'vparty'][1 + event_id % 4] || ':' || event_type, count(*) FROM events WHERE value < 10 GROUP BY 2
UNION ALL SELECT 'levels', CAST(user_id % 3 AS VARCHAR), count(*) FROM events WHERE event_id % 4 = 2 GROUP BY 2""")
def a11_model_summary(spark, sf):
    e = table(spark, sf, "events")
    kind = F.element_at(F.array(*map(F.lit, reports.PROMPTS)), (F.col("event_id") % 4 + 1).cast("int"))
    zero = {c: F.lit(0).alias(c) for c in ("tokens_in", "fresh", "cache_creation", "cache_read", "tokens_out", "cost_usd", "latency_ms", "retries_used", "fragments_missed", "score")}
    calls = e.select(kind.alias("kind"), *zero.values(), F.lit(False).alias("parse_repaired"), F.when(F.col("value") < 10, F.col("event_type")).alias("error"), (F.col("user_id") % 3).alias("level"), F.lit(None).cast("string").alias("constructive"), F.array().cast("array<string>").alias("marker_kinds"), F.array().cast("array<string>").alias("voices"))
    s = reports.model_summary(calls)
    parts = [s["totals"].select(F.lit("totals").alias("part"), F.lit("").alias("key"), F.col("calls").alias("count")), s["errors"].select(F.lit("errors"), F.concat_ws(":", "kind", "error"), "count"), s["levels"].select(F.lit("levels"), F.col("level").cast("string"), "count")]
    return parts[0].union(parts[1]).union(parts[2])


@query(f"""WITH {ITEMS} SELECT 'P1' AS probe, 0.0 AS value, true AS passed UNION ALL SELECT 'P2', 0.0, true UNION ALL SELECT 'P3', 0.0, false UNION ALL SELECT 'P4', 0.0, true UNION ALL SELECT 'P5', 0.0, false UNION ALL SELECT 'P6', 0.0, true""")
def a26_probes(spark, sf):
    return reports.probes(sidecars(spark, sf)).withColumn("value", F.col("value").cast("decimal(2,1)"))


@query("SELECT o_orderkey, CASE WHEN count(l_linenumber) = 0 THEN 1.0 ELSE round(avg(l_discount), 6) END AS confidence FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def a24_confidence(spark, sf):
    scores = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list("l_discount").alias("s"))
    return table(spark, sf, "orders").select("o_orderkey").join(scores, "o_orderkey", "left").select("o_orderkey", F.round(reports.confidence_mean(F.col("s")), 6).alias("confidence"))


@query("""WITH c AS (SELECT CASE WHEN contains(text, 'trash') THEN 'toxic' WHEN contains(text, 'token') THEN 'secret' ELSE 'other' END AS top_type, n_chars % 9 = 0 AS ambiguous FROM documents) SELECT top_type, count(*) AS count, count(*) FILTER (ambiguous) AS ambiguous FROM c GROUP BY 1""")
def a25_classes(spark, sf):
    d = table(spark, sf, "documents")
    t = F.when(F.contains("text", F.lit("trash")), "toxic").when(F.contains("text", F.lit("token")), "secret").otherwise("other")
    return reports.classes(d.select(t.alias("top_type"), (F.col("n_chars") % 9 == 0).alias("ambiguous")))


@query("""WITH t AS (SELECT doc_id, 'Legea nr. ' || (n_chars % 500) || '/' || (1890 + n_chars % 130) || ' și OUG ' || doc_id || '/2010, art. ' || (n_chars % 9) AS t, n_chars FROM documents)
SELECT doc_id, CASE WHEN 1890 + n_chars % 130 >= 1900 THEN 'law:' || (n_chars % 500) || '/' || (1890 + n_chars % 130) ELSE 'unknown' END || ' oug:' || doc_id || '/2010 unknown' AS refs FROM t""")
def x6_citations(spark, sf):
    d = table(spark, sf, "documents")
    t = F.concat(F.lit("Legea nr. "), F.col("n_chars") % 500, F.lit("/"), F.lit(1890) + F.col("n_chars") % 130, F.lit(" și OUG "), F.col("doc_id"), F.lit("/2010, art. "), F.col("n_chars") % 9)
    one = lambda r: F.when(r["type"] == "unknown", "unknown").otherwise(F.concat(r["type"], F.lit(":"), r["number"], F.lit("/"), r["year"].cast("string")))
    return d.select("doc_id", F.array_join(F.transform(citations.mentions(t), one), " ").alias("refs"))


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN 'Legea apelor' END AS subject FROM orders""")
def x8_subjects(spark, sf):
    t = F.concat(F.lit("L "), F.col("o_custkey"), F.lit("/2011"), F.when(F.col("o_custkey") % 5 == 0, " privind Legea apelor, în procedură").otherwise(" și altele"))
    return table(spark, sf, "orders").select("o_orderkey", citations.citations(t)[0]["subject"].alias("subject"))


@query("""WITH n AS (SELECT o_orderkey, o_custkey % 200 AS f, o_orderkey % 100 AS a FROM orders) SELECT o_orderkey, CAST(f AS INTEGER) AS votes_for, CAST(a AS INTEGER) AS votes_against, CASE WHEN f > a THEN 'approved' WHEN f < a THEN 'rejected' ELSE 'tied' END AS outcome FROM n""")
def x10_votes(spark, sf):
    from lectern.functions import extract

    t = F.concat(F.lit("Supun votului proiectul. "), F.col("o_custkey") % 200, F.lit(" voturi pentru, "), F.col("o_orderkey") % 100, F.lit(" voturi contra.\n"))
    rows = table(spark, sf, "orders").select("o_orderkey", t.alias("t")).select("o_orderkey", extract.votes(F.col("t"))[0].alias("v"))
    return rows.select("o_orderkey", F.col("v.for").alias("votes_for"), F.col("v.against").alias("votes_against"), F.col("v.outcome").alias("outcome"))


@query("""SELECT doc_id, n_chars % 3 = 0 AS joint, CASE WHEN n_chars % 4 = 0 THEN 'suspended_no_quorum' WHEN n_chars % 4 = 1 THEN 'completed' END AS outcome, CAST(n_chars % 100 AS INTEGER) AS registered, n_chars % 100 >= 50 AS quorum FROM documents""")
def x19_sittings(spark, sf):
    k = F.col("n_chars")
    t = F.concat(F.lit("Din totalul de 100 de senatori, și-au înregistrat prezența "), k % 100, F.lit(".\n"), F.when(k % 3 == 0, "ȘEDINȚE COMUNE ALE CAMEREI DEPUTAȚILOR ȘI SENATULUI\n").otherwise(""), F.when(k % 4 == 0, "Suspend ședința pentru lipsa cvorumului").when(k % 4 == 1, "Declar închisă ședința").otherwise(""))
    seen = sittings.attendance(F.col("t"))
    return table(spark, sf, "documents").select("doc_id", t.alias("t")).select("doc_id", (F.size(sittings.chambers_present(F.col("t"))) > 0).alias("joint"), sittings.ending(F.col("t")).alias("outcome"), seen["registered"].alias("registered"), seen["quorum_met"].alias("quorum"))


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'respins' WHEN p_size % 4 = 1 THEN 'retras' WHEN p_size % 4 = 2 THEN 'adoptat' END AS outcome FROM part""")
def x5_outcomes(spark, sf):
    k = F.col("p_size") % 4
    body = F.concat("p_name", F.when(k == 0, " a fost respinsă, deși a fost adoptată").when(k == 1, " a fost retras").when(k == 2, " a fost aprobat").otherwise(""))
    return table(spark, sf, "part").select("p_partkey", agenda.outcome(body, F.col("p_name")).alias("outcome"))


@query("""SELECT doc_id, CASE WHEN n_chars % 2 = 0 THEN 'plenary_stenogram' ELSE 'other' END AS top_type FROM documents""")
def x1_classes(spark, sf):
    """Marks beyond the first 10,000 bytes don't count."""
    t = F.when(F.col("n_chars") % 2 == 0, F.concat(F.lit("DEZBATERI PARLAMENTARE\n"), F.coalesce("text", F.lit("")))).otherwise(F.concat(F.lit("ă" * 5001), F.lit("DEZBATERI PARLAMENTARE")))
    return table(spark, sf, "documents").select("doc_id", t.alias("t")).select("doc_id", rules.classified(F.col("t"), F.lit(""))["top_type"].alias("top_type"))


@query("""SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'Educație' WHEN 1 THEN 'Apărare,Buget-finanțe' ELSE '' END AS topics, CASE p_size % 3 WHEN 1 THEN 'deadline_extension' ELSE 'other' END AS category FROM part""")
def x3_topics(spark, sf):
    k = F.col("p_size") % 3
    title = F.when(k == 0, "Despre învățământul primar").when(k == 1, "Prelungirea termenului pentru armată și bugetul ei").otherwise("Altceva")
    return table(spark, sf, "part").select("p_partkey", F.array_join(rules.topics(title), ",").alias("topics"), rules.agenda_category(title)["category"].alias("category"))


@query("""WITH x AS (SELECT p_partkey, lower(p_name) AS n FROM part) SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(n, '[\\s-]+'), lambda w: length(w) >= 2))), ' ') AS name_key FROM x""")
def t4_person_tokens(spark, sf):
    return table(spark, sf, "part").select("p_partkey", registry.name_key(F.col("p_name")).alias("name_key"))


@query("""SELECT c_custkey, 'c' || c_custkey AS peeled FROM customer""")
def t5_peel(spark, sf):
    k = F.col("c_custkey") % 4
    name = F.concat(F.lit("c"), "c_custkey")
    raw = F.when(k == 0, F.concat(F.lit("Domnul deputat "), name, F.lit(", PNL"))).when(k == 1, F.concat(F.lit("  doamna  Senatoare "), name, F.lit(":"))).when(k == 2, F.concat(F.lit("Dl. viceprim-ministru "), name, F.lit("."))).otherwise(name)
    return table(spark, sf, "customer").select("c_custkey", text.peel(raw).alias("peeled"))


@query("""WITH e AS (SELECT doc_id, unnest([struct_pack(s := n_chars % 50, e := n_chars % 50 + 10), struct_pack(s := n_chars % 20, e := n_chars % 20 + 15), struct_pack(s := 30, e := 40)]) AS x FROM documents),
o AS (SELECT doc_id, x.s AS s, x.e AS e, row_number() OVER (PARTITION BY doc_id ORDER BY x.s, x.e DESC) AS r FROM e),
k AS (SELECT a.doc_id, a.s AS s1, a.e AS e1, b.s AS s2, b.e AS e2, c.s AS s3, c.e AS e3 FROM o a JOIN o b USING (doc_id) JOIN o c USING (doc_id) WHERE a.r = 1 AND b.r = 2 AND c.r = 3)
SELECT doc_id, CAST(1 + CASE WHEN s2 >= e1 THEN 1 ELSE 0 END + CASE WHEN s3 >= (CASE WHEN s2 >= e1 THEN e2 ELSE e1 END) THEN 1 ELSE 0 END AS INTEGER) AS kept FROM k""")
def w6_greedy_spans(spark, sf):
    k = F.col("n_chars")
    span = lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"))
    spans = F.array(span(k % 50, k % 50 + 10), span(k % 20, k % 20 + 15), span(F.lit(30), F.lit(40)))
    return table(spark, sf, "documents").select("doc_id", F.size(windows.greedy_spans(spans)).alias("kept"))


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN '1,2,3' WHEN o_custkey % 3 = 1 THEN '1,2,1,2' ELSE '' END AS kept FROM orders""")
def w9_consecutive(spark, sf):
    k = F.col("o_custkey") % 3
    given = lambda *n: F.array(*map(F.lit, n))
    ordinals = F.when(k == 0, given(1, 2, 5, 3)).when(k == 1, given(1, 2, 1, 3, 2)).otherwise(given(2, 3))
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(windows.consecutive(ordinals), ",").alias("kept"))


BOOTSTRAP = 1000


@query(f"""WITH r AS (SELECT source, doc_id, toxic, n_chars FROM documents JOIN labels USING (doc_id)),
x AS (SELECT r.*, b, CAST('0x' || substr(md5('1:' || b || ':' || doc_id), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM r, range(1, {BOOTSTRAP + 1}) t(b)),
t AS (SELECT *, {' + '.join(f'(u >= {c!r})::INT' for c in windows.POISSON)} AS n FROM x),
g AS (SELECT b, source, CAST(sum(toxic * n) AS DOUBLE) / nullif(sum(n_chars * n), 0) AS rate FROM t GROUP BY ALL),
k AS (SELECT b, source, rank() OVER (PARTITION BY b ORDER BY rate DESC NULLS LAST) AS rank FROM g)
SELECT source, quantile_cont(rank, 0.025) AS low, quantile_cont(rank, 0.975) AS high FROM k GROUP BY source""")
def w16_bootstrap_ranks(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select("source", "doc_id", "toxic", "n_chars")
    return windows.bootstrap_ranks(rows, "source", "toxic", "n_chars", "doc_id", BOOTSTRAP)


@query("""WITH d AS (SELECT doc_id, chr(97 + CAST(n_chars % 6 AS INTEGER)) AS k FROM documents), n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS r FROM d) SELECT doc_id, CASE WHEN r > 1 THEN k || '-' || r ELSE k END AS unique_key FROM n""")
def w3_suffixed(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.chr((F.lit(97) + F.col("n_chars") % 6)).alias("k"))
    return windows.suffixed(rows, "k", F.col("doc_id")).select("doc_id", "unique_key")


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY md5('s:' || o_orderkey), o_orderkey) AS r FROM orders WHERE o_custkey % 10 < 2) WHERE r <= 2""")
def w15_per_tier(spark, sf):
    tiers = table(spark, sf, "customer").filter("c_custkey % 10 < 2").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_custkey") % 10).cast("string").alias("tier"))
    return windows.per_tier(table(spark, sf, "orders"), tiers, "o_custkey", "o_orderkey", 2).select("o_custkey", "o_orderkey")


# ---- rankings

CODED = """c AS (SELECT o_orderkey AS id, o_custkey % 40 AS person, o_orderstatus AS party, CAST(o_orderdate AS DATE) AS day, 500 AS words, CAST(o_orderkey % 3 AS INTEGER) AS h, o_orderkey % 2 = 0 AS fear, o_orderkey % 5 AS econ FROM orders)"""


def _codings(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    mark = lambda framework, kind, when: F.when(when, F.array(F.struct(F.lit(framework).alias("framework"), F.lit(kind).alias("kind"), (k % 3 == 0).alias("complete")))).otherwise(F.array().cast("array<struct<framework:string,kind:string,complete:boolean>>"))
    dqi = F.struct((k % 4).cast("int").alias("level_of_justification"), F.lit("mixed").alias("content_of_justification"), *((k % 3).cast("int").alias(r) for r in rankings.RESPECT), F.lit("positional").alias("constructive_politics"))
    marks = F.concat(mark("fear", "invasion", k % 2 == 0), mark("fallacy", "strawman", k % 3 == 0), mark("securitization", "nation", F.lit(True)), mark("audience", "heckling", k % 7 == 0), mark("vparty", "media_hostility", k % 4 == 0))
    return o.select(k.cast("string").alias("record_id"), (F.col("o_custkey") % 40).alias("person_id"), F.col("o_orderstatus").alias("party"), F.lit("c").alias("cycle"), F.to_date("o_orderdate").alias("session_date"), F.when(k % 2 == 0, "floor").otherwise("committee").alias("context"), F.lit(500).alias("words"), (k % 3).cast("int").alias("hawkins"), F.lit(0.9).alias("confidence"), F.lit("first_person").alias("voice"), dqi.alias("dqi"), marks.alias("markers"), (k % 5 - 2).cast("double").alias("econ"), (k % 7 - 3).cast("double").alias("cultural"), F.lit(1.0).alias("party_econ"), F.lit(-1.0).alias("party_cultural"))


def _ranking_sql(measure: str) -> str:
    return f"""WITH {CODED}, s AS (SELECT person AS person_id, count(*) AS speeches, sum({measure}) AS total, 1000.0 * sum({measure}) / sum(words) AS rate FROM c GROUP BY 1 HAVING count(*) >= 10 AND sum(words) >= 5000) SELECT person_id, speeches, CAST(total AS DOUBLE) AS total, CAST(rank() OVER (ORDER BY rate DESC) AS INTEGER) AS rank_rate FROM s"""


def _ranked(spark, sf, name: str) -> DataFrame:
    return rankings.RANKINGS[name](_codings(spark, sf)).select("person_id", "speeches", "total", "rank_rate")


@query(_ranking_sql("(id % 4 = 0)::INT"))
def r2_anti_pluralist(spark, sf):
    return _ranked(spark, sf, "most_anti_pluralist_politicians@v1")


@query(_ranking_sql("(id % 2 = 0)::INT"))
def r3_fearmongering(spark, sf):
    return _ranked(spark, sf, "most_fearmongering@v1")


@query(_ranking_sql("(id % 3 = 0)::INT"))
def r4_fallacy_density(spark, sf):
    return _ranked(spark, sf, "rhetorical_fallacy_density@v1")


@query(_ranking_sql("(id % 3 = 0)::INT"))
def r5_securitizing(spark, sf):
    return _ranked(spark, sf, "most_securitizing@v1")


@query(_ranking_sql("(id % 7 = 0)::INT"))
def r13_disruption(spark, sf):
    return _ranked(spark, sf, "audience_disruption_index@v1")


@query(f"""WITH {CODED} SELECT person AS person_id, count(*) AS speeches, round(avg(((id % 4) / 3.0 + 0.5 + 3 * (id % 3) / 2.0 + 0) / 6), 6) AS mean, round(avg((id % 4) / 3.0), 6) AS justification FROM c GROUP BY 1 HAVING count(*) >= 10""")
def r8_dqi(spark, sf):
    return rankings.RANKINGS["highest_dqi_speakers@v1"](_codings(spark, sf)).select("person_id", "speeches", F.round("mean", 6).alias("mean"), F.round("level_of_justification", 6).alias("justification"))


@query(f"""WITH {CODED} SELECT person AS person_id, count(*) AS speeches, CAST(sum((id % 5 - 2 < 0 OR id % 7 - 3 > 0)::INT) AS DOUBLE) AS total FROM c GROUP BY 1 HAVING count(*) >= 10""")
def r9_cross_axis(spark, sf):
    return rankings.RANKINGS["cross_axis_divergence@v1"](_codings(spark, sf)).select("person_id", "speeches", "total")


@query(f"""WITH {CODED} SELECT party, round(avg(id % 5 - 2), 6) AS mean, CAST(CASE WHEN party = 'F' THEN 2 ELSE 0 END AS DOUBLE) AS registry FROM c WHERE party <> 'P' GROUP BY 1""")
def r10_manifesto(spark, sf):
    registry_ = spark.createDataFrame([("F", "1980-01-01", 2.0), ("O", "1980-01-01", 0.0)], "party string, cycle string, value double")
    return rankings.RANKINGS["party_manifesto_divergence@v1"](_codings(spark, sf), registry_).select("party", F.round("mean", 6).alias("mean"), F.round("registry", 6).alias("registry"))


@query(f"WITH {CODED} SELECT party, round(avg(h) FILTER (year(day) = 1996) - avg(h) FILTER (year(day) = 1995), 6) AS shift FROM c GROUP BY 1")
def r11_rhetoric_shift(spark, sf):
    return rankings.RANKINGS["party_rhetoric_shift@v1"](_codings(spark, sf), "1995", "1996").select("party", F.round("shift", 6).alias("shift"))


@query(f"WITH {CODED} SELECT person AS person_id, CASE WHEN id % 2 = 0 THEN 'floor' ELSE 'committee' END AS context, count(*) AS n, round(avg(h), 6) AS mean FROM c GROUP BY ALL")
def r12_register_shift(spark, sf):
    return rankings.RANKINGS["politician_register_shift@v1"](_codings(spark, sf)).select("person_id", "context", "n", F.round("mean", 6).alias("mean"))


@query(f"WITH {CODED} SELECT CAST(id AS VARCHAR) AS record_id FROM c WHERE id % 4 = 0 ORDER BY day DESC, 1 LIMIT 100")
def r14_with_marker(spark, sf):
    return rankings.RANKINGS["speeches_with_marker@v1"](_codings(spark, sf), "vparty", "media_hostility").select("record_id")


# ---- lifecycle, registries, audits

@query("""SELECT 'd' || o_custkey AS document_id, count(*) AS n FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1 UNION ALL SELECT 'd' || o_custkey, count(*) FROM orders WHERE o_custkey % 2 = 1 AND o_orderstatus = 'F' GROUP BY 1""")
def i1_index_one(spark, sf):
    """Half of the documents are as they were; of the others only some records are left."""
    o = table(spark, sf, "orders").select(F.concat(F.lit("d"), "o_custkey").alias("document_id"), F.col("o_orderkey").alias("record_id"), "o_custkey", "o_orderstatus")
    old = o.select("document_id", "record_id")
    state = o.select("document_id", F.lit("a").alias("sha")).distinct()
    rows = o.filter("o_custkey % 2 = 0 or o_orderstatus = 'F'").select("document_id", "record_id", F.when(F.col("o_custkey") % 2 == 0, "a").otherwise("b").alias("sha"))
    return lifecycle.index_one(rows, old, state, ["sha"])[0].join(rows.select("document_id").distinct(), "document_id", "left_semi").groupBy("document_id").agg(F.count("*").alias("n"))


@query("SELECT o_orderstatus AS version, count(*) AS documents FROM orders GROUP BY 1")
def k11_versions(spark, sf):
    return audit.versions(sidecars(spark, sf)).select("version", "documents")


@query("""WITH p AS (SELECT 'Om ' || c_nationkey || ' ' || c_custkey AS name, c_custkey FROM customer) SELECT 'om-' || replace(substr(name, 4), ' ', '-') AS id, CAST(2 AS INTEGER) AS mandates FROM p WHERE c_custkey % 3 <> 0 AND c_custkey >= 10""")
def k2_merged_mandates(spark, sf):
    c = table(spark, sf, "customer").withColumn("name", F.concat(F.lit("Om "), "c_nationkey", F.lit(" "), "c_custkey"))
    c = c.filter("c_custkey >= 10 and c_nationkey >= 0")
    held = c.filter("c_custkey % 3 = 0").select(F.concat(F.lit("h"), "c_custkey").alias("id"), F.col("name").alias("canonical_name"), F.lit(None).cast("string").alias("diacritic_form"), F.array().cast("array<string>").alias("aliases"))
    rows = c.select("name", F.explode(F.array(F.lit("2008"), F.lit("2012"))).alias("legislature"), F.lit("deputat").alias("role"), F.lit("X").alias("party"), F.lit("2008-01-01").alias("from"), F.lit(None).cast("string").alias("to"))
    return registry.merged_mandates(held, rows)[0].select("id", F.size("mandates").alias("mandates"))


@query("""SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN 30 WHEN 1 THEN 4 WHEN 2 THEN -4 END AS score, CASE s_suppkey % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' WHEN 2 THEN 'ok' ELSE 'no_match' END AS status FROM supplier""")
def k4_candidates(spark, sf):
    s = table(spark, sf, "supplier")
    k = F.col("s_suppkey") % 4
    people = s.select(F.col("s_suppkey").alias("id"), F.lit("1960-05-05").alias("birth_date"))
    desc = F.when(k == 0, "Romanian politician and senator").when(k == 1, "politician").otherwise("senator")
    found = s.filter(k < 3).select(F.col("s_suppkey").alias("id"), F.concat(F.lit("Q"), "s_suppkey").alias("qid"), desc.alias("description"), F.when(k == 0, "1960-05-05").when(k == 2, "1950-01-01").alias("birth_date"))
    return registry.suggestions(people, found).select("id", F.col("score").cast("int").alias("score"), "status")


@query("""SELECT 'd' || event_id AS document_id, CASE WHEN event_id % 3 = 1 THEN 'vote_open_missing' ELSE 'question_regnum_missing' END AS kind FROM events WHERE event_id % 3 > 0""")
def k9_votes_and_questions(spark, sf):
    e = table(spark, sf, "events")
    k = F.col("event_id") % 3
    document = F.concat(F.lit("d"), "event_id").alias("document_id")
    bodies = e.select(document, F.when(k == 0, "Supun votului legea nr. 5").otherwise("nimic de găsit").alias("body"))
    votes = e.filter("event_id % 3 < 2").select(document, F.lit("v").alias("record_id"), F.lit(0).alias("position"))
    asked = e.filter("event_id % 3 <> 1").select(document, F.lit("q").alias("record_id"), F.lit(0).alias("position"), F.lit(25).alias("span_end"), F.lit("nr. 5").alias("regnum"))
    return audit.votes(votes, bodies).unionByName(audit.questions(asked, bodies)).select("document_id", "kind")


@query("""WITH c AS (SELECT user_id, event_id, ts, sum(value) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS spent FROM events) SELECT event_id FROM c WHERE coalesce(spent, 0) < 10000""")
def m7_within_budget(spark, sf):
    return coverage.within_budget(table(spark, sf, "events").select("event_id", "value"), "event_id", "value", 10_000.0).select("event_id")


@query("SELECT kind, count(*) AS calls, count(*) FILTER (value < 10) AS errors, CAST(sum(user_id) AS BIGINT) AS tokens_in FROM (SELECT event_type AS kind, value, user_id FROM events) GROUP BY 1")
def m10_run_summary(spark, sf):
    calls = table(spark, sf, "events").select(F.col("event_type").alias("kind"), F.when(F.col("value") < 10, "x").alias("error"), F.lit(False).alias("parse_repaired"), F.col("user_id").alias("tokens_in"), F.lit(0).alias("tokens_out"), F.lit(0).alias("latency_ms"), F.lit(0.0).alias("cost_usd"))
    return coverage.run_summary(calls).select("kind", "calls", "errors", "tokens_in")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_name || chr(10) || p_type END AS t FROM part")
def m1_grain_text(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("topic"), F.when(F.col("p_size") % 2 != 0, F.col("p_type")).otherwise("").alias("question_text"))
    return rows.select("p_partkey", coverage.grain_text("interpellations").alias("t"))


@query("SELECT o_custkey % 40 AS person, o_orderstatus AS party, count(*) AS n, count(*) FILTER (o_totalprice > 100000) AS counted, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY ALL")
def a29_speaker_profile(spark, sf):
    rows = table(spark, sf, "orders").select((F.col("o_custkey") % 40).alias("person"), F.col("o_orderstatus").alias("party"), F.col("o_totalprice").alias("price"))
    return aggregates.profile(rows, ["person", "party"], ["price"], F.col("price") > 100_000).select("person", "party", "n", "counted", F.round("mean_price", 4).alias("mean"))


@query("SELECT coalesce(c_mktsegment, '(unknown)') AS key, count(*) AS count FROM customer GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def a1_terms_of_party(spark, sf):
    return aggregates.terms(table(spark, sf, "customer"), F.col("c_mktsegment"), 3, aggregates.UNKNOWN)
