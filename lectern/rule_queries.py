"""Queries that run the text rules, extractors, backfills, lifecycle and audits over texts made from the driver's tables, each with SQL that knows what was put in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import agenda, committees, extract, facsimiles, interpellations, rules, sittings, text
from lectern.functions.session import settled
from lectern.grain_queries import sidecars
from lectern.operators import aggregates, joins, windows
from lectern.plans import audit, backfills, coverage, discourse, lifecycle, named, rankings, registry, reports
from lectern.queries import query, table
from lectern.sources import parsers

cat = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


def events(spark, sf):
    return table(spark, sf, "events")


def made(rows, ident: str, **columns: Column):
    """An id and texts, made before what reads them, so that they're made once."""
    return rows.select(ident, *(c.alias(k) for k, c in columns.items()))


# ---- sources

@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'gone' WHEN 2 THEN 'transient' WHEN 3 THEN 'transient' ELSE 'gone' END AS outcome, least(pow(2, event_id % 6), 8) AS wait FROM events")
def s5_request_outcome(spark, sf):
    k = F.col("event_id") % 5
    status = F.when(k == 1, 404).when(k == 2, 503).when(k == 3, 429).otherwise(200)
    return events(spark, sf).select("event_id", parsers.request_outcome(status, F.lit(False), k != 4).alias("outcome"), parsers.backoff(F.col("event_id") % 6 + 1).alias("wait"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS published, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey || 'Bis' END AS issue, CASE WHEN o_orderkey % 4 > 0 THEN 'Bis' END AS suffix FROM orders")
def s8_file_names(spark, sf):
    name = F.when(F.col("o_orderkey") % 4 > 0, cat(F.date_format("o_orderdate", "yyyy-MM-dd"), "_MO-PII-", F.col("o_orderkey"), "Bis-", F.year("o_orderdate"), ".md")).otherwise(cat("2019-02-31_MO-PII-", F.col("o_orderkey"), "-2019.pdf"))
    rows = made(table(spark, sf, "orders"), "o_orderkey", n=name).select("o_orderkey", rules.file_meta(F.col("n")).alias("m"))
    return rows.select("o_orderkey", F.date_format("m.published", "yyyy-MM-dd").alias("published"), "m.issue", rules.issue_suffix(F.col("m.issue")).alias("suffix"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'Senatul' ELSE 'Camera Deputaților' END AS chamber, '2019-' || lpad(CAST(1 + o_orderkey % 12 AS VARCHAR), 2, '0') || '-' || lpad(CAST(1 + o_custkey % 28 AS VARCHAR), 2, '0') AS session_date, 'VI' AS legislature FROM orders")
def s9_headers(spark, sf):
    month = F.element_at(F.array(*map(F.lit, rules.MONTHS)), (F.col("o_orderkey") % 12 + 1).cast("int"))
    head = cat(F.when(F.col("o_orderkey") % 2 == 0, "SENATUL").otherwise("CAMERA DEPUTAȚILOR"), "\nSESIUNEA I (Legislatura a VI-a)\nȘedința din ziua de ", F.col("o_custkey") % 28 + 1, " ", month, " 2019")
    rows = made(table(spark, sf, "orders"), "o_orderkey", t=head).select("o_orderkey", rules.header_meta(F.col("t")).alias("h"))
    return rows.select("o_orderkey", "h.chamber", F.date_format("h.session_date", "yyyy-MM-dd").alias("session_date"), "h.legislature")


@query("SELECT doc_id, lang, CAST(n_chars AS VARCHAR) AS chars, sha256(coalesce(text, '')) AS body FROM documents")
def s10_frontmatter(spark, sf):
    t = cat("---\nlang: \"", F.col("lang"), "\"\nchars: ", F.col("n_chars"), "\n---\n", F.coalesce("text", F.lit("")))
    rows = made(table(spark, sf, "documents"), "doc_id", t=t).select("doc_id", parsers.frontmatter(F.col("t")).alias("f"))
    return rows.select("doc_id", F.col("f.fields")["lang"].alias("lang"), F.col("f.fields")["chars"].alias("chars"), F.sha2("f.body", 256).alias("body"))


@query("SELECT event_id, '1.' || (event_id % 12) AS version FROM events WHERE event_id % 12 = 11 AND event_id // 12 IN (SELECT event_id // 12 FROM events GROUP BY 1 HAVING count(*) = 12)")
def s13_enrichments(spark, sf):
    """Of twelve versions of a file the numerically highest."""
    e = events(spark, sf)
    base = F.floor(F.col("event_id") / 12)
    whole = e.groupBy(base.alias("b")).agg(F.count("*").alias("n")).filter("n = 12")
    files = e.join(whole, base == F.col("b"), "left_semi").select(cat("d", base, ".embedding.v1_", F.col("event_id") % 12, ".json").alias("file"), cat('{"r', F.col("event_id"), '": {"_meta": {}}}').alias("json"))
    return parsers.enrichments(files).select(F.regexp_extract("record_id", r"(\d+)", 1).cast("long").alias("event_id"), "version")


@query("SELECT o_orderkey, o_orderkey % 3 = 0 OR CAST(DATE '1998-08-02' - CAST(o_orderdate AS DATE) AS INTEGER) <= 30 AS due FROM orders")
def s16_fetch_due(spark, sf):
    seen = F.when(F.col("o_orderkey") % 3 != 0, F.lit(1))
    return table(spark, sf, "orders").select("o_orderkey", lifecycle.fetch_due(F.to_date("o_orderdate"), seen, F.lit("1998-08-02").cast("date"), 30).alias("due"))


@query("SELECT event_id, CASE WHEN value < 20 AND user_id % 10 >= 5 THEN 'likely_scanned' WHEN value < 50 AND user_id % 10 >= 2 THEN 'mixed' WHEN user_id % 10 >= 5 AND value < 200 THEN 'suspicious' ELSE 'text' END AS triage FROM events")
def s20_scan_triage(spark, sf):
    return events(spark, sf).select("event_id", parsers.scan_triage(F.col("value") * 10, (F.col("user_id") % 10) / 10).alias("triage"))


# ---- functions

@query(f"SELECT p_partkey, translate(translate('V„c„roiu ' || p_name || ' ∫ŞȚ', '{text.MOJIBAKE}', '{text.MOJIBAKE_FOR}'), '{text.MARKED}', '{text.PLAIN}') AS folded FROM part")
def t2_fold_names(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.fold_aggressive(cat("V„c„roiu ", F.col("p_name"), " ∫ŞȚ")).alias("folded"))


@query("SELECT p_partkey, CAST(length(p_type) + 2 AS INTEGER) AS start, CAST(length(p_type) + 2 + length(p_name) + 1 AS INTEGER) AS stop FROM part")
def t9_quotes(spark, sf):
    """A quote in other case and white space, found where it stands."""
    rows = made(table(spark, sf, "part"), "p_partkey", t=cat(F.col("p_type"), ": ", F.regexp_replace("p_name", " ", "  "), " gata"), q=F.upper("p_name"))
    return rows.select("p_partkey", extract.quoted_at(F.col("t"), F.col("q")).alias("r")).select("p_partkey", F.col("r")[0].alias("start"), F.col("r")[1].alias("stop"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'tribune' WHEN 1 THEN 'online' END AS mode, 'Pop ' || o_custkey AS name, CASE WHEN o_orderkey % 2 = 0 THEN 'ministru' END AS role FROM orders")
def x14_turns(spark, sf):
    k = F.col("o_orderkey") % 3
    head = cat("## **Domnul Pop ", F.col("o_custkey"), F.when(k == 0, " (de la tribună)").when(k == 1, " (prin videoconferință)").otherwise(""), F.when(F.col("o_orderkey") % 2 == 0, cat("** – _ministru_ **:**")).otherwise(":**"), "\nBună ziua.")
    rows = made(table(spark, sf, "orders"), "o_orderkey", t=head).select("o_orderkey", agenda.activities(F.col("t"))[0].alias("a"))
    return rows.select("o_orderkey", F.col("a.delivery_mode").alias("mode"), "a.name", "a.role")


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'agenda_approval' WHEN 1 THEN 'amendment' ELSE 'procedural' END AS motion_type, CASE WHEN o_custkey % 2 = 0 THEN 'secret_ballot' END AS voting_method, CASE o_custkey % 3 WHEN 0 THEN 'deferred' WHEN 1 THEN 'no_quorum' ELSE 'approved' END AS outcome FROM orders")
def x13_motions(spark, sf):
    k, c = F.col("o_orderkey") % 3, F.col("o_custkey")
    t = cat("Supun votului ", F.when(k == 0, "ordinea de zi").when(k == 1, "un amendament").otherwise("altceva"), F.when(c % 2 == 0, ", prin vot secret").otherwise(""), ". ", F.when(c % 3 == 0, "Rămâne pentru votul final.").when(c % 3 == 1, "Nu avem cvorum.").otherwise("Cu unanimitate de voturi."))
    rows = made(table(spark, sf, "orders"), "o_orderkey", t=t).select("o_orderkey", extract.votes(F.col("t"))[0].alias("v"))
    return rows.select("o_orderkey", "v.motion_type", "v.voting_method", "v.outcome")


@query("SELECT o_orderkey, CAST(CASE o_orderkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS INTEGER) AS n, CASE o_orderkey % 3 WHEN 0 THEN 'speech,narrator,speech' WHEN 1 THEN 'speech,deferral' ELSE 'speech' END AS kinds FROM orders")
def x15_events(spark, sf):
    k = F.col("o_orderkey") % 3
    t = cat("## **Domnul Pop:**\nÎncep.\n", F.when(k == 0, "_(Aplauze.)_\nContinui.").when(k == 1, "Aceasta rămâne pentru votul final de marți.").otherwise("Atât."))
    rows = made(table(spark, sf, "orders"), "o_orderkey", t=t).select("o_orderkey", agenda.activities(F.col("t")).alias("a"))
    return rows.select("o_orderkey", F.size("a").alias("n"), F.array_join(F.transform("a", lambda x: x["type"]), ",").alias("kinds"))


@query("SELECT o_orderkey, CAST(2 AS INTEGER) AS items, 'Titlul ' || o_custkey AS title, '3,4,5' AS pages, 'speech,speech,speech' AS kinds FROM orders")
def x16_agenda(spark, sf):
    """Items of a summary found again in the body."""
    t = cat("SUMAR\n|Nr.<br>1. Titlul ", F.col("o_custkey"), " ....... 3-5<br>2. Al doilea|7|\n\n## **Domnul Pop:**\n1. Primul punct.\n## **Doamna Rus:**\n2. Al doilea punct.\n")
    rows = made(table(spark, sf, "orders"), "o_orderkey", t=t).select("o_orderkey", agenda.items(F.col("t")).alias("i"))
    return rows.select("o_orderkey", F.size("i").alias("items"), F.col("i")[0]["title"].alias("title"), F.array_join(F.transform(F.col("i")[0]["pages"], lambda p: p.cast("string")), ",").alias("pages"), F.array_join(F.flatten(F.transform("i", lambda x: F.transform(x["activities"], lambda a: a["type"]))), ",").alias("kinds"))


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END AS INTEGER) AS items, CASE WHEN o_orderkey % 2 = 0 THEN 'Punctul ' || o_custkey ELSE 'Ședința' END AS title FROM orders")
def x18_fallbacks(spark, sf):
    """Without a summary, items with headers; without these, one for all."""
    t = F.when(F.col("o_orderkey") % 2 == 0, cat("## **1. Punctul ", F.col("o_custkey"), "**\n## **Ion Pop**\nDa.\n## **2. Altul**\n")).otherwise("## **Ion Pop**\nDa.\n")
    rows = made(table(spark, sf, "orders"), "o_orderkey", t=t).select("o_orderkey", agenda.items(F.col("t")).alias("i"))
    return rows.select("o_orderkey", F.size("i").alias("items"), F.col("i")[0]["title"].alias("title"))


@query("SELECT o_orderkey, 'Pop ' || o_custkey AS questioner, CASE o_orderkey % 3 WHEN 0 THEN 'Ministerul Sănătății' WHEN 1 THEN 'Prim-ministrul' END AS addressed_to, CAST(o_orderkey AS VARCHAR) AS number, 'Tema ' || o_orderkey || ' de azi' AS topic, o_orderkey % 2 = 0 AS answered FROM orders")
def x21_interpellations(spark, sf):
    k = F.col("o_orderkey")
    to = F.when(k % 3 == 0, "Întrebarea este adresată Ministerului Sănătății.").when(k % 3 == 1, "Întrebarea este adresată domnului Prim-ministru.").otherwise("Bună ziua.")
    answer = F.when(k % 2 == 0, "## **Doamna Ana Rus** _– secretar de stat_ **:**\nRăspunsul nostru este destul de lung ca să conteze aici.\n").otherwise("")
    t = cat("Trecem la prezentarea interpelărilor noi.\n## **Domnul Pop ", F.col("o_custkey"), ":**\n", to, "\nObiectul interpelării: Tema ", k, " de azi\nVă rog să ne spuneți ce se întâmplă acolo. Nr. ", k, "\n", answer)
    rows = made(table(spark, sf, "orders"), "o_orderkey", t=t).select("o_orderkey", interpellations.interpellations(F.col("t"))[0].alias("i"))
    return rows.select("o_orderkey", F.col("i.questioner.name").alias("questioner"), "i.addressed_to", F.col("i.interpellation_number").alias("number"), "i.topic", F.col("i.response").isNotNull().alias("answered"))


@query("SELECT o_orderkey, 'Pop ' || o_custkey AS questioner, 'PSD' AS party, 'Apa ' || o_custkey AS topic, CAST(o_custkey AS VARCHAR) AS registration_number FROM orders")
def x23_questions(spark, sf):
    t = cat("## **Domnului Ion Rus, ministrul mediului**\n1. **Pop ", F.col("o_custkey"), ", deputat PSD, Cluj**\nObiectul întrebării: Apa ", F.col("o_custkey"), "\nText. Nr. ", F.col("o_custkey"), "/3.2.2019\n")
    rows = made(table(spark, sf, "orders"), "o_orderkey", t=t).select("o_orderkey", extract.questions(F.col("t"))[0].alias("q"))
    return rows.select("o_orderkey", "q.questioner", "q.party", "q.topic", "q.registration_number")


@query("SELECT p_partkey, 'Raport privind activitatea desfășurată de ' || p_brand || ' în anul ' || (2000 + p_size % 20) AS title, p_brand AS issuing_body, (2000 + p_size % 20) || '-01-01' AS period_start, CASE WHEN p_size % 2 = 0 THEN 'senat' ELSE 'camera' END AS session_kind, p_type AS heading, 0.95 AS confidence FROM part")
def x27_reports(spark, sf):
    t = cat("## **Ședința din ziua de 9 aprilie 2019**\nRaport privind activitatea desfășurată de ", F.col("p_brand"), " în anul ", F.col("p_size") % 20 + 2000, "\n# **", F.col("p_type"), "**\n")
    rows = made(table(spark, sf, "part"), "p_partkey", t=t, c=F.when(F.col("p_size") % 2 == 0, "Senatul").otherwise("Camera Deputaților")).select("p_partkey", facsimiles.report(F.col("t"), F.lit(None).cast("string"), F.col("c")).alias("r"))
    return rows.select("p_partkey", "r.title", "r.issuing_body", F.col("r.reporting_period.start").alias("period_start"), "r.received_at.session_kind", F.col("r.headings")[0]["text"].alias("heading"), F.col("r.confidence").cast("decimal(3,2)").alias("confidence"))


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'permanent' WHEN 1 THEN 'special_joint' ELSE 'inquiry' END AS kind, '2020-02-0' || (1 + p_size % 9) AS first_day, CASE p_size % 3 WHEN 0 THEN 'approved' WHEN 1 THEN 'rejected' ELSE 'deferred' END AS outcome, CASE WHEN p_size % 2 = 0 THEN 'aviz' ELSE 'fond' END AS role, CAST(p_partkey AS VARCHAR) AS bill, 'Ion Pop,Ana Rus' AS roster FROM part")
def x28_committees(spark, sf):
    k, n = F.col("p_size") % 3, F.col("p_partkey")
    name = F.when(k == 0, "Comisia pentru ape").when(k == 1, "Comisia specială comună").otherwise("Comisia de anchetă")
    told = F.when(k == 0, "În urma votului, proiectul a fost aprobat.").when(k == 1, "În urma votului, proiectul a fost respins.").otherwise("Amânat.")
    t = cat("## **1. ", name, "**\nComisia și-a desfășurat lucrările în ziua de ", F.col("p_size") % 9 + 1, " februarie 2020.\n1. Proiectul PL-x ", n, "/2019, pentru ", F.when(F.col("p_size") % 2 == 0, "aviz").otherwise("fond"), "\n\n", told, "\n\nAu fost prezenți: Ion Pop și Ana Rus.\n")
    rows = made(table(spark, sf, "part"), "p_partkey", t=t).select("p_partkey", committees.committees(F.col("t"))[0].alias("c"))
    item = F.col("c.agenda")[0]
    return rows.select("p_partkey", "c.kind", F.col("c.dates")[0].alias("first_day"), item["vote_summary"]["outcome"].alias("outcome"), item["committee_role"].alias("role"), item["references"][0]["number"].alias("bill"), F.array_join(F.transform("c.roster", lambda r: r["name"]), ",").alias("roster"))


@query("SELECT p_partkey, '2020-01-0' || (1 + p_size % 9) AS first_day, '2020-02-1' || (p_size % 10) AS last_day FROM part")
def v15_periods(spark, sf):
    t = cat("Perioada: ", F.col("p_size") % 9 + 1, ".01 - 1", F.col("p_size") % 10, ".02.2020")
    rows = made(table(spark, sf, "part"), "p_partkey", t=t).select("p_partkey", committees.period(F.col("t")).alias("p"))
    return rows.select("p_partkey", F.col("p.start").alias("first_day"), F.col("p.end").alias("last_day"))


@query("SELECT o_orderkey, 'legislature_paren,session_label' AS kinds, CAST(0 AS INTEGER) AS first_start FROM orders")
def v5_recurring_lines(spark, sf):
    rows = made(table(spark, sf, "orders"), "o_orderkey", t=cat("SESIUNEA ", F.col("o_orderkey"), "\n(Legislatura a V-a)\ntext")).select("o_orderkey", sittings.recurring(F.col("t")).alias("r"))
    names = F.array_sort(F.transform("r", lambda x: F.substring_index(x["reason"], ".", -1)))
    return rows.select("o_orderkey", F.array_join(names, ",").alias("kinds"), F.array_min(F.transform("r", lambda x: x["start"])).alias("first_start"))


@query("SELECT o_orderkey, 'Pop Marin' AS chair, 'Rus Ana' AS secretary, lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':05' AS opened_at, CASE WHEN o_orderkey % 2 = 0 THEN 'mixed' ELSE 'in_person' END AS format FROM orders")
def v7_chairs(spark, sf):
    k = F.col("o_orderkey")
    t = cat("_Ședința a început la ora ", k % 24, ".05._\n_Lucrările ședinței au fost conduse de domnul deputat Pop Marin, asistat de doamna deputat Rus Ana._\n", F.when(k % 2 == 0, "format mixt").otherwise(""))
    rows = made(table(spark, sf, "orders"), "o_orderkey", t=t).select("o_orderkey", sittings.facts(F.col("t"), F.lit(2001)).alias("f"))
    first = F.col("f.chair_segments")[0]
    return rows.select("o_orderkey", first["chair"]["name"].alias("chair"), first["secretaries"][0]["name"].alias("secretary"), "f.opened_at", "f.format")


# ---- filters and coverage

@query("SELECT doc_id, n_chars % 3 = 1 AS ambiguous FROM documents")
def f11_ambiguous(spark, sf):
    k = F.col("n_chars") % 3
    t = F.when(k == 0, "DEZBATERI PARLAMENTARE (STENOGRAMA)").when(k == 1, "SINTEZA LUCRĂRILOR COMISIILOR (STENOGRAMA)").otherwise("nimic")
    return made(table(spark, sf, "documents"), "doc_id", t=t).select("doc_id", rules.classified(F.col("t"), F.lit(""))["ambiguous"].alias("ambiguous"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 1850 + o_custkey BETWEEN 1900 AND 2100 WHEN 1 THEN 1850 + o_custkey BETWEEN 1990 AND 2100 ELSE true END AS fits FROM orders")
def f12_year_bounds(spark, sf):
    kind = F.element_at(F.array(F.lit("law"), F.lit("bill"), F.lit("other")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", rules.year_in_bounds(kind, F.lit(1850) + F.col("o_custkey"), {"law": (1900, 2100), "bill": (1990, 2100)}).alias("fits"))


@query("SELECT doc_id, length(text) AS body_chars, least(length(text), 50) AS claimed_chars FROM documents WHERE length(text) > 100")
def f13_coverage(spark, sf):
    d = table(spark, sf, "documents").filter("length(text) > 100").withColumn("claims", F.array(F.struct(F.lit(0).alias("start"), F.lit(30).alias("end")), F.struct(F.lit(30).alias("start"), F.lit(50).alias("end"))))
    return coverage.covered(d).select("doc_id", F.col("coverage.body_chars").cast("long").alias("body_chars"), F.col("coverage.claimed_chars").cast("long").alias("claimed_chars"))


@query("SELECT count(DISTINCT o_custkey) AS speakers, count(o_custkey) AS speeches FROM orders WHERE o_totalprice >= 100000")
def a3_cardinality(spark, sf):
    return aggregates.cardinality(table(spark, sf, "orders").filter("o_totalprice >= 100000"), "o_custkey", exact=True).select(F.col("distinct").alias("speakers"), F.col("values").alias("speeches"))


@query("SELECT 'documents' AS grain, count(*) AS total, count(*) FILTER (n_chars > 500) AS embedded FROM documents UNION ALL SELECT 'pages', count(*), count(html) FROM pages UNION ALL SELECT 'none', 0, 0")
def a7_embedding_coverage(spark, sf):
    d, p = table(spark, sf, "documents"), table(spark, sf, "pages")
    grains_ = {"documents": d.select((F.col("n_chars") > 500).alias("has")), "pages": p.select(F.col("html").isNotNull().alias("has")), "none": d.limit(0).select(F.lit(True).alias("has"))}
    return aggregates.coverage_of({k: (df, F.col("has")) for k, df in grains_.items()}).select("grain", "total", F.col("covered").alias("embedded"))


# ---- joins and backfills

@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'm' || o_custkey % 7 WHEN o_orderkey % 3 = 1 THEN 'i1' END AS match FROM orders")
def j10_addressees(spark, sf):
    ministries = spark.createDataFrame([(f"Ministerul Numărul {n} Bun", f"m{n}", n) for n in range(7)], "alias string, id string, seq int")
    bodies = spark.createDataFrame([("Curtea de Conturi", "i1", 0)], "alias string, id string, seq int")
    k = F.col("o_orderkey") % 3
    raw = F.when(k == 0, cat("MINISTERUL Numarul ", F.col("o_custkey") % 7, " bun")).when(k == 1, "curtea de conturi").otherwise("altceva")
    return backfills.addressees(made(table(spark, sf, "orders"), "o_orderkey", raw=raw), ministries, bodies).select("o_orderkey", "match")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN value END AS payload FROM events")
def j13_attached(spark, sf):
    e = events(spark, sf)
    return discourse.attached(e.select(F.col("event_id").alias("record_id")), e.filter("event_id % 2 = 0").select(F.col("event_id").alias("record_id"), F.col("value").alias("payload"))).select(F.col("record_id").alias("event_id"), "payload")


@query("WITH q AS (SELECT user_id, event_id AS at FROM events WHERE event_type = 'view'), r AS (SELECT user_id, event_id FROM events WHERE event_type <> 'view') SELECT r.event_id, max(q.at) AS answers FROM r LEFT JOIN q ON q.user_id = r.user_id AND q.at < r.event_id GROUP BY 1")
def j15_responses(spark, sf):
    """Each answer goes to the nearest earlier question."""
    e = events(spark, sf).select("user_id", "event_id", "event_type")
    asked = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("at"), F.col("event_id").alias("answers"))
    return joins.as_of(e.filter("event_type <> 'view'").select("user_id", "event_id"), asked, "user_id", "event_id", "at", ["answers"], strict=True).select("event_id", "answers")


@query("SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 1996 THEN 2.0::DOUBLE WHEN year(o_orderdate) >= 1993 THEN 1.0::DOUBLE END AS value FROM orders WHERE o_orderstatus = 'F'")
def j21_party_positions(spark, sf):
    positions = spark.createDataFrame([("F", "1993-01-01", 1.0), ("F", "1996-01-01", 2.0)], "party string, cycle string, value double")
    rows = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", F.col("o_orderstatus").alias("party"), F.to_date("o_orderdate").alias("session_date"))
    return rankings.party_position(rows, positions, ["value"]).select("o_orderkey", "value")


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'kept' WHEN 1 THEN 'filled' WHEN 2 THEN 'same' WHEN 3 THEN 'mismatch' ELSE 'unmatched' END AS action, CASE o_orderkey % 5 WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'a' WHEN 3 THEN 'a' END AS value FROM orders")
def b1_overwrite_policy(spark, sf):
    k = F.col("o_orderkey") % 5
    rows = made(table(spark, sf, "orders"), "o_orderkey", old=F.when(k.isin(0, 2, 3), "a"), new=F.when(k == 2, "a").when(k.isin(1, 3), "b"))
    value, action = backfills.overwritten(F.col("old"), F.col("new"))
    return rows.select("o_orderkey", action.alias("action"), value.alias("value"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 'guvern' END AS person_id FROM lineitem")
def b3_government_votes(spark, sf):
    kind = "struct<person_id:string,name:string,is_government:boolean>"
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.struct(F.array(F.lit("law")).alias("types")).alias("refs"), F.when(F.col("l_linenumber") % 2 == 0, "Ordonanța Guvernului").otherwise("Lege").alias("agenda_title"), F.lit(None).cast(kind).alias("proposed_by"))
    return backfills.government_votes(rows).select("l_orderkey", "l_linenumber", "proposed_by.person_id")


@query("SELECT 'mo://' || l_orderkey AS document_id, 's' || l_suppkey AS person_id, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL")
def b5_speakers(spark, sf):
    """Every speaker that a body names, by document."""
    return backfills.speakers(sidecars(spark, sf)).filter("person_id is not null").groupBy("document_id", "person_id").agg(F.count("*").alias("n"))


# ---- registries

@query("SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'nume-xx' || n_nationkey || '-2' ELSE 'nume-xx' || n_nationkey END AS id, 3 * count(*) AS n FROM nation WHERE n_nationkey >= 0 GROUP BY n_nationkey")
def k1_stubs(spark, sf):
    nations = table(spark, sf, "nation").withColumn("name", cat("Nume xx", F.col("n_nationkey")))
    rows = nations.select(F.explode(F.array("name", F.upper("name"), "name")).alias("name"), F.lit(2001).alias("year"))
    taken = nations.filter("n_nationkey % 2 = 0").select(cat("nume-xx", F.col("n_nationkey")).alias("id"))
    return backfills.stubs(rows, "name", "year", taken).select("id", F.col("count").alias("n"))


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'skip' WHEN 1 THEN 'augment' ELSE 'add' END AS action FROM supplier")
def k3_outside_ids(spark, sf):
    s = table(spark, sf, "supplier").withColumn("name", cat("Om xx", F.col("s_suppkey")))
    k = F.col("s_suppkey") % 3
    held = s.filter(k < 2).select(cat("h", F.col("s_suppkey")).alias("id"), F.col("name").alias("canonical_name"), F.lit(None).cast("string").alias("diacritic_form"), F.array().cast("array<string>").alias("aliases"), F.when(k == 0, cat("Q", F.col("s_suppkey"))).alias("wikidata_qid"), F.lit(None).cast("string").alias("birth_date"))
    rows = s.select(cat("Q", F.col("s_suppkey")).alias("qid"), F.col("name").alias("label_en"), F.lit(None).cast("string").alias("label_ro"), F.lit(None).cast("string").alias("birth_date"))
    return registry.merged_outside(held, rows).select(F.regexp_extract("qid", r"(\d+)", 1).cast("long").alias("s_suppkey"), "action")


# ---- audits

@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 1 THEN 'speaker_mismatch' ELSE 'invented_or_misplaced_speech' END AS kind FROM orders WHERE o_orderkey % 3 > 0")
def k5_speeches(spark, sf):
    k = F.col("o_orderkey") % 3
    o = table(spark, sf, "orders")
    ident = F.col("o_orderkey").cast("string").alias("document_id")
    bodies = o.select(ident, F.when(k == 2, "Fără antet aici").otherwise("## **Domnul Ion Pop:**\nBună ziua").alias("body"))
    rows = o.select(ident, F.lit("p").alias("parent"), F.lit("r").alias("record_id"), F.lit("speech").alias("kind"), F.lit(0).alias("position"), F.lit(None).cast("int").alias("span_end"), F.lit("x").alias("speaker_raw"), F.when(k == 1, "Dan Voicu").otherwise("Ion Pop").alias("speaker_name"), F.lit("").alias("text"))
    return audit.speeches(rows, bodies).select(F.col("document_id").cast("long").alias("o_orderkey"), "kind")


@query("SELECT o_orderkey, 'Ana Rus' AS detail FROM orders WHERE o_orderkey % 2 = 1")
def k6_dropped_turns(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("document_id"), "o_orderkey")
    heads = o.select("document_id", F.explode(F.array(F.struct(F.lit(0).alias("position"), F.lit("Ion Pop").alias("name")), F.struct(F.lit(500).alias("position"), F.lit("Ana Rus").alias("name")))).alias("h")).select("document_id", "h.*")
    starts = o.select("document_id", F.lit(50).alias("position"))
    out = o.filter("o_orderkey % 2 = 0").select("document_id", F.lit(450).alias("start"), F.lit(600).alias("end"))
    return audit.dropped_turns(heads, starts, out).select(F.col("document_id").cast("long").alias("o_orderkey"), "detail")


@query("SELECT p_partkey FROM part WHERE p_size % 3 = 0")
def k7_titles(spark, sf):
    p = table(spark, sf, "part")
    ident = F.col("p_partkey").cast("string").alias("document_id")
    rows = p.select(ident, F.lit("a").alias("record_id"), F.when(F.col("p_size") % 3 == 0, "Cu totul altceva").otherwise(F.upper(cat("Titlul ", F.col("p_name"), " 12"))).alias("title"))
    return audit.agenda_titles(rows, p.select(ident, cat("Sumar: Titlul ", F.col("p_name"), " și altele").alias("body"))).select(F.col("document_id").cast("long").alias("p_partkey"))


@query("SELECT p_partkey FROM part WHERE p_size % 2 = 1")
def k8_questioners(spark, sf):
    p = table(spark, sf, "part")
    ident = F.col("p_partkey").cast("string").alias("document_id")
    rows = p.select(ident, F.lit("a").alias("record_id"), F.lit(0).alias("position"), F.when(F.col("p_size") % 2 == 1, "Zzzz Yyyy").otherwise("Domnul Țăranu Ștefan").alias("speaker_name"))
    return audit.questioners(rows, p.select(ident, F.lit("Întreabă taranu stefan despre ape").alias("body"))).select(F.col("document_id").cast("long").alias("p_partkey"))


@query("SELECT o_orderkey, 1 AS run FROM orders WHERE o_orderkey % 50 = 0")
def k10_idempotent(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return audit.idempotent(o, o.filter("o_orderkey % 50 <> 0"))


@query("SELECT doc_id, substr(text, 41, 40) AS excerpt FROM documents WHERE length(text) > 100")
def k12_occurrences(spark, sf):
    d = table(spark, sf, "documents").filter("length(text) > 100")
    rows = d.select(F.col("doc_id").alias("document_id"), F.lit("s").alias("record_id"), F.lit(60).alias("position"), F.lit("x").alias("speaker_raw"))
    return audit.occurrences(rows, d.select(F.col("doc_id").alias("document_id"), F.col("text").alias("body")), "x", 20).select(F.col("document_id").alias("doc_id"), "excerpt")


# ---- lifecycle

@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'documents' WHEN 1 THEN 'agenda_items' WHEN 2 THEN 'speeches' ELSE 'votes' END AS grain FROM orders")
def i3_grain_of(spark, sf):
    k = F.col("o_orderkey") % 4
    ident = cat("mo://", F.col("o_orderkey"), F.when(k > 0, "#agenda-1").otherwise(""), F.when(k == 2, "#act-1").when(k == 3, "#vote-1").otherwise(""))
    return table(spark, sf, "orders").select("o_orderkey", lifecycle.grain_of(ident).alias("grain"))


@query("SELECT c_custkey, sha256('{\"c_custkey\":' || c_custkey || ',\"c_name\":\"' || c_name || '\"}') AS digest FROM customer")
def i5_row_digest(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", lifecycle.row_digest(F.col("c_custkey"), F.col("c_name")).alias("digest"))


@query("SELECT r_regionkey, r_name FROM region")
def i6_generations(spark, sf):
    """A table served from the generation that was swapped in last."""
    import uuid

    from lectern.functions.session import shared_folder

    g = lifecycle.Generations(spark, f"{shared_folder(spark)}/generations-{uuid.uuid4().hex}")
    name = f"served_{uuid.uuid4().hex}"
    rows = table(spark, sf, "region").select("r_regionkey", "r_name")
    g.bootstrap({name: rows.limit(1)}, "a")
    g.write(name, "b", rows)
    g.swap(name, "b")
    g.drop(name, "a")
    return spark.table(name)


@query("SELECT l_orderkey, l_linenumber, 'i' || l_orderkey || CASE WHEN l_returnflag = 'R' THEN '#vote-' ELSE '#act-' END || row_number() OVER (PARTITION BY l_orderkey, l_returnflag = 'R' ORDER BY l_linenumber, l_partkey) AS id FROM lineitem")
def v2_restamped(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", cat("i", F.col("l_orderkey")).alias("parent"), F.when(F.col("l_returnflag") == "R", "vote").otherwise("speech").alias("kind"))
    return lifecycle.restamped(rows, "parent", "kind", F.col("l_linenumber"), F.col("l_partkey")).select("l_orderkey", "l_linenumber", "id")


@query("SELECT o_orderkey, o_orderstatus <> 'P' AS current FROM orders")
def v1_versions(spark, sf):
    m = F.create_map(F.lit("b"), F.when(F.col("o_orderstatus") == "P", "1").otherwise("2"), F.lit("a"), F.lit("1"))
    return table(spark, sf, "orders").select("o_orderkey", lifecycle.versions_current(m, F.lit("9"), {"a": "1", "b": "2"}, "9").alias("current"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice < 50000 AND o_orderstatus = 'P' THEN 'price,status' WHEN o_totalprice < 50000 THEN 'price' ELSE 'status' END AS errors FROM orders WHERE o_totalprice < 50000 OR o_orderstatus = 'P'")
def v4_invalid(spark, sf):
    bad = lifecycle.invalid(table(spark, sf, "orders"), {"price": F.col("o_totalprice") >= 50_000, "status": F.col("o_orderstatus") != "P"})
    return bad.select("o_orderkey", F.array_join("errors", ",").alias("errors"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'old-' || o_orderkey ELSE 'new-' || o_orderkey END AS slug FROM orders")
def v2_carried_slugs(spark, sf):
    o = table(spark, sf, "orders")
    rows = o.select(F.col("o_orderkey").alias("record_id"), cat("new-", F.col("o_orderkey")).alias("slug"))
    prior = o.filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("record_id"), cat("old-", F.col("o_orderkey")).alias("slug"))
    return lifecycle.carried(rows, prior).select(F.col("record_id").alias("o_orderkey"), "slug")


# ---- codings

@query("SELECT event_id, CAST(event_id % 3 AS INTEGER) AS score, CASE WHEN event_id % 2 = 0 THEN 'me' ELSE 'you' END AS dominant_voice, 'a,b' AS kinds FROM events")
def p18_discourse(spark, sf):
    k = F.col("event_id")
    voices = F.when(k % 2 == 0, '[{"voice":"you"},{"voice":"me"},{"voice":"me"}]').otherwise('[{"voice":"you"},{"voice":"me"}]')
    payload = cat('{"hawkins":{"score":', k % 3, ',"markers":[{"kind":"a"},{"kind":"b"},{"kind":"a"},{}]},"voice":{"classifications":', voices, "}}")
    rows = discourse.flattened(made(events(spark, sf), "event_id", payload=payload))
    return rows.select("event_id", "discourse.hawkins.score", "discourse.voice.dominant_voice", F.array_join("discourse.hawkins.marker_kinds", ",").alias("kinds"))


@query("SELECT event_id, CAST(event_id % 7 AS INTEGER) AS a FROM events")
def m5_salvaged(spark, sf):
    raw = cat("Iată:\n```json\n{\"a\": ", F.col("event_id") % 7, ", \"b\": [1, 2,],}\n```\nGata")
    return made(events(spark, sf), "event_id", raw=raw).select("event_id", extract.salvaged(F.col("raw"), "a int, b array<int>")["a"].alias("a"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 1 THEN 'nimic' END AS missing FROM part")
def m6_missing_evidence(spark, sf):
    rows = made(table(spark, sf, "part"), "p_partkey", t=F.col("p_name"), m=F.array(F.struct(F.lit("a").alias("kind"), F.struct(F.when(F.col("p_size") % 2 == 1, "nimic").otherwise(F.upper("p_name")).alias("text")).alias("evidence"))))
    lost = discourse.missing_evidence(discourse.evidence(rows, "p_partkey", "t", F.col("m")), "p_partkey")
    return rows.select("p_partkey").join(lost, "p_partkey", "left").select("p_partkey", F.col("fragments_not_found")[0].alias("missing"))


@query("SELECT event_id, event_id % 4 IN (0, 1) AS clean FROM events")
def m8_clean_entries(spark, sf):
    k = F.col("event_id") % 4
    part = lambda bad, marks: F.struct(F.when(bad, "x").alias("error"), marks.alias("markers"))
    none, some = F.array().cast("array<string>"), F.array(F.lit("m"))
    hawkins = part(F.lit(False), F.when(k.isin(1, 2), some).otherwise(none))
    voice = F.when(k == 1, part(F.lit(False), none))
    return events(spark, sf).select("event_id", coverage.clean_entry(hawkins, voice, part(k == 3, none), part(F.lit(False), none)).alias("clean"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN least(user_id, 60)::DOUBLE END AS wait, event_id % 3 = 0 AND user_id >= 95 AS cut FROM events")
def m9_retries(spark, sf):
    k = F.col("event_id")
    return events(spark, sf).select("event_id", reports.retry_after(F.col("user_id").cast("string"), F.when(k % 2 == 0, 429).otherwise(500)).alias("wait"), reports.truncated(F.lit("schema_invalid"), F.when(k % 3 == 0, "'r' is a required property"), F.col("user_id"), F.lit(100)).alias("cut"))


@query("SELECT doc_id FROM documents WHERE length(text) >= 100 AND doc_id % 2 = 1")
def m2_to_embed(spark, sf):
    """Even documents have a vector of the same text."""
    d = table(spark, sf, "documents")
    rows = d.select(F.col("doc_id").cast("string").alias("record_id"), "text")
    print_ = text.fingerprint(F.substring("text", 1, 8000))
    prior = d.filter("doc_id % 2 = 0").select(F.col("doc_id").cast("string").alias("record_id"), print_.alias("text_fingerprint"), F.array(F.lit(0.0)).alias("vector"))
    return coverage.to_embed(rows, prior, "speeches", 1).select(F.col("record_id").cast("long").alias("doc_id"))


@query("""WITH d AS (SELECT o_orderkey, year(o_orderdate) // 10 * 10 AS y, md5('s:' || o_orderkey) AS d FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY d, o_orderkey) <= greatest(1, 60 // (SELECT count(DISTINCT y) FROM d)) AS f FROM d) SELECT o_orderkey FROM r ORDER BY f DESC, d, o_orderkey LIMIT 60""")
def w14_decade_stratified(spark, sf):
    return windows.stratified(table(spark, sf, "orders"), "o_orderkey", F.floor(F.year("o_orderdate") / 10) * 10, 60).select("o_orderkey")


@query("SELECT vec_id FROM embeddings WHERE vec_id = 0")
def n2_knn_search(spark, sf):
    """The vector itself is nearest to it."""
    first = [float(x) for x in table(spark, sf, "embeddings").filter("vec_id = 0").select("embedding").first()[0]]
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("record_id"), F.col("embedding"), F.struct(F.lit("p").alias("person_id"), F.lit("n").alias("name_search"), F.lit("x").alias("party_group_at_time")).alias("speaker"), F.struct(F.array().cast("array<string>").alias("bills")).alias("refs"), F.lit(True).alias("is_substantive"))
    hits = named.run(named.Store({"speeches": rows}), "search_speeches_knn", {"query_vector": first, "page_size": 1}).hits
    return settled(hits.select(F.col("record_id").alias("vec_id")))


# ---- streams, on what is there now

def _stream(spark, sf):
    import uuid

    from lectern.functions.session import shared_folder
    from lectern.streaming import streams

    return streams.events(spark, f"{sf}/events.parquet"), f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


@query("SELECT user_id, arg_max(event_id, struct_pack(a := ts, b := event_id)) AS event_id FROM events GROUP BY 1")
def st3_upserted(spark, sf):
    """The last event of each user, upserted batch by batch."""
    from lectern.streaming import streams

    stream, path = _stream(spark, sf)
    return streams.upsert_into(stream.select("user_id", "event_id", "ts"), f"{path}/state", ["user_id"], ["ts", "event_id"], f"{path}/checkpoint").select("user_id", "event_id")


@query("SELECT event_id, value FROM events")
def st5_journal(spark, sf):
    from lectern.streaming import streams

    stream, path = _stream(spark, sf)
    return streams.journal(stream.select("event_id", "value"), f"{path}/rows", f"{path}/checkpoint")


@query("""WITH v AS (SELECT user_id, CAST(event_id AS VARCHAR) AS d, ts, event_type = 'view' AS deferred FROM events), m AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM v),
n AS (SELECT a.d, a.ts, (SELECT min(struct_pack(t := b.ts, d := b.d)) FROM v b WHERE b.user_id = a.user_id AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 2 DAY) AS x FROM v a WHERE a.deferred)
SELECT d AS document_id, CASE WHEN x IS NOT NULL AND x.t <= mark THEN x.d END AS defers_to FROM n, m WHERE (x IS NOT NULL AND epoch_ms(x.t) <= epoch_ms(mark)) OR (epoch_ms(ts + INTERVAL 2 DAY) < epoch_ms(mark) AND (x IS NULL OR epoch_ms(x.t) > epoch_ms(mark)))""")
def st4_waiting(spark, sf):
    """Views wait up to two days for the user's next event."""
    from lectern.streaming import streams

    stream, path = _stream(spark, sf)
    votes = stream.select(F.col("user_id").cast("string").alias("match_key"), F.col("event_id").cast("string").alias("document_id"), F.col("ts").alias("at"), F.when(F.col("event_type") == "view", "deferred").otherwise("approved").alias("outcome"))
    return streams.drained(streams.waiting(votes, days=2), f"{path}/rows", f"{path}/checkpoint", "append").select("document_id", "defers_to")


# ---- sources, continued

@query("SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS number, '/gazette--PII--' || p_partkey || '--2019.html' AS href FROM part")
def s2_issues(spark, sf):
    """Of two links to one issue the first; links to other parts don't count."""
    link = lambda part, n: cat('<a href="/gazette--P', part, "--", n, '--2019.html">x</a>')
    n = F.col("p_partkey")
    rows = made(table(spark, sf, "part"), "p_partkey", html=cat(link("I", n), link("II", n), " text ", link("II", n)))
    return parsers.issues(rows, key="p_partkey").select("p_partkey", "number", "href")


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN user_id END AS number, CASE WHEN event_id % 4 = 1 THEN '2019-02-03' END AS day, CASE event_id % 4 WHEN 2 THEN 'a\"b' WHEN 3 THEN '2019-02-31' END AS text FROM events")
def s10_typed_values(spark, sf):
    k = F.col("event_id") % 4
    raw = F.when(k == 0, F.col("user_id").cast("string")).when(k == 1, " 2019-02-03 ").when(k == 2, '"a\\"b"').otherwise("2019-02-31")
    rows = made(events(spark, sf), "event_id", raw=raw).select("event_id", parsers.typed(F.col("raw")).alias("v"))
    return rows.select("event_id", "v.number", F.date_format("v.day", "yyyy-MM-dd").alias("day"), "v.text")


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'topics' WHEN 1 THEN 'embedding,embedding_text_fingerprint' ELSE '' END AS names, CASE WHEN event_id % 3 = 0 THEN '[\"a\"]' WHEN event_id % 3 = 1 THEN 'f' || event_id END AS first FROM events")
def p17_enrichments(spark, sf):
    """A lone key stands for its producer, an embedding is taken apart, unknown producers go."""
    k = F.col("event_id") % 3
    producer = F.when(k == 0, "topics").when(k == 1, "embedding").otherwise("other")
    payload = F.when(k == 0, '{"_meta": {"v": 1}, "topics": ["a"]}').when(k == 1, cat('{"vector": [1.0], "text_fingerprint": "f', F.col("event_id"), '"}')).otherwise('{"x": 1}')
    rows = made(events(spark, sf), "event_id", p=producer, j=payload)
    flat = parsers.flat_enrichment(F.col("p"), F.col("j"), ["topics", "embedding", "embedding_text_fingerprint"])
    out = rows.select("event_id", flat.alias("m"))
    return out.select("event_id", F.array_join(F.array_sort(F.map_keys("m")), ",").alias("names"), F.coalesce(F.col("m")["topics"], F.col("m")["embedding_text_fingerprint"]).alias("first"))


# ---- extraction, continued

@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'raport_comun' WHEN 1 THEN 'aviz' ELSE 'studiu' END AS output_type, CASE WHEN p_size % 2 = 0 THEN 'rejected' ELSE 'approved' END AS outcome, CAST(p_partkey AS VARCHAR) AS bill, 'Legea numărul ' || p_partkey AS title, '10:00-12:30' AS hours, 'Comisia pentru ape' AS joint_with FROM part")
def v21_tables(spark, sf):
    """An agenda as a table, hours, and whom the committee sat with."""
    k = F.col("p_size")
    row = cat("|1.|PL-x ", F.col("p_partkey"), "/2020|Legea numărul ", F.col("p_partkey"), "|", F.when(k % 3 == 0, "Raport comun").when(k % 3 == 1, "Aviz").otherwise("Studiu"), "|În urma votului s-a ", F.when(k % 2 == 0, "respins").otherwise("aprobat"), "|\n")
    t = cat("## **Comisia juridică**\nÎntre orele 10,00 - 12,30, în ședință comună cu Comisia pentru ape.\n|Nr. crt.|PL-x|Titlu|Rol|Rezoluție|\n|---|---|---|---|---|\n", row)
    rows = made(table(spark, sf, "part"), "p_partkey", t=t).select("p_partkey", committees.committees(F.col("t"))[0].alias("c"))
    item, hours = F.col("c.agenda")[0], F.col("c.time_windows")[0]
    return rows.select("p_partkey", item["output_type"].alias("output_type"), item["vote_summary"]["outcome"].alias("outcome"), item["references"][0]["number"].alias("bill"), item["title"].alias("title"), F.concat_ws("-", hours["start"], hours["end"]).alias("hours"), F.col("c.joint_with")[0]["name"].alias("joint_with"))


@query("SELECT p_partkey, 'Pop Ion:' || CASE WHEN p_size % 2 = 0 THEN 'physical' ELSE 'absent' END || ',Rus Ana:substituted,Ene Dan:physical' AS roster, 'Voicu Dan' AS substitute, 'secretar' AS role FROM part")
def v22_rosters(spark, sf):
    """A roster in a table, then a day's list; names that both have count once."""
    t = cat("## **Comisia juridică**\n|Numele și prenumele|Prezență|\n|---|---|\n|Pop Ion|", F.when(F.col("p_size") % 2 == 0, "Prezent fizic").otherwise("Absent motivat"), "|\n|Rus Ana|Înlocuită de Voicu Dan|\n\n1. Rus Ana, Grupul parlamentar al PSD\n2. Ene Dan – secretar, Grupul parlamentar al PNL\n")
    rows = made(table(spark, sf, "part"), "p_partkey", t=t).select("p_partkey", committees.committees(F.col("t"))[0]["roster"].alias("r"))
    return rows.select("p_partkey", F.array_join(F.transform("r", lambda x: F.concat_ws(":", x["name"], x["mode"])), ",").alias("roster"), F.col("r")[1]["substituted_by"].alias("substitute"), F.col("r")[2]["role"].alias("role"))


@query("SELECT event_id, CAST(event_id % 4 AS INTEGER) AS level, CASE WHEN event_id % 2 = 0 THEN 'mixed' END AS content, CAST(event_id % 2 AS INTEGER) AS markers FROM events")
def p20_dqi(spark, sf):
    k = F.col("event_id")
    payload = cat('{"dqi":{"level_of_justification":', k % 4, F.when(k % 2 == 0, ',"content_of_justification":"mixed"').otherwise(""), ',"markers":[', F.when(k % 2 == 1, '{"kind":"a","value":"7"}').otherwise("{}"), "]}}")
    rows = discourse.flattened(made(events(spark, sf), "event_id", payload=payload))
    d = F.col("discourse.dqi")
    return rows.select("event_id", d["level_of_justification"].alias("level"), d["content_of_justification"].alias("content"), F.greatest(F.coalesce(F.size(d["markers"]), F.lit(0)), F.lit(0)).alias("markers"))


@query("SELECT o_orderkey, ['muncii', 'procedura_penala', 'insolventei'][1 + o_orderkey % 3] AS code, CASE o_custkey % 3 WHEN 0 THEN 'joint' WHEN 1 THEN 'camera' ELSE 'senat' END AS chamber FROM orders")
def x9_codes_and_chambers(spark, sf):
    from lectern.functions import citations

    k, c = F.col("o_orderkey") % 3, F.col("o_custkey") % 3
    code = F.when(k == 0, "Codul muncii").when(k == 1, "Codul de procedură penală").otherwise("Codului insolvenței")
    rule = F.when(c == 0, "Regulamentul activităților comune ale Parlamentului").when(c == 1, "Regulamentul Camerei Deputaților").otherwise("Regulamentul Senatului")
    rows = made(table(spark, sf, "orders"), "o_orderkey", t=cat(code, "; ", rule)).select("o_orderkey", citations.citations(F.col("t")).alias("r"))
    return rows.select("o_orderkey", F.col("r")[0]["kind"].alias("code"), F.col("r")[1]["chamber"].alias("chamber"))


@query("SELECT o_orderkey, 'Ion Rus' AS addressee, 'ministrul mediului' AS role, 0.95 AS confidence FROM orders")
def x24_addressees(spark, sf):
    t = cat("## **Domnului Ion Rus, ministrul mediului**\n1. **Pop ", F.col("o_custkey"), ", deputat PSD**\nObiectul întrebării: Apa\nText. Nr. 5A/3.2.2019\n")
    rows = made(table(spark, sf, "orders"), "o_orderkey", t=t).select("o_orderkey", extract.questions(F.col("t"))[0].alias("q"))
    return rows.select("o_orderkey", "q.addressee", F.col("q.addressee_role").alias("role"), F.col("q.confidence").cast("decimal(3,2)").alias("confidence"))
