"""Queries of the library's operators over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import rules, text
from lectern.operators import aggregates, joins, sets, windows
from lectern.plans import lifecycle, named, rankings, search
from lectern.sources import parsers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def day(c: str):
    return F.date_format(c, "yyyy-MM-dd")


def seconds(c: str):
    return F.unix_seconds(F.col(c).cast("timestamp"))


# ---- named queries

@query("""SELECT coalesce(c_mktsegment, '(unknown)') AS party, year(o_orderdate) AS year, count(*) AS n, sum(count(*)) OVER (PARTITION BY coalesce(c_mktsegment, '(unknown)')) AS party_n
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice >= 1000 GROUP BY 1, 2""")
def n12_by_party_year(spark, sf):
    """Two-level buckets, substantive rows only."""
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    out = named.run(named.Store({"speeches": flat_speeches(rows, "c_mktsegment")}), "agg_speeches_by_party_year").aggregations["party_year"]
    return out.select(F.col("outer").alias("party"), F.col("inner").alias("year"), F.col("count").alias("n"), F.col("outer_count").alias("party_n"))


@query("""WITH u AS (
  SELECT 'speeches' AS grain, 'c' || conv_id || '-' || turn AS record_id, turn AS position FROM conversations WHERE conv_id = 3
  UNION ALL SELECT 'votes', 'e' || event_id, NULL FROM events WHERE user_id = 3)
SELECT grain, record_id, position FROM u ORDER BY position ASC NULLS LAST, record_id LIMIT 50""")
def n3_document_children(spark, sf):
    """Union of grains of one document, by position (missing last) and id."""
    a = table(spark, sf, "conversations").filter("conv_id = 3").select(F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("record_id"), F.col("turn").alias("position"))
    b = table(spark, sf, "events").filter("user_id = 3").select(F.concat(F.lit("e"), "event_id").alias("record_id"))
    return windows.paged(sets.union_grains({"speeches": a, "votes": b}).select("grain", "record_id", "position"), [F.asc_nulls_last("position"), F.asc("record_id")], 1, 50)


@query("SELECT o_orderkey AS record_id, o_totalprice AS published FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1996-05-03' AND o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def n5_documents_by_date(spark, sf):
    docs = table(spark, sf, "orders").select(F.col("o_orderkey").alias("record_id"), F.col("o_totalprice").alias("published"), F.col("o_orderstatus").alias("chamber"), F.to_date("o_orderdate").alias("session_date"))
    return named.run(named.Store({"documents": docs}), "list_documents_by_date", {"date": "1996-05-03", "chamber": "F"}).hits.select("record_id", "published")


@query("SELECT doc_id AS record_id, lang, source, n_chars FROM documents WHERE doc_id = 42")
def n4_point_lookup(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("record_id"), "lang", "source", "n_chars")
    return named.run(named.Store({"documents": docs}), "get_document", {"document_id": 42})


def flat_speeches(orders: DataFrame, party: str) -> DataFrame:
    """Orders as speeches of their customers."""
    who = F.struct(F.col("o_custkey").cast("string").alias("person_id"), F.lit("").alias("name_search"), F.col(party).alias("party_group_at_time"))
    return orders.select(F.col("o_orderkey").alias("record_id"), who.alias("speaker"), F.struct(F.array().cast("array<string>").alias("bills")).alias("refs"), (F.col("o_totalprice") >= 1000).alias("is_substantive"), F.col("o_orderstatus").alias("chamber"), F.year("o_orderdate").cast("long").alias("year"), F.to_date("o_orderdate").alias("session_date"))


@query("""SELECT 'chamber' AS facet, o_orderstatus AS key, count(*) AS count FROM orders WHERE o_custkey = 7 AND o_totalprice >= 1000 GROUP BY ALL
UNION ALL SELECT 'year', CAST(year(o_orderdate) AS VARCHAR), count(*) FROM orders WHERE o_custkey = 7 AND o_totalprice >= 1000 GROUP BY ALL
UNION ALL SELECT 'party', o_orderpriority, count(*) FROM orders WHERE o_custkey = 7 AND o_totalprice >= 1000 GROUP BY ALL""")
def n8_person_facets(spark, sf):
    """A person's facets."""
    page = named.run(named.Store({"speeches": flat_speeches(table(spark, sf, "orders"), "o_orderpriority")}), "person_page", {"person_slug": "7"})
    a, b, c = (page.aggregations[k].select(F.lit(k).alias("facet"), F.col("key").cast("string").alias("key"), "count") for k in ("chamber", "year", "party"))
    return a.union(b).union(c)


BM25_SQL = """
WITH f AS (SELECT {id} AS id, '{f}' AS field, {b} AS boost, regexp_extract_all(lower({f}), '[\\p{{L}}\\p{{N}}]+') AS t FROM {table}),
s AS (SELECT count(*) AS n, avg(len(t)) AS avg_dl FROM f WHERE len(t) > 0),
x AS (SELECT id, boost, len(t) AS dl, {tf} FROM f),
d AS (SELECT {df} FROM x),
r AS (SELECT id, boost * ({sum}) AS score FROM x, s, d WHERE {where})
"""


def bm25_sql(name: str, ident: str, column: str, terms: list[str], joiner: str, boost: float = 1.0) -> str:
    tf = ", ".join(f"len(list_filter(t, lambda w: w = '{w}')) AS tf_{i}" for i, w in enumerate(terms))
    df = ", ".join(f"count(*) FILTER (tf_{i} > 0) AS df_{i}" for i in range(len(terms)))
    part = " + ".join(f"CASE WHEN tf_{i} > 0 THEN ln(1 + (n - df_{i} + 0.5) / (df_{i} + 0.5)) * tf_{i} / (tf_{i} + 1.2 * (1 - 0.75 + 0.75 * dl / avg_dl)) ELSE 0 END" for i in range(len(terms)))
    where = f" {joiner} ".join(f"tf_{i} > 0" for i in range(len(terms)))
    return BM25_SQL.format(id=ident, f=column, b=boost, table=name, tf=tf, df=df, sum=part, where=where)


@query(bm25_sql("documents", "doc_id", "text", ["trash", "loser", "token"], "OR") + "SELECT id AS doc_id, round(score, 6) AS score FROM r ORDER BY r.score DESC, id LIMIT 20")
def n1a_bm25(spark, sf):
    scored = search.bm25(table(spark, sf, "documents"), "doc_id", {"text": 1.0}, "Trash loser TOKEN")
    return scored.orderBy(F.desc("score"), "doc_id").limit(20).select("doc_id", F.round("score", 6).alias("score"))


@query(bm25_sql("part", "p_partkey", "p_name", ["red", "widget"], "AND", 2.0) + "SELECT id AS p_partkey, round(score, 6) AS score FROM r ORDER BY r.score DESC, id LIMIT 20")
def n9_search_persons(spark, sf):
    """All words must stand in one field."""
    scored = search.bm25(table(spark, sf, "part"), "p_partkey", {"p_name": 2.0}, "red WIDGET", "and")
    return scored.orderBy(F.desc("score"), "p_partkey").limit(20).select("p_partkey", F.round("score", 6).alias("score"))


KNN_SQL = """WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id = 0),
k AS (SELECT vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), q.e) AS score FROM embeddings, q WHERE embedding IS NOT NULL)
"""


def first_vector(spark, sf) -> list[float]:
    return [float(x) for x in table(spark, sf, "embeddings").filter("vec_id = 0").select("embedding").first()[0]]


@query(KNN_SQL + "SELECT vec_id, round(score, 5) AS score FROM k ORDER BY k.score DESC, vec_id LIMIT 20")
def n1c_knn(spark, sf):
    return search.knn(table(spark, sf, "embeddings"), "vec_id", "embedding", first_vector(spark, sf), 20).select("vec_id", F.round("score", 5).alias("score"))


@query(bm25_sql("documents", "doc_id", "text", ["trash", "loser"], "OR") + "," + KNN_SQL[5:] + """,
a AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank FROM r QUALIFY rank <= 100),
b AS (SELECT vec_id AS id, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM k QUALIFY rank <= 100),
u AS (SELECT id, sum(1.0 / (60 + rank)) AS score FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY id)
SELECT id AS doc_id, round(CAST(score AS DOUBLE), 6) AS score FROM u ORDER BY u.score DESC, id LIMIT 20""")
def n1b_rrf(spark, sf):
    words = search.bm25(table(spark, sf, "documents"), "doc_id", {"text": 1.0}, "trash loser")
    near = search.knn(table(spark, sf, "embeddings"), "vec_id", "embedding", first_vector(spark, sf), 100).withColumnRenamed("vec_id", "doc_id")
    return search.fused([words, near], "doc_id").select("doc_id", F.round("score", 6).alias("score"))


# ---- filters

@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1996-01-31' AND o_orderstatus = 'O' AND o_totalprice >= 100000")
def f1_filter_bundle(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey"), F.col("o_orderdate").alias("session_date"), F.col("o_orderstatus").alias("chamber"), (F.col("o_totalprice") >= 100000).alias("is_substantive"))
    return search.filtered(rows, chamber="O", date_from="1996-01-01", date_to="1996-01-31").select("o_orderkey")


@query("SELECT doc_id FROM documents WHERE lang IN ('fr', 'de') AND length(text) BETWEEN 100 AND 800")
def f3_any_of(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.array("lang").alias("topics"), F.length("text").between(100, 800).alias("is_substantive"))
    return search.filtered(rows, topics=["fr", "de"]).select("doc_id")


# ---- text functions

@query(r"SELECT doc_id, substr(sha256(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))), 1, 12) AS fingerprint FROM documents")
def t8_fingerprint(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.fingerprint(F.col("text")).alias("fingerprint"))


@query(r"SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda w: w <> '')) AS words FROM documents")
def t11_word_count(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.words(F.col("text")).cast("long").alias("words"))


@query(r"SELECT doc_id, CASE WHEN length(t) > 200 THEN substr(t, 1, 199) || '…' ELSE t END AS preview FROM (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS t FROM documents)")
def t12_preview(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.preview(F.col("text")).alias("preview"))


@query(rf"SELECT doc_id, sha256(regexp_replace(translate(text, '{text.MARKED}', '{text.PLAIN}'), '[\x{{0300}}-\x{{036f}}\x{{fffd}}]', '', 'g')) AS folded_sha256 FROM documents")
def t1_fold_whole(spark, sf):
    """The fold of whole texts, as a digest."""
    return table(spark, sf, "documents").select("doc_id", F.sha2(text.fold(F.col("text")), 256).alias("folded_sha256"))


@query("""SELECT a.p_name AS a, b.p_name AS b, least(levenshtein(a.p_name, b.p_name), 4) AS distance
FROM (SELECT DISTINCT p_name FROM part) a JOIN (SELECT DISTINCT p_name FROM part) b ON substr(a.p_name, 1, 3) = substr(b.p_name, 1, 3) AND a.p_name < b.p_name""")
def t6_levenshtein(spark, sf):
    names = table(spark, sf, "part").select("p_name").distinct()
    a, b = names.select(F.col("p_name").alias("a")), names.select(F.col("p_name").alias("b"))
    return a.join(b, (F.substring("a", 1, 3) == F.substring("b", 1, 3)) & (F.col("a") < F.col("b"))).select("a", "b", text.capped_distance(F.col("a"), F.col("b"), 3).cast("long").alias("distance"))


@query("""WITH t AS (SELECT p_partkey, list_distinct(regexp_extract_all(lower(p_name), '[\\p{L}\\p{N}_]+')) AS a, list_distinct(regexp_extract_all(lower(p_brand || ' ' || p_name), '[\\p{L}\\p{N}_]+')) AS b FROM part)
SELECT p_partkey, CASE WHEN least(len(a), len(b)) > 0 THEN len(list_intersect(a, b)) / least(len(a), len(b)) ELSE 0 END AS ratio FROM t""")
def t10_overlap(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", text.tokens(F.col("p_name")).alias("a"), text.tokens(F.concat_ws(" ", "p_brand", "p_name")).alias("b"))
    return rows.select("p_partkey", text.overlap(F.col("a"), F.col("b")).alias("ratio"))


@query(r"SELECT doc_id, 1 + length(substr(text, 1, n_chars // 2)) - length(replace(substr(text, 1, n_chars // 2), chr(10), '')) AS line FROM documents")
def t13_line_number(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.line_of(F.col("text"), F.floor(F.col("n_chars") / 2)).cast("long").alias("line"))


# ---- sources

@query(r"""WITH m AS (SELECT page_id, list_distinct(list_transform(regexp_extract_all(html, '<a href="/[^"]*">'), lambda x: regexp_extract(x, '"/([^"]*)"', 1))) AS l FROM pages)
SELECT page_id, unnest(l) AS href FROM m""")
def s2_first_links(spark, sf):
    return parsers.links(table(spark, sf, "pages"), "html", r'<a href="/([^"]*)">', ["href"], ["href"]).select("page_id", "href")


@query("SELECT strftime(d, '%Y-%m-%d') AS day FROM range(DATE '2024-01-01', DATE '2024-03-02', INTERVAL 1 DAY) t(d)")
def s3_days(spark, sf):
    return parsers.days(spark, "2024-01-01", "2024-03-01", reverse=True).select(F.date_format("day", "yyyy-MM-dd").alias("day"))


@query(r"""SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?m)^\*\*==> picture \[[^\]]+\] intentionally omitted <==\*\*\s*\n', '', 'g'), '(?m)^\s*MONITORUL\s+OFICIAL\s+AL\s+ROM[ÂA]NIEI[^\n]*\n', '', 'g'),
  '(?m)^\s*\d{1,3}\s*\n', '', 'g'), '([\p{L}\p{N}_])-\n([\p{L}\p{N}_])', '\1\2', 'g'), '(?m)[ \t]+$', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') || chr(10)) AS cleaned FROM documents""")
def s7_clean(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2(rules.clean_markdown(F.col("text")), 256).alias("cleaned"))


# ---- joins

@query("""WITH d AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, min_by(o_orderkey, struct_pack(p := CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, k := o_orderkey)) AS k FROM orders GROUP BY 1)
SELECT l_orderkey, l_linenumber, d.k AS session FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate FROM lineitem) l LEFT JOIN d ON d.day = strftime(l_shipdate, '%Y-%m-%d')""")
def j1_report_to_session_all(spark, sf):
    """Date lookup of every line."""
    orders = table(spark, sf, "orders").withColumn("day", day("o_orderdate"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").distinct().withColumn("day", day("l_shipdate"))
    priority = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return joins.dated_lookup(lines, orders, "day", priority, "o_orderkey", "o_orderkey", "session").select("l_orderkey", "l_linenumber", "session")


J2_SQL = """s AS (SELECT a.o_orderkey, min_by(b.o_orderkey, struct_pack(d := b.o_orderdate, k := b.o_orderkey)) AS successor FROM orders a JOIN orders b
  ON a.o_custkey = b.o_custkey AND b.o_orderdate > a.o_orderdate AND date_diff('day', a.o_orderdate, b.o_orderdate) <= 60 GROUP BY 1)"""


@query(f"WITH {J2_SQL} SELECT o.o_orderkey, s.successor FROM orders o LEFT JOIN s USING (o_orderkey)")
def j2_vote_forward_link(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"))
    return joins.earliest_successor(rows, "o_custkey", "d", "o_orderkey", 60).select("o_orderkey", "successor")


@query(f"""WITH RECURSIVE {J2_SQL}, l AS (SELECT s.o_orderkey AS a, s.successor AS b FROM s JOIN orders o USING (o_orderkey) WHERE o.o_orderstatus = 'P'),
c AS (SELECT a, b, 1 AS hops FROM l UNION ALL SELECT c.a, l.b, c.hops + 1 FROM c JOIN l ON c.b = l.a)
SELECT a AS source, max_by(b, hops) AS "end", CAST(max(hops) AS BIGINT) AS hops FROM c GROUP BY a""")
def j3_deferral_chain(spark, sf):
    """Deferred votes followed to the first that is not deferred."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("d"))
    links = joins.earliest_successor(rows, "o_custkey", "d", "o_orderkey", 60).filter("o_orderstatus = 'P' AND successor IS NOT NULL")
    return joins.chain_ends(links, "o_orderkey", "successor")


@query("""SELECT e.event_id, h.event_id AS header FROM (SELECT * FROM events WHERE event_type <> 'signup') e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') h ON e.user_id = h.user_id AND e.ts >= h.ts""")
def j14_as_of(spark, sf):
    """The last header at or before each row."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    headers = events.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("header"))
    return joins.as_of(events.filter("event_type <> 'signup'"), headers, "user_id", "ts", "at", ["header"]).select("event_id", "header")


@query("""WITH p AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) WHEN 2 THEN replace(lower(n_name), '_', ' ') ELSE 'none ' || c_custkey END AS raw FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, coalesce(a.n_nationkey, b.n_nationkey, c.n_nationkey) AS match, CASE WHEN a.n_nationkey IS NOT NULL THEN 'exact' WHEN b.n_nationkey IS NOT NULL THEN 'case' WHEN c.n_nationkey IS NOT NULL THEN 'token_set' END AS via
FROM p LEFT JOIN nation a ON p.raw = a.n_name LEFT JOIN nation b ON lower(p.raw) = lower(b.n_name) LEFT JOIN nation c ON replace(lower(p.raw), '_', ' ') = replace(lower(c.n_name), '_', ' ')""")
def j8_lookup_cascade(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name").withColumn("seq", F.col("n_nationkey"))
    raw = F.expr("CASE c_custkey % 4 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) WHEN 2 THEN replace(lower(n_name), '_', ' ') ELSE concat('none ', c_custkey) END")
    probe = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", raw.alias("raw"))
    bag = lambda c: F.array_join(F.array_sort(F.split(F.replace(F.lower(c), F.lit("_"), F.lit(" ")), " ")), " ")
    tiers = {"exact": (F.col("raw"), F.col("n_name")), "case": (F.lower("raw"), F.lower("n_name")), "token_set": (bag(F.col("raw")), bag(F.col("n_name")))}
    return joins.lookup_cascade(probe, nation, "raw", "n_name", "n_nationkey", tiers).select("c_custkey", "match", "via")


@query("""WITH r AS (SELECT DISTINCT p_type || ' ' || p_name || ' ' || p_brand AS raw FROM part), a AS (SELECT DISTINCT p_type || ' ' || split_part(p_name, ' ', 1) AS alias FROM part UNION SELECT DISTINCT p_type FROM part),
n AS (SELECT alias, row_number() OVER (ORDER BY alias) AS id FROM a)
SELECT raw, max_by(n.id, length(n.alias)) AS match FROM r LEFT JOIN n ON r.raw = n.alias OR starts_with(r.raw, n.alias || ' ') GROUP BY raw""")
def j9_longest_prefix_all(spark, sf):
    """Longest of the aliases of all parts."""
    from pyspark.sql import Window

    part = table(spark, sf, "part")
    raws = part.select(F.concat_ws(" ", "p_type", "p_name", "p_brand").alias("raw")).distinct()
    alias = part.select(F.concat_ws(" ", "p_type", F.substring_index("p_name", " ", 1)).alias("alias")).union(part.select("p_type")).distinct()
    return joins.longest_prefix(raws, alias.withColumn("id", F.row_number().over(Window.orderBy("alias")).cast("long")), "raw", "alias", "id").select("raw", "match")


@query("""SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'right' WHEN l.doc_id IS NULL THEN 'left' ELSE 'both' END AS place
FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id % 3 <> 0) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)""")
def j16_gold_and_candidate(spark, sf):
    return joins.key_report(table(spark, sf, "documents").filter("doc_id % 3 <> 0"), table(spark, sf, "labels"), "doc_id")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def j18_orphans(spark, sf):
    new = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.orphans(table(spark, sf, "customer").select("c_custkey"), new, "c_custkey")


@query("""SELECT event_id FROM events v WHERE event_type = 'view' AND NOT EXISTS (SELECT 1 FROM events c WHERE c.event_type = 'click' AND c.user_id = v.user_id AND abs(CAST(floor(epoch(c.ts)) AS BIGINT) - CAST(floor(epoch(v.ts)) AS BIGINT)) <= 7200)""")
def j20_unclaimed_headers(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", seconds("ts").alias("at"))
    clicks = events.filter("event_type = 'click'").select("user_id", F.col("at").alias("claim"))
    return joins.unclaimed(events.filter("event_type = 'view'").select("event_id", "user_id", "at"), clicks, "user_id", "at", "claim", 7200).select("event_id")


# ---- aggregations

@query("SELECT coalesce(source, '(unknown)') AS key, count(*) AS count FROM documents GROUP BY 1 ORDER BY count DESC, key LIMIT 8")
def a1_terms(spark, sf):
    return aggregates.terms(table(spark, sf, "documents"), F.col("source"), 8, "(unknown)")


@query("""WITH c AS (SELECT source AS "outer", lang AS "inner", count(*) AS count FROM documents GROUP BY ALL), t AS (SELECT "outer", CAST(sum(count) AS BIGINT) AS outer_count FROM c GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
SELECT c.*, outer_count FROM c JOIN t USING ("outer")""")
def a2_nested_terms(spark, sf):
    return aggregates.nested_terms(table(spark, sf, "documents"), F.col("source"), F.col("lang"), 5)


@query("""SELECT lang, count(*) AS total, count(quality) AS coded, 100.0 * count(quality) / count(*) AS coded_pct, count(*) FILTER (toxic > 0) AS marked, 100.0 * count(*) FILTER (toxic > 0) / count(*) AS marked_pct
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""")
def a6_coverage(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return aggregates.coverage(rows, [F.col("lang")], coded=F.col("quality").isNotNull(), marked=F.coalesce(F.col("toxic") > 0, F.lit(False)))


@query("""SELECT lang, count(*) FILTER (quality = toxic) AS matches, count(*) AS total, count(*) FILTER (quality = toxic) / count(*) AS rate, CAST(sum(abs(quality - toxic)) AS BIGINT) AS abs_delta, avg(abs(quality - toxic)) AS mean_abs_delta, CAST(0 AS BIGINT) AS null_pairs
FROM documents JOIN labels USING (doc_id) GROUP BY lang""")
def a8_agreement(spark, sf):
    return aggregates.agreement(table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id"), "quality", "toxic", ["lang"])


@query("""WITH c AS (SELECT coalesce(source, '(unknown)') AS "group", quality AS value, count(*) AS count FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY ALL)
SELECT *, count / sum(count) OVER (PARTITION BY "group") AS share FROM c""")
def a13_shares(spark, sf):
    return aggregates.shares(table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id"), F.col("source"), "quality")


@query("SELECT * FROM (SELECT source, CAST(sum(quality + 2 * toxic) AS BIGINT) AS weighted, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY source ORDER BY weighted DESC, n DESC, source LIMIT 10) WHERE weighted <> 0")
def a14_top_speakers(spark, sf):
    return aggregates.weighted_top(table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id"), "source", F.col("quality") + 2 * F.col("toxic"), 10)


@query("SELECT count(l_discount) AS n, round(avg(l_discount), 9) AS mean, median(l_discount) AS median, min(l_discount) AS least, max(l_discount) AS most, count(*) FILTER (l_discount < 0.05) / count(l_discount) AS share_below FROM lineitem")
def a15_distribution(spark, sf):
    return aggregates.distribution(table(spark, sf, "lineitem"), "l_discount", 0.05).withColumn("mean", F.round("mean", 9))


@query("SELECT l_returnflag, quantile_cont(l_extendedprice, 0.1) AS p10, quantile_cont(l_extendedprice, 0.75) AS p75 FROM lineitem GROUP BY 1")
def a16_percentile_linear(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(aggregates.percentile_linear("l_extendedprice", 0.1).alias("p10"), aggregates.percentile_linear("l_extendedprice", 0.75).alias("p75"))


@query("WITH r AS (SELECT o_orderstatus, o_totalprice, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) AS r, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders) SELECT o_orderstatus, max(o_totalprice) FILTER (r = floor(n * 0.5) + 1) AS p50, max(o_totalprice) FILTER (r = floor(n * 0.9) + 1) AS p90 FROM r GROUP BY 1")
def a17_percentile_index(spark, sf):
    return aggregates.percentile_index(table(spark, sf, "orders"), "o_totalprice", {"p50": 0.5, "p90": 0.9}, ["o_orderstatus"])


@query("""SELECT b AS bucket, coalesce(count, 0) AS count FROM (SELECT CAST(range AS INTEGER) AS b FROM range(6)) LEFT JOIN
(SELECT CAST(o_totalprice >= 50000 AS INT) + CAST(o_totalprice >= 100000 AS INT) + CAST(o_totalprice >= 200000 AS INT) + CAST(o_totalprice >= 300000 AS INT) + CAST(o_totalprice >= 400000 AS INT) AS k, count(*) AS count FROM orders GROUP BY 1) ON k = b""")
def a19_histogram(spark, sf):
    return aggregates.histogram(table(spark, sf, "orders"), "o_totalprice", (50_000, 100_000, 200_000, 300_000, 400_000))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 15")
def a20_bottom(spark, sf):
    return aggregates.bottom(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


@query("""WITH f AS (SELECT source, lang, min(doc_id) AS o, count(*) AS n FROM documents GROUP BY ALL)
SELECT source, CAST(sum(n) AS BIGINT) AS count, array_to_string((list(lang ORDER BY o))[1:3], ',') AS first_values FROM f GROUP BY source""")
def a22_first_seen(spark, sf):
    out = aggregates.first_seen(table(spark, sf, "documents"), ["source"], "doc_id", "lang")
    return out.withColumn("first_values", F.array_join("first_values", ","))


@query("SELECT array_to_string(list_sort(string_split(p_name, ' ')), '+') AS cluster, count(*) AS total, array_to_string(list_sort(list_distinct(list(p_name))), '|') AS raws, min(p_size) AS min_year, max(p_size) AS max_year FROM part GROUP BY 1")
def a23_clusters(spark, sf):
    key = F.array_join(F.array_sort(F.split("p_name", " ")), "+")
    return aggregates.clusters(table(spark, sf, "part"), key, "p_name", "p_size").withColumn("raws", F.array_join("raws", "|"))


@query("SELECT o_orderstatus, count(*) FILTER (o_orderpriority = '1-URGENT') AS \"1-URGENT\", count(*) FILTER (o_orderpriority = '2-HIGH') AS \"2-HIGH\", count(*) FILTER (o_orderpriority = '5-LOW') AS \"5-LOW\" FROM orders GROUP BY 1")
def a27_crosstab(spark, sf):
    return aggregates.crosstab(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])


@query("SELECT year(o_orderdate) AS year, count(*) AS n, round(avg(o_totalprice), 6) AS mean FROM orders GROUP BY 1")
def a28_date_histogram(spark, sf):
    return aggregates.by_year(table(spark, sf, "orders"), "o_orderdate", "o_totalprice").withColumn("mean", F.round("mean", 6))


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS count FROM events GROUP BY ALL)
SELECT user_id, event_type, count, count / sum(count) OVER (PARTITION BY user_id) AS share FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count DESC, event_type) = 1""")
def a30_dominant(spark, sf):
    return aggregates.dominant(table(spark, sf, "events"), ["user_id"], "event_type")


@query("SELECT 'no_negative' AS probe, min(o_totalprice) >= 0 AS passed FROM orders UNION ALL SELECT 'all_dated', count(*) = count(o_orderdate) FROM orders UNION ALL SELECT 'mostly_urgent', count(*) FILTER (o_orderpriority = '1-URGENT') / count(*) > 0.5 FROM orders")
def a26_probes(spark, sf):
    return aggregates.probes(table(spark, sf, "orders"), no_negative=F.min("o_totalprice") >= 0, all_dated=F.count("*") == F.count("o_orderdate"), mostly_urgent=F.count_if(F.col("o_orderpriority") == "1-URGENT") / F.count("*") > 0.5)


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def x_rollup(spark, sf):
    return table(spark, sf, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"), F.count("*").alias("n"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def x_cube(spark, sf):
    return table(spark, sf, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


# ---- windows and samples

@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS seq FROM conversations")
def w2_sequence(spark, sf):
    return windows.sequence_within(table(spark, sf, "conversations"), ["conv_id", "role"], F.col("turn")).select("conv_id", "turn", F.col("seq").cast("long").alias("seq"))


@query("SELECT p_partkey, CASE WHEN n > 1 THEN p_name || '-' || n ELSE p_name END AS unique_key FROM (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS n FROM part)")
def w3_suffix(spark, sf):
    return windows.suffixed(table(spark, sf, "part"), "p_name", F.col("p_partkey")).select("p_partkey", "unique_key")


@query("SELECT event_id, coalesce(lead(s) OVER (PARTITION BY user_id ORDER BY s), 1800000000) AS \"end\" FROM (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s, min(event_id) AS event_id FROM events GROUP BY ALL)")
def w4_next_boundary(spark, sf):
    rows = table(spark, sf, "events").groupBy("user_id", seconds("ts").alias("s")).agg(F.min("event_id").alias("event_id"))
    return windows.next_boundary(rows, ["user_id"], "s", F.lit(1_800_000_000).cast("long")).select("event_id", "end")


SPANS_SQL = "e AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s, CAST(floor(epoch(ts)) AS BIGINT) + 3600 * (1 + event_id % 9) AS t FROM events)"


def spans(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select("user_id", seconds("ts").alias("s"), (seconds("ts") + 3600 * (1 + F.col("event_id") % 9)).alias("t"))


@query(f"WITH {SPANS_SQL}, o AS (SELECT user_id, s, max(t) AS t FROM e GROUP BY ALL) SELECT user_id, s, least(t, coalesce(lead(s) OVER (PARTITION BY user_id ORDER BY s), t)) AS t FROM o")
def w5_overlap_clip(spark, sf):
    return windows.clipped(spans(spark, sf), ["user_id"], "s", "t")


ISLANDS_SQL = f"""{SPANS_SQL}, m AS (SELECT *, max(t) OVER (PARTITION BY user_id ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, t ROWS UNBOUNDED PRECEDING) AS island FROM m),
i AS (SELECT user_id, min(s) AS s, max(t) AS t FROM g GROUP BY user_id, island)"""


@query(f"WITH {ISLANDS_SQL} SELECT * FROM i")
def w7_interval_union(spark, sf):
    return windows.merged_intervals(spans(spark, sf), ["user_id"], "s", "t")


@query(f"WITH {ISLANDS_SQL} SELECT user_id, t AS gap_start, n AS gap_end FROM (SELECT *, lead(s) OVER (PARTITION BY user_id ORDER BY s) AS n FROM i) WHERE n - t >= 7200")
def w7_gaps(spark, sf):
    return windows.gaps(windows.merged_intervals(spans(spark, sf), ["user_id"], "s", "t"), ["user_id"], "s", "t", 7200)


@query("SELECT event_id FROM (SELECT event_id, value, max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM events) WHERE value < top")
def w8_out_of_order(spark, sf):
    return windows.out_of_order(table(spark, sf, "events"), ["user_id"], "event_id", "value").select("event_id")


@query("SELECT doc_id FROM documents ORDER BY md5('s:' || doc_id), doc_id LIMIT 50")
def w12_sample(spark, sf):
    return windows.sampled(table(spark, sf, "documents").select("doc_id"), "doc_id", 50)


@query("""WITH d AS (SELECT o_orderkey, year(o_orderdate) AS y, md5('s:' || o_orderkey) AS d FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY d, o_orderkey) <= greatest(1, 100 // (SELECT count(DISTINCT y) FROM d)) AS f FROM d)
SELECT o_orderkey FROM r ORDER BY f DESC, d, o_orderkey LIMIT 100""")
def w13_year_stratified(spark, sf):
    return windows.stratified(table(spark, sf, "orders"), "o_orderkey", F.year("o_orderdate"), 100).select("o_orderkey")


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 2")
def w15_top_per_speaker(spark, sf):
    return windows.top_per(table(spark, sf, "orders"), ["o_custkey"], 2, F.desc("o_totalprice"), F.col("o_orderkey")).select("o_custkey", "o_orderkey")


# ---- sets

@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def u3_intersection(spark, sf):
    return sets.shared_keys(table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")), "k")


@query("""WITH a AS (SELECT doc_id FROM documents WHERE doc_id % 2 = 0), b AS (SELECT doc_id FROM labels)
(SELECT doc_id, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) UNION ALL (SELECT doc_id, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a))""")
def u4_difference(spark, sf):
    return sets.both_ways(table(spark, sf, "documents").filter("doc_id % 2 = 0").select("doc_id"), table(spark, sf, "labels").select("doc_id"))


@query("""WITH r AS (SELECT lower(p_name) AS k, p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END AS role FROM part)
SELECT k, min(p_partkey) AS p_partkey, arg_min(role, p_partkey) FILTER (role IS NOT NULL) AS role FROM r GROUP BY k""")
def u6_roster_merge(spark, sf):
    rows = table(spark, sf, "part").select(F.lower("p_name").alias("k"), "p_partkey", F.when(F.col("p_size") % 3 != 0, F.col("p_brand")).alias("role"))
    return sets.merged_by_priority(rows, F.col("k"), "p_partkey", ["role"])


# ---- nested projection

# ---- lifecycle

@query("""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 2 = 0""")
def i1_upsert(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"))
    old, new = orders.filter("o_orderkey % 2 = 0"), orders.filter("o_orderkey % 3 = 0").withColumn("price", F.col("price") + 1)
    return lifecycle.upserted(old, new, ["o_orderkey"])


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 4 <> 0 GROUP BY ALL
UNION ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 4 = 0 AND l_linenumber <= 2 GROUP BY ALL""")
def i2_orphan_delete(spark, sf):
    """Re-indexed documents lose the children that they no longer have."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    new = lines.filter("l_orderkey % 4 = 0 AND l_linenumber <= 2")
    old = lines.join(new.select("l_orderkey").distinct(), "l_orderkey", "left_semi").union(lines.filter("l_orderkey % 4 <> 0"))
    return lifecycle.upserted(old, new, ["l_orderkey", "l_linenumber"], "l_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0 OR o_orderstatus = 'P'")
def i1_changed(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("sha"))
    state = rows.filter("o_orderkey % 5 = 0").withColumn("sha", F.when(F.col("sha") == "P", "old").otherwise(F.col("sha")))
    return lifecycle.changed(rows, state, "o_orderkey", ["sha"]).select("o_orderkey")


@query("SELECT o_custkey, sha256(string_agg(o_orderkey || '|' || o_orderstatus, chr(10) ORDER BY o_orderkey || '|' || o_orderstatus)) AS digest FROM orders GROUP BY 1")
def s14_enrichment_fingerprint(spark, sf):
    return lifecycle.lines_digest(table(spark, sf, "orders"), ["o_custkey"], F.concat_ws("|", "o_orderkey", "o_orderstatus"))


# ---- rankings

@query("""SELECT source AS person_id, count(*) AS speeches, CAST(sum(n_chars) AS BIGINT) AS words, CAST(sum(toxic) AS DOUBLE) AS total, avg(toxic) AS mean, quantile_cont(toxic, 0.75) AS p75, 1000.0 * sum(toxic) / sum(n_chars) AS per_kword,
rank() OVER (ORDER BY 1000.0 * sum(toxic) / sum(n_chars) DESC) AS rank_rate, rank() OVER (ORDER BY avg(toxic) DESC) AS rank_mean, rank() OVER (ORDER BY quantile_cont(toxic, 0.75) DESC) AS rank_p75
FROM documents JOIN labels USING (doc_id) GROUP BY source HAVING count(*) >= 10 AND sum(n_chars) >= 5000""")
def r_most_populist(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(F.col("source").alias("person_id"), F.col("n_chars").alias("words"), "toxic")
    out = rankings.ranked(rows, F.col("toxic"))
    return out.withColumns({c: F.col(c).cast("long") for c in ("rank_rate", "rank_mean", "rank_p75")})


# ---- classification rules

@query("""SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)extraordinar') THEN 'extraordinary' WHEN regexp_matches(text, '(?i)ordinar') THEN 'ordinary' END AS session_type FROM documents""")
def x31_session_type(spark, sf):
    return table(spark, sf, "documents").select("doc_id", rules.session_type(F.col("text")).alias("session_type"))


# ---- streaming, on what is there now

@query("SELECT epoch_ms(CAST(epoch_ms(time_bucket(INTERVAL 1 HOUR, ts)) AS BIGINT)) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def st_tumbling(spark, sf):
    return _drained(spark, sf, lambda s, e: s.tumbling(e), "complete").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def st_once_each(spark, sf):
    return _drained(spark, sf, lambda s, e: s.once_each(e.select("user_id", "event_type", "ts"), ["user_id", "event_type"], "60 days"), "append").select("user_id", "event_type")


def _drained(spark, sf, build, mode) -> DataFrame:
    import uuid

    from lectern.functions.session import shared_folder
    from lectern.streaming import streams

    path = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    return streams.drained(build(streams, streams.events(spark, f"{sf}/events.parquet")), f"{path}/rows", f"{path}/checkpoint", mode)


from lectern import grain_queries as _more  # noqa: E402,F401  registers its queries
from lectern import rule_queries as _rules  # noqa: E402,F401
