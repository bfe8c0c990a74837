"""The queries of this subpackage, as (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import chat_format, mixing, ngram_join, packing, quality_rules, secrets, sketch, topk_nra, toxicity, warc_writer
from lectern.llm.common import fold, read_table, scratch


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.digests(chat_format.format_rows(rows))


OP1_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
mapped AS (
  SELECT conv_id, turn, text, CASE lower(role) WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'bot' THEN 'assistant' WHEN 'model' THEN 'assistant' ELSE role END AS role FROM rows),
sized AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '\### ') AS escaped,
    replace(replace(replace(replace(role, '\', '\\'), '</turn>', '<\/turn>'), '### ', '\### '), ':', '\:') AS escaped_role FROM mapped)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(4 + length(escaped_role) + 2 + length(escaped) + 8) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc_writer.write(read_table(spark, sf_dir, "pages"), path)
    return warc_writer.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.compare_edited(read_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, read_table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return rules.score(docs.select("doc_id", "text")).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= quality_rules.THRESHOLD).cast("int").alias("predicted"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_documents(read_table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    line = lambda array: F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in secrets.BASE_KINDS), F.sha2(line(base), 256).alias("base_sha256"), line(F.col("found")).alias("spans"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "lang", "topic", "tokens", F.round("ratio", 6).alias("ratio"), F.round("probability", 6).alias("probability"), "kept")


def op7_mixing_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op7_mixing, with probabilities that keep a stated share of the tokens."""
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"), budget=mixing.BUDGET)
    return mixed.select("doc_id", "source", "lang", "topic", "tokens", F.round("ratio", 6).alias("ratio"), F.round("probability", 6).alias("probability"), "kept")


def op7_sql() -> str:
    """Raking unrolled: one CTE a round and marginal."""
    steps, last = [], "cells"
    for k in range(mixing.ROUNDS):
        for m in mixing.MARGINALS:
            name = f"w_{k}_{m}"
            steps.append(f"{name} AS (SELECT c.source, c.lang, c.topic, c.tokens, c.weight * t.share * (SELECT sum(tokens) FROM cells) / sum(c.weight) OVER (PARTITION BY c.{m}) AS weight FROM {last} c JOIN t_{m} t ON c.{m} IS NOT DISTINCT FROM t.value)")
            last = name
    targets = [f"s_{m} AS (SELECT {m} AS value, pow(CAST(sum(tokens) AS DOUBLE), {mixing.TEMPER}) AS free FROM cells GROUP BY 1), t_{m} AS (SELECT value, free / sum(free) OVER () AS share FROM s_{m})" for m in mixing.MARGINALS]
    return rf"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents),
rows AS (SELECT doc_id, source, lang, greatest(len(regexp_extract_all(text, '\S+')), 1) AS tokens,
  CASE WHEN contains(text, '://') OR contains(text, '@') THEN 'addressed' WHEN regexp_matches(text, '[0-9]{{4}}') THEN 'numeric' WHEN length(text) < 400 THEN 'short'
  WHEN (length(text) - length(replace(text, chr(10), '')) + 1) * 200 > length(text) THEN 'listed' WHEN length(text) >= 6000 THEN 'long' ELSE 'prose' END AS topic FROM d),
cells AS (SELECT source, lang, topic, sum(tokens) AS tokens, CAST(sum(tokens) AS DOUBLE) AS weight FROM rows GROUP BY ALL),
{", ".join(targets)},
{", ".join(steps)},
r AS (SELECT source, lang, topic, weight / tokens AS ratio, max(weight / tokens) OVER () AS most FROM {last})
SELECT rows.doc_id, rows.source, rows.lang, rows.topic, CAST(rows.tokens AS BIGINT) AS tokens, round(r.ratio, 6) AS ratio, round(least(1.0, greatest({mixing.FLOOR}, r.ratio / r.most)), 6) AS probability,
  CAST('0x' || substr(md5('17:' || rows.doc_id), 1, 13) AS BIGINT) / 4503599627370496.0 < least(1.0, greatest({mixing.FLOOR}, r.ratio / r.most)) AS kept
FROM rows JOIN r ON rows.source IS NOT DISTINCT FROM r.source AND rows.lang IS NOT DISTINCT FROM r.lang AND rows.topic = r.topic
"""


def op7_budget_sql() -> str:
    """The raking of op7_sql. The factor is the largest that any set of cells at one leaves, cells taken by ratio."""
    last = f"w_{mixing.ROUNDS - 1}_{mixing.MARGINALS[-1]}"
    raking = op7_sql().partition("r AS (SELECT source, lang, topic, weight / tokens AS ratio")[0]
    return raking + rf"""
r AS (SELECT source, lang, topic, tokens, weight, weight / tokens AS ratio FROM {last}),
s AS (SELECT sum(tokens) OVER () AS all_tokens, sum(tokens) OVER (ORDER BY ratio) AS free_tokens, sum(weight) OVER (ORDER BY ratio) AS free FROM r),
f AS (SELECT max(({mixing.BUDGET} * all_tokens - (all_tokens - free_tokens)) / free) AS factor FROM s)
SELECT rows.doc_id, rows.source, rows.lang, rows.topic, CAST(rows.tokens AS BIGINT) AS tokens, round(r.ratio, 6) AS ratio, round(least(1.0, r.ratio * f.factor), 6) AS probability,
  CAST('0x' || substr(md5('17:' || rows.doc_id), 1, 13) AS BIGINT) / 4503599627370496.0 < least(1.0, r.ratio * f.factor) AS kept
FROM rows JOIN r ON rows.source IS NOT DISTINCT FROM r.source AND rows.lang IS NOT DISTINCT FROM r.lang AND rows.topic = r.topic CROSS JOIN f
"""


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(read_table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
r AS (SELECT doc_id AS d, doc_id AS c FROM s UNION SELECT r.d, e.b FROM r JOIN e ON r.c = e.a)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, m.c AS component_id FROM s JOIN (SELECT d, min(c) AS c FROM r GROUP BY d) m ON m.d = s.doc_id
"""


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_nra.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    scored = docs.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_warc, op3_sketch, op4_quality, op5_secrets, op6_packing, op7_mixing, op7_mixing_budget, op8_ngram_join, op9_topk, op10_toxicity)}
ORACLE_SQL = {"op1_chat_format": OP1_SQL, "op7_mixing": op7_sql(), "op7_mixing_budget": op7_budget_sql(), "op8_ngram_join": OP8_SQL, "op9_topk": OP9_SQL}
