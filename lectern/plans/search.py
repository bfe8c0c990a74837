"""BM25, vector and fused search over frames.

Term statistics are those of the whole table, whatever the filters. Postings of the query's terms alone are kept: texts are tokenised once, terms that the query lacks go at once, and document lengths and counts come from the same pass.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lectern.functions.session import shared_folder, spread
from lectern.functions.text import analyzed
from lectern.operators.windows import page_bounds

# The parameters of BM25 and of rank fusion.
K1, B = 1.2, 0.75
RRF = 60


def query_terms(df: DataFrame, q: str) -> list[str]:
    """The analysed terms of a query, once each."""
    row = df.sparkSession.range(1).select(F.array_distinct(analyzed(F.lit(q))).alias("t")).first()
    return list(row.t)


def _times(array: str, word: str) -> Column:
    return F.size(F.filter(array, lambda t: t == word))


def _counted(lists: DataFrame, fields: list[str], terms: int) -> DataFrame:
    """The rows that hold a term, with their field's statistics. Texts are read once: the rows are written, and what is counted on the way comes with the job, a few numbers a field."""
    spark = lists.sparkSession
    own = lambda f, c: F.count_if((F.col("field") == f) & c)
    counts = []
    for k, f in enumerate(fields):
        counts += [own(f, F.col("dl") > 0).alias(f"n_{k}"), F.coalesce(F.sum(F.when(F.col("field") == f, F.col("dl"))), F.lit(0)).alias(f"dl_{k}"), *(own(f, F.col(f"tf_{i}") > 0).alias(f"df_{k}_{i}") for i in range(terms))]
    seen = Observation()
    path = f"{shared_folder(spark)}/postings-{uuid.uuid4().hex}"
    some = reduce(lambda a, b: a | b, (F.col(f"tf_{i}") > 0 for i in range(terms)))
    lists.observe(seen, *counts).filter(some).write.parquet(path)
    got = seen.get
    stats = F.create_map(*(x for k, f in enumerate(fields) for x in (F.lit(f), F.struct(F.lit(got[f"n_{k}"]).alias("n"), F.lit(got[f"dl_{k}"] / got[f"n_{k}"] if got[f"n_{k}"] else 1.0).alias("avg_dl"), *(F.lit(got[f"df_{k}_{i}"]).alias(f"df_{i}") for i in range(terms))))))
    return spark.read.schema(lists.schema).parquet(path).withColumn("_s", stats[F.col("field")]).select(*lists.columns, "_s.*")


def bm25(df: DataFrame, ident: str, fields: dict[str, float], q: str, operator: str = "or") -> DataFrame:
    """(id, score): the best boosted field's sum over query terms; `and` asks that one field holds all terms."""
    wanted = query_terms(df, q)
    if not wanted:
        return df.select(ident, F.lit(0.0).alias("score"))
    lists = spread(df.select(ident, *fields)).select(ident, F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.lit(float(b)).alias("boost"), analyzed(F.coalesce(F.col(f), F.lit(""))).alias("t")) for f, b in fields.items()))).alias("x"))
    lists = lists.select(ident, "x.field", "x.boost", F.size("x.t").alias("dl"), *(_times("x.t", w).alias(f"tf_{i}") for i, w in enumerate(wanted)))
    rows = _counted(lists, list(fields), len(wanted))

    def part(i: int) -> Column:
        tf, df_ = F.col(f"tf_{i}"), F.col(f"df_{i}")
        idf = F.log(1 + (F.col("n") - df_ + 0.5) / (df_ + 0.5))
        return F.when(tf > 0, idf * tf / (tf + K1 * (1 - B + B * F.col("dl") / F.col("avg_dl")))).otherwise(0.0)

    any_of = reduce(lambda a, b: a | b, [F.col(f"tf_{i}") > 0 for i in range(len(wanted))])
    all_of = reduce(lambda a, b: a & b, [F.col(f"tf_{i}") > 0 for i in range(len(wanted))])
    score = F.col("boost") * reduce(lambda a, b: a + b, [part(i) for i in range(len(wanted))])
    return rows.filter(all_of if operator == "and" else any_of).groupBy(ident).agg(F.max(score).alias("score"))


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return dot / (norm(a) * norm(b))


def knn(df: DataFrame, ident: str, vector: str, query: list[float], k: int) -> DataFrame:
    """(id, score) of the k nearest by cosine, exactly; rows without a vector are left out. Filters come before."""
    if not query:
        return df.select(ident, F.lit(0.0).alias("score")).limit(0)
    q = F.array(*(F.lit(float(x)) for x in query))
    return df.filter(F.col(vector).isNotNull()).select(ident, cosine(F.col(vector), q).alias("score")).orderBy(F.desc("score"), ident).limit(k)


def ranked(df: DataFrame, ident: str, window: int) -> DataFrame:
    """(id, rank) of the first `window` rows, which bounds the one task that numbers them."""
    top = df.orderBy(F.desc("score"), ident).limit(window)
    return top.select(ident, F.row_number().over(Window.orderBy(F.desc("score"), ident)).alias("rank"))


def fused(legs: list[DataFrame], ident: str, page: int = 1, size: int = 20) -> DataFrame:
    """(id, score): the sum of 1 / (60 + rank) over legs, each cut to a window of max(page * size, 100)."""
    page, size, offset = page_bounds(page, size)
    window = max(page * size, 100)
    every = reduce(lambda a, b: a.union(b), [ranked(leg, ident, window) for leg in legs])
    return every.groupBy(ident).agg(F.sum(1.0 / (RRF + F.col("rank"))).alias("score")).orderBy(F.desc("score"), ident).offset(offset).limit(size)


def filtered(df: DataFrame, speaker_person_id=None, chamber=None, document_id=None, date_from=None, date_to=None, ref_bills=None, topics=None, is_substantive=True) -> DataFrame:
    """The optional filters of a speech search, all of which must hold; null never matches."""
    for column, value in (("speaker_person_id", speaker_person_id), ("chamber", chamber), ("document_id", document_id)):
        if value is not None:
            df = df.filter(F.col(column) == value)
    for column, values in (("ref_bills", ref_bills), ("topics", topics)):
        if values:
            df = df.filter(F.arrays_overlap(column, F.array(*map(F.lit, values))))
    if date_from is not None:
        df = df.filter(F.col("session_date") >= F.lit(date_from))
    if date_to is not None:
        df = df.filter(F.col("session_date") <= F.lit(date_to))
    return df.filter("is_substantive") if is_substantive else df


def search_speeches(df: DataFrame, q: str | None, fields: dict[str, float], *, page=1, page_size=20, rank_fusion: str | None = None, query_vector: list[float] | None = None, **filters) -> DataFrame:
    """Text search by default, `rrf` with a vector fuses both legs, `knn` ranks by vector alone. Ties by date (newest first) and id."""
    rows = filtered(df, **filters)
    page, size, offset = page_bounds(page, page_size)
    near = knn(rows, "record_id", "embedding", query_vector, max(page * size, 100)) if query_vector and "embedding" in df.columns else None
    if rank_fusion == "knn":
        return rows.limit(0).withColumn("score", F.lit(0.0)) if near is None else rows.join(near, "record_id").orderBy(F.desc("score"), "record_id").offset(offset).limit(size)
    text = bm25(df, "record_id", fields, q, "or").join(rows.select("record_id"), "record_id") if q else rows.select("record_id", F.lit(0.0).alias("score"))
    if rank_fusion == "rrf" and near is not None:
        return rows.join(fused([text, near], "record_id", page, size), "record_id").orderBy(F.desc("score"), "record_id")
    order = [F.desc("score"), F.desc_nulls_last("session_date")] if q else [F.desc_nulls_last("session_date"), F.desc("score")]
    return rows.join(text, "record_id").orderBy(*order, "record_id").offset(offset).limit(size)
