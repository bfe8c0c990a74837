"""The document pipeline: toxic documents go, near duplicates fold to one, secrets are masked, sources are mixed, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again for the next. All but the last return the columns of `documents`. No SQL expresses the trained first stage, so ORACLE_SQL is None; tests hold every stage against a plain computation of its rows, and its operator against brute force.

Rows with null columns pass through all stages: a null text is empty, a null id belongs to no class and no label. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm import mixing, ngram_join, packing, secrets, toxicity
from lectern.llm.common import freed, read_table, scratch, stored

TEMPER = 0.9


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; the classifier learns from all labels. Rows with equal texts have one fate; without both labels nothing goes unless most labels are toxic."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return docs.filter(model.score(F.col("text")) < toxicity.THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents that with the smallest id; of rows with that id the first by text. Rows without an id stay."""
    classes = ngram_join.jaccard_classes(docs).filter("doc_id is not null")
    with freed(spark):
        fates = stored(classes.groupBy("doc_id").agg((F.count("*") > 1).alias("several"), F.max(F.col("component_id") == F.col("doc_id")).alias("stays")), "fates")
        # texts are not shuffled where bitmaps tell: most ids are in neither of them, and who goes is in the first only
        special = ngram_join.bitmap(fates.filter("several or not stays"), "doc_id")
        asked = ngram_join.bitmap(fates.filter(F.col("stays") & (F.col("several") | ngram_join.may_hold(F.col("doc_id"), special))), "doc_id")
    doc_id = F.col("doc_id").cast("long")
    there = docs.filter(F.col("doc_id").isNotNull())
    plain = there.filter(~ngram_join.may_hold(doc_id, special))
    unsure = there.filter(ngram_join.may_hold(doc_id, special) & ngram_join.may_hold(doc_id, asked))
    kept = unsure.join(fates.filter("stays").select("doc_id"), "doc_id", "left_semi")
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_first(), "source", "lang"))
    one = kept.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    return plain.select(docs.columns).union(one.select(docs.columns)).union(docs.filter(F.col("doc_id").isNull()))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found replaced by its kind; n_chars follows, a null text and its n_chars stay."""
    return docs.withColumn("text", secrets.redacted(F.col("text"))).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the raked probabilities draw, about a share mixing.BUDGET of the tokens. Rows with one id are drawn together; null sources and languages are values of their own."""
    return mixing.mix(docs, temper=TEMPER, budget=mixing.BUDGET).filter("kept").select(docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, with their token ids; every row is packed once, a null text as its end token."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_documents),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
