"""From raw documents to packed training sequences, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavespark.llm import langid, near_dup, pii_crf, queries, toxicity
from pavespark.llm.common import table
from pavespark.llm.packing import packed
from pavespark.session import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter or without a language of at least ``LEAST_LANGUAGE``."""
    found = langid.prediction(queries.language_model(docs))
    return docs.where((found["lang_pred"] != langid.UNDETERMINED) & (found["score"] >= LEAST_LANGUAGE))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that score ``MOST_TOXIC`` or more; null and empty texts score low."""
    weights = queries.toxicity_model(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.scores(weights) < MOST_TOXIC)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies.

    Rows of one id with different texts are documents of their own here; of rows with the same
    id and words one stays. Rows without an id belong to no group and stay.
    """
    columns, key = docs.columns, "doc_id"
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if not repeated.isEmpty():
        key = "near_dup_row"
        docs = written(near_dup.numbered_texts(docs, key))
    dropped = near_dup.near_duplicates(docs, id_column=key).where("NOT kept").select(F.col("doc_id").alias(key))
    return docs.join(dropped, key, "left_anti").select(columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind of the data in place of every span found; counts characters anew."""
    masked = pii_crf.masked(docs, pii_crf.trained(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the Python workers of the stages before are still there and keep what they took, so the
    # memo is smaller than where packing runs alone
    return packed(docs, queries.vocabulary("word_bpe_49k.json"), memo=PACKING_MEMO)


LEAST_LANGUAGE, MOST_TOXIC = 0.3, 0.3
PACKING_MEMO = 100_000

STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]

# The models of the stages cannot be stated in SQL; tests/llm compares each stage with a
# plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
