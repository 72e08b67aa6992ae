"""Documents to packed training sequences: quality, language, near-duplicates, packing.

run(spark, sf_dir) applies STAGES in order; each stage's result is written as
Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atrium.llm import best_fit_packing, language_id, minhash_dedup, quality_classifier
from atrium.scratch import write_table

#: A document in which no language has this share of the letters has no language.
MIN_SHARE = 0.35
#: Near-duplicates: five-word shingles with a Jaccard similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# In every stage: null, empty and blank texts are rejected by the quality stage, and later stages take them if they get any; very
# long texts are read whole; equal rows get one decision, except among near-duplicates; an empty table gives an empty one. The
# columns of docs may have any names.


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the weak-label quality classifier, trained on docs, accepts; a score of exactly 0.5 is kept.

    Null, empty and blank texts go. Null doc_ids are judged like others, but
    don't train.
    """
    model = quality_classifier.train(docs)
    return docs.where(model.score(F.col("text"))["keep"])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with an identified language; the model learns from all docs with text and lang.

    Texts without a letter go, and so do texts in which no language has
    MIN_SHARE of the letters; of languages that tie the first by name counts.
    Where nothing can be learned (no row has text and lang) all go.
    """
    model = language_id.train(docs)
    # In one struct, no column of docs can meet the new one.
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), model.predict(F.col("text")).alias("language"))
    sure = (F.col("language.lang_pred") != language_id.UNKNOWN) & (F.col("language.score") >= MIN_SHARE)
    return found.where(sure).select("row.*")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicates, of its smallest doc_id; each row is judged by its own text.

    Equal rows are near-duplicates of each other, of which any one stays; rows
    of one doc_id and different texts stay apart. Rows without doc_id and
    texts without words are kept.
    """
    key = F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())
    rows = write_table(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key")), "rows")
    decided = minhash_dedup.near_duplicates(rows.select(F.col("key").alias("doc_id"), "row.text"), shingle=SHINGLE, percent=PERCENT)
    decided = decided.where("doc_id is not null").select(F.col("doc_id").alias("key"), "component_id")
    decided = write_table(decided.join(rows.select("key", "row.doc_id"), "key"), "decided")
    first = decided.groupBy("component_id").agg(F.min(F.struct("doc_id", "key"))["key"].alias("first"))
    # Keys against keys, without a join of groups, of which one may be large; texts meet only the few that go.
    gone = write_table(decided.select("key").join(first.select(F.col("first").alias("key")), "key", "left_anti"), "gone")
    return rows.join(gone, "key", "left_anti").select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places each document's pieces in sequences of at most 2048 tokens; all rows are packed, null texts as empty ones."""
    return best_fit_packing.packed(docs, TOKENIZER)


STAGES = [("quality", quality_stage), ("language", language_stage), ("near_dedup", dedup_stage), ("packing", packing_stage)]

#: Classifier, language model, signatures and tokenizer have no SQL form; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
