"""Every numbered operator and stage on tables most of whose partitions hold no row."""

import public_tokenizers
import pytest

import corpus_pipeline
from atrium.llm import queries as Q
from atrium.llm.best_fit_packing import packed
from atrium.llm.bpe_lexicon import bpe_round_trip
from atrium.llm.embedding_dedup import near_vectors
from atrium.llm.language_id import language_id
from atrium.llm.minhash_dedup import near_duplicates
from atrium.llm.phrase_fingerprints import compared
from atrium.llm.quality_classifier import quality
from atrium.llm.slot_sharding import sharded
from atrium.llm.tool_calls import CHAT_TOOLS, from_conversations, linked
from atrium.llm.url_rules import judged

TEXT = {
    "op1": sharded,
    "op2": quality,
    "op3": language_id,
    "op5": compared,
    "op6": near_duplicates,
    "op7": lambda d: packed(d, public_tokenizers.path("byte_bpe_50k.json")),
    "op8": lambda d: bpe_round_trip(d, public_tokenizers.path("word_bpe_49k.json")),
}


@pytest.fixture(scope="module")
def sparse(spark, docs):
    return docs.limit(3).repartition(64)


@pytest.mark.parametrize("name", TEXT)
def test_documents(sparse, name):
    assert {r["doc_id"] for r in TEXT[name](sparse).collect()} == {r["doc_id"] for r in sparse.collect()}


def test_vectors(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").limit(3).repartition(64)
    assert near_vectors(rows).count() == 3


def test_urls(spark, sf):
    rows = spark.read.parquet(f"{sf}/pages.parquet").limit(3).repartition(64)
    assert judged(rows, spark.createDataFrame([], "page_id long, blocked boolean")).count() == 3


def test_chats(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").limit(3).repartition(64)
    assert linked(from_conversations(rows), CHAT_TOOLS).count() == 3


def test_file_with_more_splits_than_row_groups(spark, sf):
    """Splits without a row group are empty partitions."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert Q.op2_quality_weak_labels(spark, sf).count() == Q.op3_language_id(spark, sf).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, sparse, sf, name, stage):
    columns = stage(spark, sparse, sf).columns
    assert stage(spark, sparse.limit(0).repartition(8), sf).count() == 0
    if name != "packing":
        assert columns == sparse.columns
