"""The numbered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import (
    alignment,
    bpe,
    language,
    lm,
    lsh_forest,
    mixing,
    parsing,
    simhash,
    token_counts,
    token_files,
    topk,
    toxicity,
    trie,
)
from tidemart.llm.common import fold
from tidemart.session import configure

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
WORD_BPE = "word_bpe_49k.json"

_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    def prepared(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        run.__name__ = build.__name__
        return run

    return {name: prepared(build) for name, build in _QUERIES.items()}


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file; ``PUBLIC_TOKENIZERS`` names another folder."""
    folder = os.environ.get("PUBLIC_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learn(language.training_rows(docs))
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(True)).alias("held_out")
    return language.predict_languages(docs, model).select("doc_id", held, "lang_pred", "score")


@query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_copies(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer(PIECE_BPE))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer(WORD_BPE))


@query
def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


@query
def op8_parsing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.compare_edited(table(spark, sf_dir, "documents"))


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(True)).alias("held_out")
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", held, "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "passages"
    )


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align_documents(docs, tokenizer(BYTE_BPE), tokenizer(PIECE_BPE))


@query
def op12_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))
