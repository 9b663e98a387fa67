"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import bpe, language, mixing, simhash, toxicity
from tidemart.llm.common import saved
from tidemart.llm.queries import BYTE_BPE, table, tokenizer
from tidemart.session import configure

# A language below this score is no language recognised.
LEAST_LANGUAGE_SCORE = 0.3


def recognise_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    configure(spark)
    model = language.learn(language.training_rows(docs))
    return language.keep_recognised(docs, model, LEAST_LANGUAGE_SCORE)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    configure(spark)
    labels = toxicity.training_labels(table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, toxicity.learn(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked stays."""
    configure(spark)
    return simhash.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    configure(spark)
    return bpe.digest_documents(docs, tokenizer(BYTE_BPE))


STAGES = [
    ("language ID", recognise_language),
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_copies),
    ("mixing", mix_sources),
    ("byte BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for label, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "stage-" + label.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
