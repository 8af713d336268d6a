"""From documents to token ids: toxic documents, near copies and leaks go, personal data is taken out, the rest is encoded.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last keep the columns of ``documents``. ``run`` writes what a
stage returns as Parquet in the shared folder and reads it again for the next one. Stages whose last step sends whole texts through Python have
written their result in this way themselves, so that batches are small whoever runs them.

Null texts and rows without an id are kept by every stage, and judged by their text; of equal rows one stays; a row of an id that is used twice is judged by
its own text. Very long texts are read whole. Further columns, whatever their names, come through unchanged. Without usable labels nothing is toxic. An empty
table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm import bpe_tokens, decontaminate, ngram_join, privacy, toxicity
from scriptorium.llm.common import store
from scriptorium.sources.tables import load

#: Rows of a batch of whole texts with all columns, which the JVM holds on its way to Python and back.
ROWS = 500


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, load(spark, sf_dir, "labels", "doc_id", "toxic"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words, a similarity of 0.8: the smallest id of each component stays."""
    return ngram_join.one_of_each(docs, k=5, num=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return store(decontaminate.drop_leaking(docs, load(spark, sf_dir, "benchmark", "item_id", "text")), "decontaminate", ROWS)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return store(privacy.sanitised_rows(docs), "privacy", ROWS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return store(bpe_tokens.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "n_tokens", "ids"), "bpe_tokens", ROWS)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("privacy", remove_personal_data),
    ("bpe_tokens", encode),
]

#: Trained and sketched stages can't be written in SQL; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        docs = out if "stored_at" in vars(out) else store(out, name)
    return docs
