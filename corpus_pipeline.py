"""A training corpus from ``documents``: language ID, near-duplicates, personal data, source mix, packing.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and works on all rows of ``docs``, the
Parquet table that its predecessor left. All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import langid, minhash, mixing, packing, pii
from riskframe.llm.common import new_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not recognised go."""
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (Jaccard 0.8 or more on five-word shingles) the smallest doc_id stays."""
    return minhash.keep_one(docs, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to their kind in brackets."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources come near their target weights."""
    return mixing.repeat(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2,048: one row per piece of a document and its place."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0, keep_ids=False)


STAGES = [
    ("language ID", language),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("source mix", mix),
    ("packing", pack),
]

#: Language identification and MinHash have no counterpart in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"stage{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
