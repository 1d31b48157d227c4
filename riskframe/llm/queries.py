"""Registered queries of the text operators: each applies its operator to the whole of its table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import fim, fingerprint, html_text, langid, merkle, minhash, mixing, packing, pii, quality_model, quality_rules, recompress, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_pairs(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), path, capacity=2048, end_id=0, keep_ids=False)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.assess(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = pii.find(_table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    return spans.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
        F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("found")).alias("spans"),
    )


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "anomaly")


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.transform(_table(spark, sf_dir, "documents")))


def op12_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.digests(recompress.remove_repeats(_table(spark, sf_dir, "documents")))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_spotsigs": op1_spotsigs,
    "op2_mixing": op2_mixing,
    "op3_minhash": op3_minhash,
    "op4_packing": op4_packing,
    "op5_warc": op5_warc,
    "op6_language_id": op6_language_id,
    "op7_quality_model": op7_quality_model,
    "op8_pii": op8_pii,
    "op9_html_text": op9_html_text,
    "op10_quality_rules": op10_quality_rules,
    "op11_fim": op11_fim,
    "op12_recompression": op12_recompression,
    "op13_merkle": op13_merkle,
}

SQL: dict[str, str] = {
    "op2_mixing": mixing.SQL,
    "op5_warc": warc.SQL,
    "op11_fim": fim.SQL,
    "op12_recompression": recompress.SQL,
    "op13_merkle": merkle.SQL,
}


def all_queries() -> dict:
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    return dict(SQL)
