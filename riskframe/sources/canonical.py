"""Canonical inputs of the operators, derived from the star-schema test tables.

Each function returns a lazy DataFrame over the whole table; column pruning and
filters reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.scalar import micros, uniform

# Components of an embedding.
DIMS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-commerce transactions in the standard shape, from ``events``."""
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.expr("ts - make_dt_interval(0, cast(event_id % 240 as int))").alias("signup_time"),
        F.col("ts").alias("purchase_time"),
        F.col("value").alias("purchase_value"),
        F.concat(F.lit("dev_"), k).alias("device_id"),
        F.expr("case user_id % 3 when 0 then 'SEO' when 1 then 'Ads' else 'Direct' end").alias("source"),
        F.expr(
            "case event_id % 5 when 0 then 'Chrome' when 1 then 'Safari' when 2 then 'FireFox'"
            " when 3 then 'IE' else 'Opera' end"
        ).alias("browser"),
        F.expr("case when user_id % 2 = 0 then 'M' else 'F' end").alias("sex"),
        F.expr("cast(18 + user_id % 53 as int)").alias("age"),
        (((F.col("event_id") * 7919) % 100000).cast("double") + 0.5).alias("ip_address"),
        F.when((F.col("event_type") == "error") & (k.cast("int") < 50), 1).otherwise(0).alias("class"),
    )


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with nulls, unreadable dates, quoted labels, copies and flipped labels."""
    tx = transactions(spark, sf_dir)
    base = tx.select(
        "event_id",
        "user_id",
        "signup_time",
        F.when(F.col("event_id") % 211 == 0, "bad")
        .otherwise(F.date_format("purchase_time", "yyyy-MM-dd HH:mm:ss"))
        .alias("purchase_text"),
        F.when(F.col("event_id") % 97 != 0, F.col("purchase_value")).alias("purchase_value"),
        F.when(F.col("event_id") % 89 != 0, F.col("source")).alias("source"),
        "device_id",
        F.concat(F.lit(' "'), F.col("class").cast("string"), F.lit('" ')).alias("class_text"),
        "class",
    )
    flipped = base.where("event_id % 307 = 0").withColumn("class", 1 - F.col("class"))
    return base.unionByName(base.where("event_id % 101 = 0")).unionByName(flipped)


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-overlapping address ranges with gaps, from ``nation``."""
    low = F.col("n_nationkey").cast("bigint") * 4000
    return table(spark, sf_dir, "nation").select(
        low.alias("lower_bound_ip_address"),
        (low + 2999).alias("upper_bound_ip_address"),
        F.col("n_name").alias("country"),
    )


def bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Banking transactions from ``lineitem``; (l_orderkey, l_linenumber) is kept as the row key."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (micros("l_shipdate") / 1e6).alias("Time"),
        F.col("l_quantity").alias("V1"),
        F.col("l_extendedprice").alias("V2"),
        F.col("l_discount").alias("V3"),
        F.col("l_tax").alias("V4"),
        F.col("l_extendedprice").alias("Amount"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("Class"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic scored transactions, many score ties, label in ``class``."""
    score = (F.floor(60 * uniform(["event_id"], 42)) + 30 * F.col("class")) / F.lit(100.0)
    return (
        transactions(spark, sf_dir)
        .select("event_id", "class", score.alias("score"))
        .withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    )


def wide_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embedding components as columns f0.. with ``Class`` = (label = 0)."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        *[F.col("embedding")[j].cast("double").alias(f"f{j}") for j in range(DIMS)],
        F.when(F.col("label") == 0, 1).otherwise(0).alias("Class"),
    )
