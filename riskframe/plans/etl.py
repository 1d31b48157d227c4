"""From raw transactions to a resampled training table, one parquet table per stage."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import clean, encode, features, geo, resample, scale, split
from riskframe.sources import tables

STAGES = ("cleaned", "with_country", "feature_engineered", "transformed", "train_resampled", "test")
ID_COLUMNS = ("user_id", "event_id")
NOT_ONEHOT = ("device_id", "signup_time", "purchase_time")


def run_name() -> str:
    return f"run-{uuid.uuid4().hex}"


def clean_transactions(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Fill gaps, drop copies, repair types."""
    text = clean.string_columns(df, ["signup_time", "purchase_time"])
    fixable = [c for c in [*clean.numeric_columns(df, [*key, *ID_COLUMNS]), *text] if c != "class"]
    out = clean.handle_missing(df, "fill", fixable, fallback="Unknown")
    out = clean.remove_duplicates(out)
    out = clean.to_datetime(out, ["signup_time", "purchase_time"])
    return clean.drop_bad_datetimes(out, ["signup_time", "purchase_time"])


def run_stages(
    df: DataFrame, ranges: DataFrame, key: Sequence[str], out: str, label: str = "class", seed: int = 42
) -> dict[str, str]:
    """Run all stages; every stage reads the table the stage before wrote. Returns the paths."""
    spark = df.sparkSession
    paths = {s: f"{out}/processed/{s}.parquet" for s in STAGES}

    def store(stage: str, frame: DataFrame) -> DataFrame:
        tables.save(frame, paths[stage])
        return spark.read.parquet(paths[stage])

    cleaned = store("cleaned", clean_transactions(df, key))
    located = store("with_country", geo.map_ip(cleaned, ranges))
    built = features.time_features(located)
    built = features.velocity(built, windows=("1h", "24h", "7d"), closed="left")
    built = store("feature_engineered", features.user_gaps(built, tie_break=key[0]))
    text = clean.string_columns(built, NOT_ONEHOT)
    encoded = encode.onehot_apply(built, encode.onehot_fit(built, text), drop_first=False)
    numbers = clean.numeric_columns(built, [label, *ID_COLUMNS, *key])
    transformed = store("transformed", scale.apply(encoded, scale.fit(encoded, numbers)))
    inputs = [c for c in clean.numeric_columns(transformed) if c not in {label, *ID_COLUMNS, *key}]
    marked = split.stratified(transformed.select(*key, *inputs, label), key, label, seed=seed)
    train = marked.where("split = 'train'").drop("split")
    choice = resample.choose_strategy(train, label).first()
    if choice["strategy"] == "smote":
        train = resample.smote(train, key, label, inputs, choice["smote_ratio"], seed=seed)
    elif choice["strategy"] == "smote_undersample":
        train = resample.smote_undersample(
            train, key, label, inputs, choice["smote_ratio"], choice["under_ratio"], seed=seed
        )
    store("train_resampled", train)
    store("test", marked.where("split = 'test'").drop("split"))
    return paths


def stage_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(stage, n_rows, n_columns) of the written tables."""
    parts = []
    for stage, path in paths.items():
        frame = spark.read.parquet(path)
        parts.append(
            frame.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(stage).alias("stage"), "n_rows", F.lit(len(frame.columns)).alias("n_columns")
            )
        )
    return reduce(DataFrame.unionByName, parts)
