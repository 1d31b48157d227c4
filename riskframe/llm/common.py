"""Helpers shared by the text operators: shared folder, stored tables, salted look-ups, word patterns."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.lineage import work_dir

# A word is a run of characters that are neither blank nor one of the five ASCII line and tab controls.
BLANK = r"[\x20\x09-\x0D]+"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that driver and executors share."""
    return f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the table to the shared folder and read it back: later steps never recompute it, lost executors or not."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salted_join(rows: DataFrame, table: DataFrame, on: list[str], how: str = "left", salts: int = 16) -> DataFrame:
    """Join of ``rows`` to a small or medium ``table`` that spreads a hot key of ``rows`` over ``salts`` tasks.

    ``table`` is copied once per salt, so it should hold few rows per key and only keys that need the join. The salt
    of a row is a hash of its other columns: a retried task deals it alike. Null keys match nothing.
    """
    rest = [c for c in rows.columns if c not in on] or on
    dealt = rows.withColumn("__salt", F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int"))
    copies = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [*on, "__salt"], how).drop("__salt")


def word_count(text: Column) -> Column:
    """Number of words (long); null text has none. One split, whose empty ends are taken off."""
    parts = F.size(F.split(text, BLANK)).cast("long")
    ends = F.when(F.substring(text, 1, 1).rlike(BLANK), 1).otherwise(0) + F.when(F.substring(text, -1, 1).rlike(BLANK), 1).otherwise(0)
    return F.when(text.isNull() | (text == ""), F.lit(0).cast("long")).otherwise(parts - ends)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def empty_text(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def _kept(kind: str) -> dict:
    module = sys.modules.setdefault("riskframe_worker_store", types.ModuleType("riskframe_worker_store"))
    kept = module.__dict__.setdefault("kept", {})
    for other in [k for k in kept if k[0] != kind]:
        del kept[other]
    return kept


def worker_store(kind: str, key: object, make: Callable[[], object]) -> object:
    """A value that a Python worker makes once and keeps for its later tasks (the package itself travels with each task).

    Workers live on from one operator's stages to the next one's, so what was kept of another kind goes.
    """
    kept = _kept(kind)
    if (kind, key) not in kept:
        kept[kind, key] = make()
    return kept[kind, key]


def forget_others(kind: str) -> None:
    """Drop what a Python worker keeps for tasks of another kind; for tasks that keep nothing but need the memory."""
    _kept(kind)
