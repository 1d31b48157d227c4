"""Cutting the lineage of a table that several later steps read, and the folder for it."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    A session without that setting gets a folder of its own only where driver and tasks are one machine
    (master ``local...``); on a cluster the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = os.path.join("/tmp", f"riskframe-{uuid.uuid4().hex}")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def ready(spark: SparkSession) -> None:
    """Give the session a checkpoint folder, which iterative fits use as well."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(work_dir(spark))


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: its files outlive lost executors."""
    ready(df.sparkSession)
    return df.checkpoint(eager=True)
