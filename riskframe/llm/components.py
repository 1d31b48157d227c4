"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node reachable, for every node on an edge. Self loops and repeated edges do no harm.

    Every round takes the least label among the neighbours and then the label's own label, until nothing changes.
    Labels are stored in the shared folder each round, so the lineage stays short.
    """
    both = edges.select(F.col(a).alias("src"), F.col(b).alias("dst"))
    both = stored(both.union(both.select("dst", "src")).distinct(), "edges")
    label = stored(both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = both.join(label.withColumnRenamed("node", "src"), "src").groupBy(F.col("dst").alias("node")).agg(F.min("label").alias("m"))
        lower = label.join(near, "node").select("node", F.least("label", "m").alias("next"), F.col("label").alias("old"))
        jump = label.select(F.col("node").alias("next"), F.col("label").alias("far"))
        step = stored(lower.join(jump, "next", "left").select("node", F.least("next", F.coalesce("far", "next")).alias("label"), "old"), "labels")
        changed = step.where(F.col("label") != F.col("old")).limit(1).count()
        label = step.select("node", "label")
        if not changed:
            return label
