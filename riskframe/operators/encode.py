"""Label and one-hot encoding with fitted mapping tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.scalar import hash32
from riskframe.operators.clean import require_columns, string_columns
from riskframe.operators.lineage import cut
from riskframe.operators.order import cell_count

NULL_TEXT = "nan"
SAMPLE_VALUES = 20_000
# Columns with at most this many values have their codes broadcast; others join by shuffle.
BROADCAST_VALUES = 1_000_000


def _text(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(NULL_TEXT))


def label_fit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, value, code): code = place of the value in the sorted distinct values, from 0.

    Absent columns are skipped; null is the text 'nan'. Distinct values are placed by range
    cells whose borders come from a bounded sample, so a vocabulary of any size is
    numbered in parallel. The mapping, the fitted encoder, is stored once.
    """
    columns = [c for c in (string_columns(df) if columns is None else columns) if c in df.columns]
    if not columns:
        raise ValueError("No categorical columns to encode")
    pairs = [F.struct(F.lit(c).alias("column_name"), _text(c).alias("value")) for c in columns]
    values = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").distinct()
    n = cell_count(df)
    drawn = values.orderBy(hash32(["column_name", "value"], 0)).limit(SAMPLE_VALUES)
    ranked = drawn.withColumn("tile", F.ntile(n).over(Window.partitionBy("column_name").orderBy("value")))
    borders: dict[str, list[str]] = {}
    for r in ranked.groupBy("column_name", "tile").agg(F.max("value").alias("edge")).collect():
        borders.setdefault(r["column_name"], []).append(r["edge"])
    cell = F.lit(0)
    for name, edges in borders.items():
        edge_list = F.array(*[F.lit(e) for e in sorted(edges)])
        below = F.size(F.filter(edge_list, lambda e: e < F.col("value")))
        cell = F.when(F.col("column_name") == name, below).otherwise(cell)
    placed = values.withColumn("cell", cell)
    totals = placed.groupBy("column_name", "cell").agg(F.count(F.lit(1)).alias("n"))
    over_cells = Window.partitionBy("column_name").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("column_name", "cell", F.coalesce(F.sum("n").over(over_cells), F.lit(0)).alias("off"))
    inside = Window.partitionBy("column_name", "cell").orderBy("value")
    return cut(
        placed.withColumn("rn", F.row_number().over(inside))
        .join(offsets, ["column_name", "cell"])
        .select("column_name", "value", (F.col("off") + F.col("rn") - 1).alias("code"))
    )


def label_apply(df: DataFrame, mapping: DataFrame, columns: Sequence[str], drop_original: bool = False) -> DataFrame:
    """Add ``<col>_idx``; values unknown to the mapping get null.

    Codes are broadcast after a check of their number. A larger vocabulary joins by
    shuffle, where adaptive execution splits the rows of a hot value.
    """
    require_columns(df, columns)
    sizes = mapping.where(F.col("column_name").isin(list(columns))).groupBy("column_name").count().collect()
    small = {r["column_name"] for r in sizes if r["count"] <= BROADCAST_VALUES}
    out = df
    for c in columns:
        codes = mapping.where(F.col("column_name") == c).select(
            F.col("value").alias(f"{c}__text"), F.col("code").alias(f"{c}_idx")
        )
        if c in small:
            codes = F.broadcast(codes)
        out = out.withColumn(f"{c}__text", _text(c)).join(codes, f"{c}__text", "left").drop(f"{c}__text")
    names = [c for c in df.columns if not (drop_original and c in columns)]
    return out.select(*names, *[f"{c}_idx" for c in columns])


def onehot_fit(df: DataFrame, columns: Sequence[str], max_values: int = 1000) -> dict[str, list]:
    """Sorted distinct values per column. Each becomes an output column, hence the limit."""
    require_columns(df, columns)
    out = {}
    for c in columns:
        rows = df.select(c).where(F.col(c).isNotNull()).distinct().limit(max_values + 1).collect()
        if len(rows) > max_values:
            raise ValueError(f"Column {c} has more than {max_values} values; use label_fit")
        out[c] = sorted(r[0] for r in rows)
    return out


def onehot_apply(
    df: DataFrame, values: dict[str, list], drop_first: bool = True, drop_original: bool = True
) -> DataFrame:
    """Add 0/1 columns ``<col>_<value>``; a null value gives zeros in all of them."""
    require_columns(df, list(values))
    new = []
    for c, vocabulary in values.items():
        for v in vocabulary[1:] if drop_first else vocabulary:
            new.append(F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}"))
    kept = [c for c in df.columns if not (drop_original and c in values)]
    return df.select(*kept, *new)
