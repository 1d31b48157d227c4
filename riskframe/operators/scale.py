"""Scaling with fitted parameters: standard (population deviation) and min-max."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.clean import require_columns
from riskframe.operators.profile import describe

KINDS = ("standard", "minmax")


def fit(df: DataFrame, cols: Sequence[str], kind: str = "standard") -> DataFrame:
    """(column_name, center, spread), one row per column, from one aggregate.

    'standard' takes mean and population deviation, 'minmax' minimum and range. A zero
    spread becomes 1, so a constant column scales to 0.
    """
    if kind not in KINDS:
        raise ValueError(f"Invalid kind: {kind}. Must be one of {list(KINDS)}")
    require_columns(df, cols)
    if kind == "standard":
        pairs = {c: (F.avg(c), F.stddev_pop(c)) for c in cols}
    else:
        pairs = {c: (F.min(c).cast("double"), (F.max(c) - F.min(c)).cast("double")) for c in cols}
    wide = df.agg(
        *[a.alias(f"{c}__a") for c, (a, _) in pairs.items()], *[b.alias(f"{c}__b") for c, (_, b) in pairs.items()]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}__a").alias("center"),
            F.when(F.col(f"{c}__b") == 0, 1.0).otherwise(F.col(f"{c}__b")).alias("spread"),
        )
        for c in cols
    ]
    return wide.select(F.inline(F.array(*rows)))


def apply(df: DataFrame, params: DataFrame | None) -> DataFrame:
    """Scale the fitted columns; the parameters, one row per column, become literals."""
    if params is None:
        raise ValueError("Scaler must be fitted before use")
    rows = params.collect()
    require_columns(df, [r["column_name"] for r in rows])
    return df.withColumns(
        {r["column_name"]: (F.col(r["column_name"]) - r["center"]) / F.lit(r["spread"]) for r in rows}
    )


def compare(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``describe`` of the raw, standard-scaled and min-max-scaled columns, with a ``version`` column."""
    versions = {
        "raw": df,
        "standard": apply(df, fit(df, cols, "standard")),
        "minmax": apply(df, fit(df, cols, "minmax")),
    }
    out = None
    for name, frame in versions.items():
        part = describe(frame, cols).select(F.lit(name).alias("version"), "*")
        out = part if out is None else out.unionByName(part)
    return out
