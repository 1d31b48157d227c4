"""Missing values, duplicates, type repair, column selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators import order

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

# Default columns left out of the features, and the label, per dataset. Fixed values.
DATASETS = {
    "ecommerce": {"target": "class", "exclude": ["user_id", "signup_time", "purchase_time", "ip_address"]},
    "banking": {"target": "Class", "exclude": ["Time"]},
}


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"Columns not found: {missing}. Available: {df.columns}")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def fill_values(df: DataFrame, columns: Sequence[str], fallback: str = "") -> dict:
    """Fitted fill value per column that has nulls: median of numbers, mode of the rest.

    One row per column reaches the driver.
    """
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()
    gaps = [c for c in columns if counts[c]]
    nums = [c for c in numeric_columns(df) if c in gaps]
    others = [c for c in gaps if c not in nums]
    values: dict = {}
    if nums:
        rows = order.quantiles(df, nums, {"median": 0.5}).collect()
        values.update({r["column_name"]: r["median"] for r in rows})
    if others:
        values.update(dict.fromkeys(others, fallback))
        values.update({r["column_name"]: r["top"] for r in order.modes(df, others).collect()})
    return values


def _filled(df: DataFrame, name: str, value) -> Column:
    kind = df.schema[name].dataType
    if isinstance(value, float):
        kind = T.DoubleType()  # an integer column with nulls takes a fractional median
    return F.coalesce(F.col(name).cast(kind), F.lit(value).cast(kind)).alias(name)


def handle_missing(
    df: DataFrame,
    strategy: str = "drop",
    columns: Sequence[str] | None = None,
    fill_value=None,
    order_by: str | None = None,
    partition_by: Sequence[str] = (),
    fallback: str = "",
) -> DataFrame:
    """Drop rows with nulls, fill them (constant, or median/mode), or carry values along ``order_by``."""
    columns = list(columns) if columns is not None else df.columns
    require_columns(df, columns)
    if strategy == "drop":
        return df.dropna(subset=columns)
    if strategy == "fill":
        values = (
            fill_values(df, columns, fallback) if fill_value is None else dict.fromkeys(columns, fill_value)
        )
        return df.select(*[_filled(df, c, values[c]) if c in values else F.col(c) for c in df.columns])
    if strategy == "forward_fill":
        if order_by is None:
            raise ValueError("forward_fill needs order_by, a unique numeric key: a DataFrame has no row order")
        return order.carry_fill(df, [c for c in columns if c != order_by], order_by, partition_by)
    raise ValueError(f"Invalid strategy: {strategy}. Must be 'drop', 'fill' or 'forward_fill'")


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, missing_count, missing_percent) of columns with nulls, most nulls first."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n__"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing_count")) for c in df.columns]
    )
    return (
        counted.select("n__", F.explode(pairs).alias("p"))
        .where(F.col("p.missing_count") > 0)
        .select("p.*", (F.col("p.missing_count") / F.col("n__") * 100).alias("missing_percent"))
        .orderBy(F.desc("missing_count"), "column_name")
    )


def remove_duplicates(
    df: DataFrame, subset: Sequence[str] | None = None, keep: str | bool = "first", order_by: str | None = None
) -> DataFrame:
    """Keep the first or last row per ``subset`` along ``order_by``, or only rows without a twin.

    An aggregate, not a ranking window: copies collapse on the map side, so a group
    that holds much of the table stays cheap.
    """
    keys = list(subset) if subset is not None else df.columns
    require_columns(df, keys)
    if keep not in ("first", "last", False):
        raise ValueError(f"Invalid keep: {keep}. Must be 'first', 'last' or False")
    if keep and (order_by is None or set(keys) == set(df.columns)):
        if set(keys) != set(df.columns):
            raise ValueError("keep needs order_by, a unique key, when rows in a group can differ")
        return df.dropDuplicates()
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[c for c in rest if c != order_by]) if [c for c in rest if c != order_by] else F.lit(0)
    if keep is False:
        grouped = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n__"), *[F.first(c).alias(f"{c}__v") for c in rest]
        )
        return grouped.where("n__ = 1").select(
            *[F.col(c) if c in keys else F.col(f"{c}__v").alias(c) for c in df.columns]
        )
    pick = F.min_by if keep == "first" else F.max_by
    edge = F.min if keep == "first" else F.max
    grouped = df.groupBy(*keys).agg(edge(order_by).alias("o__"), pick(row, order_by).alias("r__"))
    return grouped.select(
        *[
            F.col(c) if c in keys else F.col("o__").alias(c) if c == order_by else F.col(f"r__.{c}").alias(c)
            for c in df.columns
        ]
    )


def duplicate_stats(df: DataFrame) -> DataFrame:
    """(total_rows, duplicate_count, duplicate_percent); a row counts when an equal one came before."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n__"))
    return per_row.agg(
        F.sum("n__").alias("total_rows"), (F.sum("n__") - F.count(F.lit(1))).alias("duplicate_count")
    ).withColumn("duplicate_percent", F.col("duplicate_count") / F.col("total_rows") * 100)


def conflicting_duplicates(df: DataFrame, label: str, features: Sequence[str] | None = None) -> DataFrame:
    """Groups of equal feature rows that carry more than one label value."""
    keys = list(features) if features is not None else [c for c in df.columns if c != label]
    return (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(label).alias("min_label"),
            F.max(label).alias("max_label"),
        )
        .where("min_label <> max_label")
    )


def to_datetime(df: DataFrame, columns: Sequence[str], strict: bool = False, fmt: str | None = None) -> DataFrame:
    """Text to zone-less timestamp; unreadable text becomes null, or fails when ``strict``."""
    fmts = [F.lit(fmt)] if fmt else []
    parse = F.to_timestamp_ntz if strict else F.try_to_timestamp
    done = {}
    for c in columns:
        if isinstance(df.schema[c].dataType, (T.TimestampNTZType, T.TimestampType)):
            done[c] = F.col(c).cast("timestamp_ntz")
        else:
            done[c] = parse(F.col(c), *fmts).cast("timestamp_ntz")
    return df.withColumns(done)


def drop_bad_datetimes(df: DataFrame, columns: Sequence[str], max_share: float = 0.01) -> DataFrame:
    """Drop rows with null dates if the null cells are fewer than ``max_share`` of the rows, else keep all."""
    bad_cells = sum((F.count_if(F.col(c).isNull()) for c in columns), F.lit(0))
    stats = df.agg(bad_cells.alias("bad"), F.count(F.lit(1)).alias("n")).first()
    if stats["bad"] and stats["bad"] < stats["n"] * max_share:
        return df.dropna(subset=list(columns))
    return df


def to_numeric(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """Text to number; unreadable text becomes null."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` as {kind})") for c in columns})


def clean_label(df: DataFrame, label: str) -> DataFrame:
    """Strip blanks and quotes from the label, make it an integer, keep rows with 0 or 1."""
    stripped = F.trim(F.regexp_replace(F.trim(F.col(label).cast("string")), '"', ""))
    return df.withColumn(label, stripped.try_cast("int")).where(F.col(label).isin(0, 1))


def fix_infinite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Infinite and NaN values become null, then the column median."""
    inf = F.lit(float("inf"))
    finite = df.withColumns(
        {c: F.when((F.abs(F.col(c)) != inf) & ~F.isnan(F.col(c)), F.col(c)) for c in columns}
    )
    return handle_missing(finite, "fill", columns)


def feature_columns(
    df: DataFrame, target: str, exclude: Sequence[str] = (), features: Sequence[str] | None = None
) -> list[str]:
    """Names of the feature columns: the given ones, or all but the target and the excluded ones."""
    require_columns(df, [target])
    if features is None:
        names = [c for c in df.columns if c != target and c not in exclude]
    else:
        require_columns(df, features)
        names = [c for c in features if c != target]
    if not names:
        raise ValueError(f"No feature is left: the target '{target}' and the excluded columns are all there is")
    return names


def separate_features(
    df: DataFrame,
    dataset: str = "ecommerce",
    target: str | None = None,
    exclude: Sequence[str] | None = None,
    features: Sequence[str] | None = None,
) -> DataFrame:
    """Project to the feature columns plus the target, which stay in one DataFrame."""
    if dataset not in DATASETS:
        raise ValueError(f"Invalid dataset: {dataset}. Must be one of {sorted(DATASETS)}")
    conf = DATASETS[dataset]
    target = target or conf["target"]
    names = feature_columns(df, target, conf["exclude"] if exclude is None else exclude, features)
    return df.select(*names, target)


def feature_info(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> DataFrame:
    """One row per column: name, type, role (target, excluded, feature)."""
    require_columns(df, [target])
    rows = [
        (f.name, f.dataType.simpleString(), "target" if f.name == target else "excluded" if f.name in exclude else "feature")
        for f in df.schema
    ]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string, role string")
