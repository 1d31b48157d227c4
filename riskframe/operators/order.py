"""Order-dependent building blocks that never sort the whole table in one task.

The pattern is the same everywhere: rows (or distinct values) go into ordered
cells, one small aggregate per cell gives the totals, a prefix sum over the cells
gives each cell its offset, and the window runs inside a cell only. Results do
not depend on where the cell borders lie.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.scalar import hash32

# A group with more rows than this is not given to one task.
HOT_GROUP_ROWS = 2_000_000
# hash32 cells: 2^16 of them, so a class of 10^12 rows has about 1.5 * 10^7 per cell.
HASH_CELL_SHIFT = 65536
# Hot keys up to this number are broadcast.
MAX_HOT_KEYS = 100_000
# Part of the rows that is sketched to place cell borders, and the sketches that merge in one task at most.
BORDER_SAMPLE = 0.05
BORDER_SKETCHES = 64
# Labels with more classes than this are no labels.
MAX_CLASSES = 1000
# Rank error of the quantile sketches is 1 in so many; groups whose brackets are collected and broadcast at most.
SKETCH_ACCURACY = 10_000
BRACKET_GROUPS = 1000


def cell_count(df: DataFrame) -> int:
    """Number of ordered cells: one per shuffle partition."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equality join on ``keys`` in which null equals null; the keys of ``left`` stay."""
    named = right.withColumnsRenamed({k: f"{k}__right" for k in keys})
    on = [left[k].eqNullSafe(named[f"{k}__right"]) for k in keys]
    return left.join(named, on, how).drop(*[f"{k}__right" for k in keys])


def route_hot(df: DataFrame, key: str, max_rows: int, usable: Column) -> tuple[DataFrame, DataFrame | None]:
    """Split the table into (rows of ordinary groups, rows of hot groups or None).

    A group is hot with more than ``max_rows`` usable rows. One aggregate counts the groups.
    Up to MAX_HOT_KEYS hot keys are broadcast; with more of them, all usable rows count as
    hot. Rows that are not usable always go to the first table.
    """
    counts = df.where(usable).groupBy(key).count()
    hot = counts.where(F.col("count") > max_rows).select(F.col(key).alias("route__"))
    n_hot = hot.limit(MAX_HOT_KEYS + 1).count()
    if n_hot == 0:
        return df, None
    if n_hot > MAX_HOT_KEYS:
        return df.where(~usable), df.where(usable)
    routed = df.withColumn("route__", F.when(usable, F.col(key)))
    hot = F.broadcast(hot)
    return (
        routed.join(hot, "route__", "left_anti").select(*df.columns),
        routed.join(hot, "route__", "left_semi").select(*df.columns),
    )


def value_cells(df: DataFrame, cols: Sequence[str], cells: int | None = None) -> DataFrame:
    """Add ``<col>__cell`` for each numeric column: its range cell by sampled quantiles.

    Equal values always share a cell, and cells follow the order of the values. The borders
    of all columns come from sketches over a sample, merged in two levels so that no task
    takes the sketches of all others; they settle how even the cells are, never what a query
    returns. Every row gets a cell.
    """
    n = cells or cell_count(df)
    probs = F.array(*[F.lit(i / n) for i in range(1, n)])
    sketches = [F.percentile_approx(F.col(c).cast("double"), probs, 10 * n).alias(c) for c in cols]
    part = F.pmod(F.spark_partition_id(), F.lit(BORDER_SKETCHES)).alias("part__")
    drawn = df.sample(BORDER_SAMPLE, seed=0).groupBy(part).agg(*sketches)
    some = drawn.select(F.inline_outer(F.arrays_zip(*[F.col(c) for c in cols])))
    drawn = some.toDF(*cols).agg(*sketches)
    splits = []
    for row in drawn.first():
        borders = {b for b in row or [] if math.isfinite(b)} or {0.0}
        splits.append([-math.inf, *sorted(borders), math.inf])
    copies = {f"{c}__num": F.col(c).cast("double") for c in cols}
    return (
        Bucketizer(
            splitsArray=splits,
            inputCols=list(copies),
            outputCols=[f"{c}__cell" for c in cols],
            handleInvalid="keep",
        )
        .transform(df.withColumns(copies))
        .withColumns({f"{c}__cell": F.col(f"{c}__cell").cast("int") for c in cols})
        .drop(*copies)
    )


def _cell_offsets(df: DataFrame, by: Sequence[str], cell: str, sums: Sequence[str]) -> DataFrame:
    """Per (by, cell): the totals of ``sums`` over all earlier cells, as ``<s>__off``.

    The window holds one row per cell of a group, not one per input row.
    """
    totals = df.groupBy(*by, cell).agg(*[F.sum(s).alias(s) for s in sums])
    w = Window.partitionBy(*by).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *by, cell, *[F.coalesce(F.sum(s).over(w), F.lit(0)).alias(f"{s}__off") for s in sums]
    )


def add_preceding(
    df: DataFrame, by: Sequence[str], cell: str, value: str, sums: Sequence[str], suffix: str = "_before"
) -> DataFrame:
    """Add ``<s>_before``: the total of ``s`` over rows of the group with a smaller value.

    ``df`` has one row per (by, value); ``cell`` is an ordered cell of ``value``.
    """
    offsets = _cell_offsets(df, by, cell, sums)
    w = Window.partitionBy(*by, cell).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    inside = {f"{s}__in": F.coalesce(F.sum(s).over(w), F.lit(0)) for s in sums}
    return (
        null_safe_join(df, offsets, [*by, cell])
        .withColumns(inside)
        .withColumns({f"{s}{suffix}": F.col(f"{s}__in") + F.col(f"{s}__off") for s in sums})
        .drop(*inside, *[f"{s}__off" for s in sums])
    )


def value_counts_long(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), sums: dict[str, Column] | None = None
) -> DataFrame:
    """(by, column_name, cell, value, n, sums...): distinct values of numeric columns, nulls left out.

    The aggregate combines on the map side, so the shuffle carries distinct values only.
    """
    sums = sums or {}
    with_cells = value_cells(df.select(*by, *cols, *[e.alias(s) for s, e in sums.items()]), cols)
    pairs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}__cell").alias("cell"),
            F.col(c).cast("double").alias("value"),
        )
        for c in cols
    ]
    # both conditions say the same; naming both keeps the plans of all readers alike, so Spark
    # computes the counts once and reuses the exchange
    long = with_cells.select(*by, *sums, F.explode(F.array(*pairs)).alias("p")).select(*by, *sums, "p.*")
    return (
        long.where(F.col("value").isNotNull() & F.col("cell").isNotNull())
        .groupBy(*by, "column_name", "cell", "value")
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(s).alias(s) for s in sums])
    )


def quantiles(
    df: DataFrame, cols: Sequence[str], probs: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact, linearly interpolated quantiles: (by, column_name, one column per name in ``probs``).

    Three wide passes without a row per cell: mergeable sketches give an interval of values around every wanted rank,
    counts below the intervals tell where they lie, and only the values inside them, some ``6 / SKETCH_ACCURACY`` of the
    rows, are counted and ranked. Whether the intervals hold their ranks is checked; where they do not, a column has NaN,
    or there are more than ``BRACKET_GROUPS`` groups, all values are counted (``quantiles_by_cells``).
    """
    cols, names = list(cols), list(probs)
    wide = _brackets(df, cols, probs, by)
    if wide is None:
        return quantiles_by_cells(df, cols, probs, by)
    entries = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(j).alias("j"), F.col(c).cast("double").alias("value"),
            F.col(f"__low{i}")[j].alias("low"), F.col(f"__high{i}")[j].alias("high"),
            F.col(f"__below{i}")[j].alias("below"), F.col(f"__n{i}").alias("n"),
        )
        for i, c in enumerate(cols)
        for j in range(len(names))
    ]
    hits = F.filter(F.array(*entries), lambda e: (e["value"] >= e["low"]) & (e["value"] <= e["high"]))
    inside = wide.select(*by, F.explode(hits).alias("e")).select(*by, "e.column_name", "e.j", "e.value", "e.below", "e.n")
    keys = [*by, "column_name", "j", "below", "n"]
    counts = inside.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("rows"))
    upto = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("end", F.col("below") + F.sum("rows").over(upto))
    place = F.element_at(F.array(*[F.lit(float(p)) for p in probs.values()]), F.col("j") + 1) * (F.col("n") - 1)

    def at(position: Column) -> Column:
        return F.max(F.when((position < F.col("end")) & (position >= F.col("end") - F.col("rows")), F.col("value")))

    low, high = at(F.floor(place)), at(F.ceil(place))
    ranks = counts.groupBy(*by, "column_name", "j").agg((low + (high - low) * F.max(place - F.floor(place))).alias("q"))
    one = [F.max(F.when(F.col("j") == j, F.col("q"))).alias(name) for j, name in enumerate(names)]
    return ranks.groupBy(*by, "column_name").agg(*one)


def _literal(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.ArrayType):
        return F.array(*[F.lit(v) for v in value]).cast(kind)
    return F.lit(value).cast(kind)


def _brackets(df: DataFrame, cols: Sequence[str], probs: dict[str, float], by: Sequence[str]) -> DataFrame | None:
    """Rows beside their group's brackets, or None where brackets cannot be used."""
    step = 2.0 / SKETCH_ACCURACY
    edges = [min(1.0, max(0.0, p + d)) for p in probs.values() for d in (-step, step)]
    data = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    aggregates = []
    for i, c in enumerate(cols):
        aggregates += [
            F.count(c).alias(f"n{i}"), F.count_if(F.isnan(c)).alias(f"nan{i}"), F.min(c).alias(f"min{i}"), F.max(c).alias(f"max{i}"),
            F.percentile_approx(c, edges, SKETCH_ACCURACY).alias(f"edges{i}"),
        ]
    groups = data.groupBy(*by).agg(*aggregates).limit(BRACKET_GROUPS + 1).collect()
    if len(groups) > BRACKET_GROUPS or any(g[f"nan{i}"] for g in groups for i in range(len(cols))):
        return None
    rows = []
    for g in groups:
        row = [g[b] for b in by]
        for i in range(len(cols)):
            n, found = g[f"n{i}"], g[f"edges{i}"]
            few = n <= 2 * SKETCH_ACCURACY  # too few for an interval of ranks: all of them
            low = [g[f"min{i}"] if few or edges[2 * j] == 0.0 else found[2 * j] for j in range(len(probs))] if n else [None] * len(probs)
            high = [g[f"max{i}"] if few or edges[2 * j + 1] == 1.0 else found[2 * j + 1] for j in range(len(probs))] if n else [None] * len(probs)
            row += [n, low, high]
        rows.append(row)
    kept = [f for f in data.schema if f.name in by]
    fields = [T.StructField(f.name, f.dataType) for f in kept]
    for i in range(len(cols)):
        doubles = T.ArrayType(T.DoubleType())
        fields += [T.StructField(f"__n{i}", T.LongType()), T.StructField(f"__low{i}", doubles), T.StructField(f"__high{i}", doubles)]

    def beside() -> DataFrame:
        if by:
            return null_safe_join(data, F.broadcast(df.sparkSession.createDataFrame(rows, T.StructType(fields))), by)
        one = dict(zip([f.name for f in fields], zip(rows[0], fields)))
        return data.withColumns({name: _literal(value, f.dataType) for name, (value, f) in one.items()})

    less = [
        F.array(*[F.count_if(F.col(c) < F.col(f"__low{i}")[j]) for j in range(len(probs))]).alias(f"__below{i}") for i, c in enumerate(cols)
    ] + [F.array(*[F.count_if(F.col(c) <= F.col(f"__high{i}")[j]) for j in range(len(probs))]).alias(f"__upto{i}") for i, c in enumerate(cols)]
    counted = beside().groupBy(*by).agg(*less).collect()
    known = {tuple(g[b] for b in by): g for g in counted}
    for row in rows:
        g = known[tuple(row[: len(by)])]
        for i in range(len(cols)):
            n = row[len(by) + 3 * i]
            for j, p in enumerate(probs.values() if n else ()):
                place = p * (n - 1)
                if g[f"__below{i}"][j] > math.floor(place) or g[f"__upto{i}"][j] <= math.ceil(place):
                    return None
        row += [g[f"__below{i}"] for i in range(len(cols))]
    fields += [T.StructField(f"__below{i}", T.ArrayType(T.LongType())) for i in range(len(cols))]
    return beside()


def quantiles_by_cells(
    df: DataFrame, cols: Sequence[str], probs: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """``quantiles`` from the counts of all distinct values.

    The row at position h = p (n - 1) is found from cell totals; only the cells that
    hold a wanted position are sorted. No group is gathered in one buffer, unlike the
    exact ``percentile`` aggregate.
    """
    counts = value_counts_long(df, cols, by)
    keys = [*by, "column_name"]
    totals = counts.groupBy(*keys, "cell").agg(F.sum("n").alias("cell_n"))
    over_cells = Window.partitionBy(*keys).orderBy("cell")
    placed = totals.select(
        *keys,
        "cell",
        (F.sum("cell_n").over(over_cells) - F.col("cell_n")).alias("off"),
        (F.sum("cell_n").over(over_cells)).alias("end"),
        F.sum("cell_n").over(Window.partitionBy(*keys)).alias("total"),
    )

    def pos(p: float) -> Column:
        return F.lit(p) * (F.col("total") - 1)

    wanted = F.lit(False)
    for p in probs.values():
        for edge in (F.floor(pos(p)), F.ceil(pos(p))):
            wanted = wanted | ((edge >= F.col("off")) & (edge < F.col("end")))
    inside = Window.partitionBy(*keys, "cell").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        null_safe_join(counts, placed.where(wanted), [*keys, "cell"])
        .withColumn("hi", F.col("off") + F.sum("n").over(inside))
        .withColumn("lo", F.col("hi") - F.col("n"))
    )

    def at(position: Column) -> Column:
        return F.max(F.when((position >= F.col("lo")) & (position < F.col("hi")), F.col("value")))

    out = []
    for name, p in probs.items():
        low, high = at(F.floor(pos(p))), at(F.ceil(pos(p)))
        weight = F.max(pos(p) - F.floor(pos(p)))
        out.append((low + (high - low) * weight).alias(name))
    return ranked.groupBy(*keys).agg(*out)


def modes(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column_name, n_distinct, top, freq): most frequent value as text, smallest on a tie.

    Null values do not count. Two partial aggregates, no per-group value map.
    """
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols
    ]
    counts = (
        df.select(*by, F.explode(F.array(*pairs)).alias("p"))
        .select(*by, "p.*")
        .where(F.col("value").isNotNull())
        .groupBy(*by, "column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value")))
    return (
        counts.groupBy(*by, "column_name")
        .agg(F.count(F.lit(1)).alias("n_distinct"), best.alias("best"))
        .select(*by, "column_name", "n_distinct", F.col("best.value").alias("top"), (-F.col("best.neg")).alias("freq"))
    )


def hash_rank(df: DataFrame, by: Sequence[str], keys: Sequence[str], seed: int, name: str = "rank") -> DataFrame:
    """Add the exact 1-based rank of each row in its group by (hash32(keys), keys).

    A group of any size is spread over the hash cells.
    """
    hashed = df.withColumn("h__", hash32(keys, seed)).withColumn("cell__", F.floor(F.col("h__") / HASH_CELL_SHIFT))
    offsets = _cell_offsets(hashed.select(*by, "cell__", F.lit(1).alias("n")), by, "cell__", ["n"])
    w = Window.partitionBy(*by, "cell__").orderBy("h__", *keys)
    return (
        null_safe_join(hashed.withColumn("rn__", F.row_number().over(w)), offsets, [*by, "cell__"])
        .withColumn(name, F.col("rn__") + F.col("n__off"))
        .drop("h__", "cell__", "rn__", "n__off")
    )


def mark_smallest(
    df: DataFrame, take: dict, by: str | None, keys: Sequence[str], seed: int, name: str = "taken"
) -> DataFrame:
    """Flag, per class, exactly the ``take[class]`` rows with the smallest (hash32(keys), keys).

    ``take`` maps a few classes (checked) to row counts. Counts per hash cell give the cell
    where each cut falls, and only the rows of that cell are ranked. The cuts, one row per
    class, become literals: the flag is then a plain projection without join or shuffle.
    """
    if len(take) > MAX_CLASSES:
        raise ValueError(f"mark_smallest serves up to {MAX_CLASSES} classes, got {len(take)}")
    grp = F.lit(0) if by is None else F.col(by)
    classes = {i: (F.lit(True) if by is None else grp == F.lit(v)) for i, v in enumerate(take)}
    number, want = F.lit(None).cast("int"), F.lit(0).cast("bigint")
    for i, k in enumerate(take.values()):
        number = F.when(classes[i], F.lit(i)).otherwise(number)
        want = F.when(classes[i], F.lit(int(k))).otherwise(want)
    h = hash32(keys, seed)
    cell = F.floor(h / HASH_CELL_SHIFT)
    cells = (
        df.select(number.alias("g"), want.alias("k"), cell.alias("cell"))
        .where(F.col("g").isNotNull())
        .groupBy("g", "k", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("g").orderBy("cell"))
    total = F.sum("n").over(Window.partitionBy("g"))
    edges = (
        cells.withColumns({"end": upto, "total": total})
        .where(
            ((F.col("end") - F.col("n") < F.col("k")) & (F.col("k") < F.col("end")))
            | ((F.col("end") == F.col("total")) & (F.col("k") >= F.col("total")))
            | (F.col("end") == F.col("k"))
        )
        .select("g", "cell", (F.col("k") - F.col("end") + F.col("n")).alias("need"), (F.col("k") >= F.col("end")).alias("whole"))
        .collect()
    )
    # a cut at the end of a cell takes all cells up to it; a cut inside needs the ranked cell
    flags = {r["g"]: cell <= r["cell"] for r in edges if r["whole"]}
    inside = [r for r in edges if not r["whole"]]
    if inside:
        need, at_edge = F.lit(0), F.lit(False)
        for r in inside:
            here = classes[r["g"]] & (cell == r["cell"])
            need, at_edge = F.when(here, F.lit(r["need"])).otherwise(need), at_edge | here
        spots = df.where(at_edge).select(number.alias("g"), need.alias("need"), h.alias("h"), *keys)
        rank = F.row_number().over(Window.partitionBy("g").orderBy("h", *keys))
        types = {k: df.schema[k].dataType for k in keys}
        for r in spots.withColumn("rank", rank).where("rank = need").collect():
            cut = F.struct(F.lit(r["h"]).cast("bigint").alias("h"), *[F.lit(r[k]).cast(types[k]).alias(k) for k in keys])
            flags[r["g"]] = F.struct(h.alias("h"), *keys) <= cut
    flag = F.lit(False)
    for i, test in flags.items():
        flag = F.when(classes[i], test).otherwise(flag)
    return df.withColumn(name, F.coalesce(flag, F.lit(False)))


def carry_fill(
    df: DataFrame, cols: Sequence[str], order_by: str, by: Sequence[str] = (), backward: bool = True
) -> DataFrame:
    """Forward fill, then backward fill of what is left, along ``order_by`` (a unique numeric key).

    Inside a cell a running window finds the last non-null value; between cells the last
    non-null value per cell is carried over the cell list. What forward filling leaves is
    the head of a group, and its backward fill is the first non-null value of the group,
    which the cell list gives as well.
    """
    # the group key as one struct: never null itself, so window and join share one exchange
    cells = (
        value_cells(df, [order_by])
        .withColumnRenamed(f"{order_by}__cell", "cell__")
        .withColumn("group__", F.struct(*by) if by else F.lit(0))
    )
    keys = ["group__", "cell__"]
    running = Window.partitionBy(*keys).orderBy(order_by).rowsBetween(Window.unboundedPreceding, 0)
    known = {c: F.when(F.col(c).isNotNull(), F.struct(order_by, c)) for c in cols}
    per_cell = cells.groupBy(*keys).agg(
        *[F.max(k)[c].alias(f"{c}__last") for c, k in known.items()],
        *[F.min(k)[c].alias(f"{c}__first") for c, k in known.items()],
    )
    over = Window.partitionBy("group__").orderBy("cell__")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = per_cell.select(
        *keys,
        *[F.last(f"{c}__last", ignorenulls=True).over(before).alias(f"{c}__prev") for c in cols],
        *[F.first(f"{c}__first", ignorenulls=True).over(whole).alias(f"{c}__head") for c in cols],
    )
    if not by:
        carried = F.broadcast(carried)  # one row per cell: as many as shuffle partitions
    filled_inside = cells.withColumns({f"{c}__f": F.last(c, ignorenulls=True).over(running) for c in cols})
    tail = ["__head"] if backward else []
    filled = {c: F.coalesce(*[F.col(f"{c}{s}") for s in ("__f", "__prev", *tail)]) for c in cols}
    return filled_inside.join(carried, keys, "left").withColumns(filled).select(*df.columns)
