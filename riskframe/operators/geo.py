"""Country of a numeric IP address: a range join re-expressed as an equi-join on address bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOW, HIGH, NAME = "lower_bound_ip_address", "upper_bound_ip_address", "country"
BIN_BITS = 16
BIN = 1 << BIN_BITS
# Segments up to this number are broadcast (about 100 MB); beyond it the join shuffles.
BROADCAST_SEGMENTS = 2_000_000


def _by_bin(ranges: DataFrame) -> DataFrame:
    """Each range cut at the bin borders it crosses."""
    return (
        ranges.where(f"{LOW} <= {HIGH}")
        .withColumn("bin", F.explode(F.sequence(F.shiftright(F.col(LOW), BIN_BITS), F.shiftright(F.col(HIGH), BIN_BITS))))
        .withColumn("lo", F.greatest(F.col(LOW), F.col("bin") * BIN))
        .withColumn("hi", F.least(F.col(HIGH), (F.col("bin") + 1) * BIN - 1))
    )


def segments(ranges: DataFrame) -> DataFrame:
    """Non-overlapping (bin, lo, hi, country): in an overlap the range with the smallest bounds wins.

    The border points of a bin cut it into elementary pieces; every piece takes the first
    range that covers it. All work is inside a bin.
    """
    cut = _by_bin(ranges)
    points = cut.select("bin", F.explode(F.array("lo", F.col("hi") + 1)).alias("lo")).distinct()
    pieces = points.withColumn(
        "hi", F.lead("lo").over(Window.partitionBy("bin").orderBy("lo")) - 1
    ).where(F.col("hi").isNotNull())
    r = cut.select("bin", F.col("lo").alias("r_lo"), F.col("hi").alias("r_hi"), LOW, HIGH, NAME)
    return (
        pieces.join(r, "bin")
        .where("r_lo <= lo and hi <= r_hi")
        .groupBy("bin", "lo", "hi")
        .agg(F.min(F.struct(LOW, HIGH, NAME))[NAME].alias(NAME))
    )


def asof_segments(ranges: DataFrame) -> DataFrame:
    """Pieces where a range has the nearest lower bound at or below the address, cut at its upper bound.

    The next lower bound is looked up inside the bin, and from the next filled bin
    otherwise. Of ranges with one lower bound, the one with the greatest upper bound counts.
    """
    best = ranges.groupBy(LOW).agg(F.max(HIGH).alias(HIGH), F.max_by(NAME, HIGH).alias(NAME))
    starts = best.withColumn("home", F.shiftright(F.col(LOW), BIN_BITS))
    # one row per filled bin: at most 65536 for IPv4 addresses
    first = starts.groupBy("home").agg(F.min(LOW).alias("first_low"))
    following = first.select("home", F.lead("first_low").over(Window.orderBy("home")).alias("next_bin_low"))
    nearest = (
        starts.withColumn("next_low", F.lead(LOW).over(Window.partitionBy("home").orderBy(LOW)))
        .join(following, "home")
        .withColumn("stop", F.coalesce("next_low", "next_bin_low"))
        .select(LOW, F.least(F.col(HIGH), F.col("stop") - 1).alias(HIGH), NAME)
    )
    return _by_bin(nearest).select("bin", "lo", "hi", NAME)


def map_ip(df: DataFrame, ranges: DataFrame, ip: str = "ip_address", mode: str = "range") -> DataFrame:
    """Add ``ip_address_int`` and ``country`` ('Unknown' outside all ranges).

    Modes: 'range' (first range that holds the address), 'asof' (nearest lower bound, then
    the upper bound), 'exact' (address equals a lower bound). Every row matches at most
    one segment, so the row count never changes and no row key is needed.
    """
    bounds = ranges.select(F.col(LOW).cast("bigint").alias(LOW), F.col(HIGH).cast("bigint").alias(HIGH), NAME)
    if mode == "range":
        segs = segments(bounds)
    elif mode == "asof":
        segs = asof_segments(bounds)
    elif mode == "exact":
        segs = (
            bounds.groupBy(F.col(LOW).alias("lo"))
            .agg(F.min_by(NAME, HIGH).alias(NAME))
            .select(F.shiftright(F.col("lo"), BIN_BITS).alias("bin"), "lo", F.col("lo").alias("hi"), NAME)
        )
    else:
        raise ValueError(f"Invalid mode: {mode}. Must be 'range', 'asof' or 'exact'")
    if segs.limit(BROADCAST_SEGMENTS + 1).count() <= BROADCAST_SEGMENTS:
        segs = F.broadcast(segs)
    rows = df.withColumn("ip_address_int", F.col(ip).cast("bigint"))
    left, right = rows.alias("t"), segs.withColumnRenamed("bin", "bin__").alias("s")
    hit = (
        (F.shiftright(F.col("t.ip_address_int"), BIN_BITS) == F.col("s.bin__"))
        & (F.col("t.ip_address_int") >= F.col("s.lo"))
        & (F.col("t.ip_address_int") <= F.col("s.hi"))
    )
    return left.join(right, hit, "left").select("t.*", F.coalesce(f"s.{NAME}", F.lit("Unknown")).alias(NAME))


def coverage(df: DataFrame, country: str = NAME) -> DataFrame:
    """One row: distinct countries, rows without a country, all rows."""
    return df.agg(
        F.count_distinct(country).alias("countries"),
        F.count_if(F.col(country) == "Unknown").alias("unknown_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )
