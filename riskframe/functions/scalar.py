"""Column expressions: time parts, time differences, bins, hashes, normalisation.

Everything here is a built-in expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000

# Right-closed bins of hours since signup: (lower, upper, label). Fixed values.
SIGNUP_BINS = (
    (0.0, 1.0, "0-1h"),
    (1.0, 24.0, "1-24h"),
    (24.0, 168.0, "24-168h"),
    (168.0, float("inf"), ">168h"),
)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, as a bigint."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.timestamp_diff("MICROSECOND", epoch, col(ts).cast("timestamp_ntz"))


def hours_between(start: str | Column, end: str | Column) -> Column:
    """Fractional hours from ``start`` to ``end``."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(float(MICROS_PER_HOUR))


def day_of_week(ts: str | Column) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(col(ts))


def right_closed_bin(value: str | Column, bins=SIGNUP_BINS) -> Column:
    """Label of the bin ``(lower, upper]`` that holds the value; null outside all bins."""
    v = col(value)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for low, high, label in bins:
        inside = v > low
        if high != float("inf"):
            inside = inside & (v <= high)
        out = out.when(inside, label)
    return out


def clamp01(value: str | Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), col(value)))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den``, and 0 where the denominator is not positive."""
    return F.when(col(den) > 0, col(num) / col(den)).otherwise(F.lit(0.0))


def hash32(keys: Sequence[str | Column], seed: int) -> Column:
    """Seeded 32-bit hash of the row key, as a bigint in [0, 2^32).

    Depends on the key alone, so a row draws the same number whatever the
    partitioning, and a task that is run again draws it again.
    """
    text = F.concat_ws("|", *[col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uniform(keys: Sequence[str | Column], seed: int) -> Column:
    """Seeded uniform number in [0, 1) from the row key."""
    return hash32(keys, seed) / F.lit(4294967296.0)


def contains_any(text: str | Column, words: Sequence[str]) -> Column:
    """True where the lower-cased text holds one of the words as a substring."""
    lowered = F.lower(col(text))
    out = F.lit(False)
    for word in words:
        out = out | lowered.contains(word)
    return out
