"""Column expressions used across the jobs; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_stddev(stddev: Column) -> Column:
    """A usable divisor: a missing or zero spread counts as 1."""
    return F.when(stddev.isNull() | (stddev == 0), F.lit(1.0)).otherwise(stddev)


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; when all values are equal the result is 0."""
    span = F.when(high == low, F.lit(1.0)).otherwise(high - low)
    return (value - low) / span


def l2_distance(left: Column, right: Column) -> Column:
    squares = F.zip_with(left, right, lambda a, b: (a - b) * (a - b))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def short_address(address: Column) -> Column:
    """First eight and last four characters, for display."""
    shown = F.concat(F.substring(address, 1, 8), F.lit("…"), F.right(address, F.lit(4)))
    return F.when(address.isNull() | (address == ""), F.lit("unknown")).otherwise(shown)


def draw(*parts: Column | str | int) -> Column:
    """A repeatable whole number in [0, 2^32) that depends only on the given parts.

    Built on md5 so that other SQL systems can reproduce it.
    """
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    digest = F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def unit_draw(*parts: Column | str | int) -> Column:
    """A repeatable number in [0, 1)."""
    return draw(*parts) / F.lit(4294967296.0)
