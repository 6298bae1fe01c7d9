"""Exact quantiles without sorting everything or holding it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The sketch places a value within 1 / ACCURACY of the rows.
ACCURACY = 10_000


def exact_quantile(df: DataFrame, column: str, q: float, small: int = 100_000) -> float | None:
    """The ``q`` quantile of ``column`` with linear interpolation, NULLs left out.

    One scan makes a quantile sketch, whose error in rank has a proven bound, and takes a lower and an upper
    value from it that the wanted rank must lie between. A second scan counts what is below and gathers the
    values between, equal ones as one row. Where more than ``small`` rows lie between, those alone are
    sketched again: that takes more than ``small`` * ACCURACY / 6 rows, whatever their distribution.
    """
    values = df.select(F.col(column).cast("double").alias("x")).filter("x IS NOT NULL")
    # The error to either side, as much again to be sure, and the next rank.
    margin = 3.0 / ACCURACY + 2.0 / small
    below, total, share = 0, None, q
    while True:
        shares = F.array(F.lit(max(0.0, share - margin)), F.lit(min(1.0, share + margin)))
        seen = values.agg(
            F.count("x").alias("n"), F.percentile_approx("x", shares, F.lit(ACCURACY)).alias("ends"), F.min("x").alias("low"),
            F.max("x").alias("high")).first()
        if total is None:
            total = inside = seen["n"]
            if not total:
                return None
            place = q * (total - 1)
        # Where the margin reaches past an end, or there are few rows, the end itself is the bracket.
        low = seen["low"] if share <= margin or total <= small else seen["ends"][0]
        high = seen["high"] if share >= 1 - margin or total <= small else seen["ends"][1]
        between = F.col("x").between(low, high)
        counts = values.agg(F.count_if(F.col("x") < low).alias("under"), F.count_if(between).alias("inside")).first()
        narrowed = counts["inside"] < inside
        below, inside, values = below + counts["under"], counts["inside"], values.filter(between)
        if inside <= small or low == high or not narrowed:
            break
        share = (place - below) / (inside - 1)
    # The next rank may be the first above the bracket.
    following = df.select(F.col(column).cast("double").alias("x")).filter(F.col("x") > high).agg(F.min("x")).first()[0]
    return _ranked(values, place, below, high if following is None else following)


def _ranked(values: DataFrame, place: float, below: int, following: float) -> float:
    """Interpolates between the values at a place that is not whole; ``below`` rows come before ``values``."""
    rank, found = int(place), []
    ladder = values.groupBy("x").agg(F.count("x").alias("n")).orderBy("x").collect()
    for row in ladder:
        below += row["n"]
        while len(found) < 2 and below > rank + len(found):
            found.append(row["x"])
    found += [following] * (2 - len(found))
    return found[0] if place == rank else found[0] + (found[1] - found[0]) * (place - rank)
