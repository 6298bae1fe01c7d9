"""Consecutive numbers in sort order without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.session import cut, shuffle_width

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition here


def number_rows(df: DataFrame, name: str, *order: str) -> DataFrame:
    """Add ``name`` = 0, 1, 2, … following ``order``, which must be a total order.

    Rows are range-partitioned and sorted per task; only the row count of each partition is
    brought together, to turn places within a partition into places overall.
    """
    ranged = df.repartitionByRange(shuffle_width(df.sparkSession), *order).sortWithinPartitions(*order)
    placed = cut(ranged.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", _POSITION_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts, total = {}, 0
    for row in sizes:
        starts[row["part"]] = total
        total += row["n"]
    base = F.lit(0)
    if starts:
        table = F.array(*[F.lit(starts.get(i, 0)) for i in range(max(starts) + 1)])
        base = F.get(table, part.cast("int"))
    place = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return placed.withColumn(name, (base + place).cast("long")).drop("_place")
