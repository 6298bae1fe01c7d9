"""Distinct counts that can be merged: bitmaps over whole numbers.

A state is a table of (bucket, bitmap), 32,768 numbers to a bucket. States of batches are put together by
joining their bits, whatever they have in common; a replayed batch changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bits_of(df: DataFrame, number: str) -> DataFrame:
    """(bucket, bitmap) of the numbers in a column; nulls are none."""
    return df.filter(F.col(number).isNotNull()).groupBy(F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))


def merged(*states: DataFrame) -> DataFrame:
    """One state of all the numbers in any of them."""
    return reduce(DataFrame.unionByName, states).groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_of(state: DataFrame, name: str = "n") -> DataFrame:
    """One row: how many numbers the state holds."""
    return state.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias(name))
