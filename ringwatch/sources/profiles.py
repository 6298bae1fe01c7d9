"""Historical wallet profiles: reading, key checks and upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.schema import PROFILE

_PROFILE_VALUES = ["first_seen_ts", "historical_tx_count", "historical_risk_tier"]


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Profiles from header CSV with times such as ``2024-05-01 10:00:00+00:00``."""
    return (
        spark.read.schema(PROFILE)
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ssXXX")
        .csv(path))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Fail the load when a key repeats; otherwise hand the frame on."""
    worst = duplicate_keys(df, *keys).orderBy(F.desc("n_rows")).limit(5).collect()
    if worst:
        raise ValueError(f"duplicate keys {keys}: {[row.asDict() for row in worst]}")
    return df


def upsert_profiles(wallets: DataFrame, profiles: DataFrame) -> DataFrame:
    """Put the three profile values of ``profiles`` onto ``wallets``; other columns stay.

    Unknown wallets are added. A given profile replaces the old values even where it is NULL.
    """
    new = profiles.select("wallet_address", F.struct(*_PROFILE_VALUES).alias("_new"))
    joined = wallets.join(new, "wallet_address", "full_outer")
    given = F.col("_new").isNotNull()
    values = {
        c: F.when(given, F.col(f"_new.{c}")).otherwise(F.col(c)) if c in wallets.columns else F.col(f"_new.{c}")
        for c in _PROFILE_VALUES}
    return joined.withColumns(values).drop("_new")
