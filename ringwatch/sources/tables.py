"""Views of the given star-schema tables in the shapes the jobs work on.

Wallet names: ``w`` for event users, ``cu`` for customers, ``su`` for suppliers, ``c_`` for the
contracts that event types stand for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringwatch.sources.transfers import conform


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users paying five contracts, one per event type."""
    k = F.get_json_object("props", "$.k").cast("long")
    label = F.when(F.col("value") > 300, "flash_loan").when(k % 50 == 0, "bot_burst").otherwise("normal")
    return conform(
        table(spark, sf_dir, "events").select(
            F.concat(F.lit("tx"), "event_id").alias("tx_id"),
            F.concat(F.lit("w"), "user_id").alias("wallet_address"),
            F.concat(F.lit("c_"), "event_type").alias("to_wallet"),
            F.col("value").alias("amount_usd"),
            (k / F.lit(1000.0)).alias("gas_fee"),
            label.alias("true_label"),
            F.col("ts").alias("timestamp")))


def _sold_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax", "l_shipdate")
    return items.join(orders, items.l_orderkey == orders.o_orderkey)


def purchase_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers paying suppliers, one transfer per line item."""
    item_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return conform(
        _sold_items(spark, sf_dir).select(
            F.concat(F.lit("tx"), item_id).alias("tx_id"),
            F.concat(F.lit("cu"), "o_custkey").alias("wallet_address"),
            F.concat(F.lit("su"), "l_suppkey").alias("to_wallet"),
            F.col("l_extendedprice").alias("amount_usd"),
            F.col("l_tax").alias("gas_fee"),
            F.lit(None).cast("string").alias("true_label"),
            F.col("l_shipdate").alias("timestamp")))


def lot_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers paying customers: whoever buys a part pays the one who opened that part's
    two-week lot. One row per transfer, as (src, dst, w).

    Items are brought to their lot once; the opener is looked up there, in a window that can spill. Items without a
    part or a date are in no lot.
    """
    lots = _sold_items(spark, sf_dir).select(
        "l_partkey", "o_custkey", "l_orderkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("w"), "l_shipdate",
        F.floor(F.datediff("l_shipdate", F.lit("1970-01-01").cast("date")) / 14).alias("lot"))
    first = F.min(F.struct("l_shipdate", "l_orderkey", "o_custkey")).over(Window.partitionBy("l_partkey", "lot"))
    return (
        lots.filter(F.col("l_partkey").isNotNull() & F.col("lot").isNotNull())
        .withColumn("opener", first.getField("o_custkey"))
        .filter(F.col("o_custkey") != F.col("opener"))
        .select(
            F.concat(F.lit("cu"), "o_custkey").alias("src"),
            F.concat(F.lit("cu"), "opener").alias("dst"),
            "w"))


def customer_profiles(spark: SparkSession, sf_dir: str, prefix: str = "w") -> DataFrame:
    """Profiles of all customers; the balance decides the risk tier."""
    history = (
        table(spark, sf_dir, "orders").groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first_seen"), F.count(F.lit(1)).alias("n_orders")))
    tier = F.when(F.col("c_acctbal") < 0, "high").when(F.col("c_acctbal") < 2500, "medium").otherwise("low")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return customers.join(history, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.concat(F.lit(prefix), "c_custkey").alias("wallet_address"),
        F.col("first_seen").cast("timestamp").alias("first_seen_ts"),
        F.coalesce("n_orders", F.lit(0)).alias("historical_tx_count"),
        tier.alias("historical_risk_tier"))
