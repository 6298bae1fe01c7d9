"""Sliding event-time statistics per (sender, receiver)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.config import NORMAL_LABEL, WindowConfig

KEYS = ["wallet_address", "to_wallet"]


def _label() -> Column:
    """Any label other than normal wins; of several, the last by name."""
    label = F.col("true_label")
    return F.coalesce(F.max(F.when(label != NORMAL_LABEL, label)), F.max(label))


def pair_windows(transfers: DataFrame, cfg: WindowConfig = WindowConfig(), watermark: bool = False) -> DataFrame:
    """One row per (window, sender, receiver); works on batch and streaming frames.

    Each transfer falls into size / slide windows. Rows are combined before the shuffle, so a pair
    that holds much of the data costs one partial row per window and task.
    """
    df = transfers.withWatermark("timestamp", cfg.watermark) if watermark else transfers
    stats = df.groupBy(F.window("timestamp", cfg.size, cfg.slide).alias("window"), *KEYS).agg(
        F.avg("amount_usd").alias("mean_amount"),
        F.stddev("amount_usd").alias("stddev_amount"),
        F.max("amount_usd").alias("max_amount"),
        F.sum("amount_usd").alias("total_amount_usd"),
        F.count("tx_id").alias("tx_count"),
        F.avg("gas_fee").alias("avg_gas_fee"),
        F.min(F.struct("timestamp", "tx_id")).getField("tx_id").alias("sample_tx_id"),
        _label().alias("true_label"),
        F.max("timestamp").alias("last_seen_ts"))
    return stats.withColumn("window_start", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss"))


def _pane_parts() -> list[Column]:
    """What a pane keeps of its transfers."""
    return [
        F.count("amount_usd").alias("n_amount"),
        F.sum("amount_usd").alias("sum_amount"),
        F.avg("amount_usd").alias("pane_mean"),
        F.var_pop("amount_usd").alias("pane_var"),
        F.min("amount_usd").alias("min_amount"),
        F.max("amount_usd").alias("max_amount"),
        F.count("tx_id").alias("tx_count"),
        F.sum("gas_fee").alias("sum_gas"),
        F.count("gas_fee").alias("n_gas"),
        F.min(F.struct("timestamp", "tx_id")).alias("first_tx"),
        F.max(F.when(F.col("true_label") != NORMAL_LABEL, F.col("true_label"))).alias("odd_label"),
        F.max("true_label").alias("any_label"),
        F.max("timestamp").alias("last_seen_ts")]


def _merged_parts() -> list[Column]:
    """What a window makes of its panes."""
    return [
        F.sum("n_amount").alias("n_amount"),
        F.sum("sum_amount").alias("total_amount_usd"),
        F.collect_list(F.struct("n_amount", "pane_mean", "pane_var")).alias("parts"),
        F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"),
        F.sum("tx_count").alias("tx_count"),
        F.sum("sum_gas").alias("sum_gas"),
        F.sum("n_gas").alias("n_gas"),
        F.min("first_tx").getField("tx_id").alias("sample_tx_id"),
        F.coalesce(F.max("odd_label"), F.max("any_label")).alias("true_label"),
        F.max("last_seen_ts").alias("last_seen_ts")]


def _window_rows(merged: DataFrame, start: Column, end: Column) -> DataFrame:
    """The columns of ``pair_windows`` from merged panes."""
    merged = merged.withColumn("mean_amount", F.try_divide("total_amount_usd", "n_amount"))
    # Squared deviations about the window mean: within each pane, plus between panes.
    spread = F.aggregate(
        "parts", F.lit(0.0),
        lambda total, p: total + F.coalesce(
            p["n_amount"] * (p["pane_var"] + (p["pane_mean"] - F.col("mean_amount")) ** 2), F.lit(0.0)))
    stddev = (
        F.when(F.col("n_amount") < 2, F.lit(None).cast("double"))
        .when(F.col("min_amount") == F.col("max_amount"), F.lit(0.0))
        .otherwise(F.sqrt(spread / F.greatest(F.col("n_amount") - 1, F.lit(1)))))
    return merged.select(
        F.struct(start.alias("start"), end.alias("end")).alias("window"),
        *KEYS, "mean_amount", stddev.alias("stddev_amount"), "max_amount", "total_amount_usd", "tx_count",
        F.try_divide("sum_gas", "n_gas").alias("avg_gas_fee"),
        "sample_tx_id", "true_label", "last_seen_ts",
        F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("window_start"))


def pair_windows_by_pane(transfers: DataFrame, size_seconds: int, slide_seconds: int) -> DataFrame:
    """The same rows for data at rest, aggregating once into slide-wide panes.

    Worth it when many transfers of a pair share a pane: each transfer is then touched once
    instead of size / slide times. A window merges at most size / slide panes.
    """
    if size_seconds % slide_seconds:
        raise ValueError("size must be a multiple of slide")
    panes_per_window = size_seconds // slide_seconds
    pane = F.floor(F.unix_seconds("timestamp") / F.lit(slide_seconds)).alias("pane")
    panes = transfers.groupBy(*KEYS, pane).agg(*_pane_parts())

    first = F.col("pane") - F.lit(panes_per_window - 1)
    merged = panes.withColumn("start_pane", F.explode(F.sequence(first, F.col("pane")))).groupBy(*KEYS, "start_pane").agg(*_merged_parts())
    start = F.timestamp_seconds(F.col("start_pane") * slide_seconds)
    end = F.timestamp_seconds(F.col("start_pane") * slide_seconds + size_seconds)
    return _window_rows(merged, start, end)


def final_pair_windows(transfers: DataFrame, cfg: WindowConfig = WindowConfig()) -> DataFrame:
    """The same rows for a stream in append mode: each window once, when the watermark has passed its end.

    Two aggregations with state follow each other. A transfer touches one state row, that of its pane; it is
    combined with others of its pane before the shuffle, so a busy pair is no burden. A pane that the
    watermark has closed then goes into the windows it belongs to. Transfers that come after their pane
    was closed are dropped, from all its windows alike.
    """
    panes = transfers.withWatermark("timestamp", cfg.watermark).groupBy(
        F.window("timestamp", cfg.slide).alias("pane"), *KEYS).agg(*_pane_parts())
    merged = panes.groupBy(F.window("pane", cfg.size, cfg.slide).alias("window"), *KEYS).agg(*_merged_parts())
    return _window_rows(merged, F.col("window.start"), F.col("window.end"))
