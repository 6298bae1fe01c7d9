"""The outlier statistic, the ordered rules and the final verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.config import REASON_BURST, REASON_LARGE, REASON_ML, REASON_SPIKE, RuleConfig
from ringwatch.functions.scalars import safe_stddev


def z_score() -> Column:
    """How far the largest amount lies above the window mean, in standard deviations.

    For n rows it cannot exceed (n - 1) / sqrt(n): a limit of 3 needs at least 11 transfers.
    """
    return (F.col("max_amount") - F.col("mean_amount")) / safe_stddev(F.col("stddev_amount"))


def rule_reason(cfg: RuleConfig) -> Column:
    """The first rule that holds, or NULL."""
    spike = (F.col("tx_count") >= cfg.z_min_samples) & (F.abs("z_score") > cfg.z_limit)
    return (
        F.when(F.col("max_amount") > cfg.large_amount, REASON_LARGE)
        .when(spike, REASON_SPIKE)
        .when(F.col("tx_count") > cfg.burst_count, REASON_BURST))


def apply_rules(windows: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    return (
        windows.withColumn("z_score", z_score())
        .withColumn("rule_reason", rule_reason(cfg)))


def verdict(scored: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Model verdict from ``ml_score``, and one reason per row; rules go before the model."""
    flagged = F.coalesce(F.col("ml_score") < threshold, F.lit(False))
    return scored.withColumn("ml_anomaly", flagged).withColumn(
        "anomaly_reason", F.coalesce("rule_reason", F.when(F.col("ml_anomaly"), REASON_ML)))


def without_model(rows: DataFrame) -> DataFrame:
    """Rows as they stand when no model is available."""
    return verdict(rows.withColumn("ml_score", F.lit(None).cast("double")))


def anomalies(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("anomaly_reason").isNotNull())
