"""Wallet context: how it is derived and how it is joined to windows."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.config import BROADCAST_ROWS, BUSY_SLOTS, BUSY_TRANSFERS, UNKNOWN_TIER
from ringwatch.functions.scalars import l2_distance, min_max
from ringwatch.schema import CONTEXT
from ringwatch.session import cut


def structural_novelty(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Add ``structural_novelty_score``: distance of ``vector`` to the mean vector, scaled to [0, 1].

    Rows without a vector take no part in the mean or the scaling and score 0. The mean and the
    bounds are single rows, read as scalar subqueries.
    """
    has_vector = F.col(vector).isNotNull() & (F.size(vector) > 0)
    wide = F.col(vector).cast("array<double>")
    centroid = df.filter(has_vector).agg(vector_to_array(Summarizer.mean(array_to_vector(wide))).alias("c")).scalar()
    # The mean is a column of its own first: array lambdas take no subquery.
    measured = df.withColumn("_centroid", centroid).withColumn(
        "_distance", F.when(has_vector, l2_distance(wide, F.col("_centroid")))).drop("_centroid")
    bounds = measured.agg(F.struct(F.min("_distance").alias("low"), F.max("_distance").alias("high"))).scalar()
    scaled = min_max(F.col("_distance"), bounds.getField("low"), bounds.getField("high"))
    return measured.withColumn(
        "structural_novelty_score", F.coalesce(scaled, F.lit(0.0))).drop("_distance")


def graph_risk(df: DataFrame) -> DataFrame:
    """Add ``graph_risk_score`` from scaled pagerank, scaled betweenness and ring membership."""
    bounds = df.agg(F.struct(
        F.min("pagerank").alias("pr_low"), F.max("pagerank").alias("pr_high"),
        F.min("betweenness").alias("bt_low"), F.max("betweenness").alias("bt_high"))).scalar()
    rank = min_max(F.col("pagerank"), bounds.getField("pr_low"), bounds.getField("pr_high"))
    between = min_max(F.col("betweenness"), bounds.getField("bt_low"), bounds.getField("bt_high"))
    # The weights of the three parts.
    score = 0.4 * rank + 0.3 * between + F.when(F.col("in_wash_ring"), 0.3).otherwise(0.0)
    return df.withColumn("graph_risk_score", F.least(F.lit(1.0), score))


def fill_context(wallets: DataFrame) -> DataFrame:
    """Defaults for wallets that lack profile, activity or graph results."""
    return wallets.withColumns({
        "historical_tx_count": F.coalesce("historical_tx_count", F.lit(0)).cast("long"),
        "historical_risk_tier": F.coalesce("historical_risk_tier", F.lit(UNKNOWN_TIER)),
        "live_tx_count": F.coalesce("live_tx_count", F.lit(0)).cast("long"),
        "pagerank": F.coalesce("pagerank", F.lit(0.0)),
        "betweenness": F.coalesce("betweenness", F.lit(0.0)),
        "community_id": F.coalesce("community_id", F.lit(-1)).cast("long"),
        "in_wash_ring": F.coalesce("in_wash_ring", F.lit(False))})


def build_context(wallets: DataFrame) -> DataFrame:
    """One row per wallet with everything the detectors look up."""
    scored = structural_novelty(graph_risk(fill_context(wallets)))
    return scored.select(*CONTEXT.fieldNames())


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` is measured to have at most ``max_rows`` rows."""
    return df.count() <= max_rows


def enrich(rows: DataFrame, context: DataFrame, max_rows: int = BROADCAST_ROWS,
           known_rows: int | None = None, busy_from: int = BUSY_TRANSFERS, slots: int = BUSY_SLOTS) -> DataFrame:
    """Left join of the sender's context; wallets without one keep NULLs.

    The context is broadcast only when its row count, measured here or recorded with its snapshot, is within
    ``max_rows``. Beyond it both sides are shuffled, and the rows of busy senders are dealt over ``slots``
    tasks, each of which gets a copy of their context: a streaming batch with state is planned without the
    adaptive execution that would split them. Senders are busy from ``busy_from`` live transfers on; without
    that column, or the columns that tell windows apart, splitting is left to adaptive execution.
    """
    if known_rows is None:
        context = cut(context)
        known_rows = context.count()
    if known_rows <= max_rows:
        return rows.join(F.broadcast(context), "wallet_address", "left")
    if "live_tx_count" not in context.columns or not {"to_wallet", "window_start"} <= set(rows.columns):
        return rows.join(context, "wallet_address", "left")
    # A sender's transfers are counted, so there cannot be more busy ones than transfers / busy_from.
    busy = context.filter(F.col("live_tx_count") >= busy_from).select("wallet_address", F.lit(True).alias("_busy"))
    if fits_broadcast(busy, max_rows):
        busy = F.broadcast(busy)
    deal = F.pmod(F.xxhash64("to_wallet", "window_start"), F.lit(slots)).cast("int")
    dealt = rows.join(busy, "wallet_address", "left").withColumn("_slot", F.when(F.col("_busy"), deal).otherwise(0)).drop("_busy")
    copies = F.when(F.col("live_tx_count") >= busy_from, F.sequence(F.lit(0), F.lit(slots - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(context.withColumn("_slot", F.explode(copies)), ["wallet_address", "_slot"], "left").drop("_slot")
