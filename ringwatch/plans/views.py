"""Summary views over stored edges, wallets and batch metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.config import UNKNOWN_TIER
from ringwatch.functions.scalars import short_address
from ringwatch.operators.distinct import bits_of, count_of

RECENT_ROWS = 50
SHOWN_ROWS = 20


def batch_metrics(sent: DataFrame) -> DataFrame:
    """One row per batch: updated groups, their transfers, anomalies and mean z (NULL counts as 0)."""
    return sent.groupBy("batch_id").agg(
        F.lit("active").alias("status"),
        F.count(F.lit(1)).alias("groups_updated"),
        F.coalesce(F.sum("tx_count"), F.lit(0)).alias("transactions"),
        F.count_if(F.col("anomaly_reason").isNotNull()).alias("anomalies"),
        F.round(F.avg(F.coalesce("z_score", F.lit(0.0))), 2).alias("avg_z_score"))


def last_batch(sent: DataFrame) -> DataFrame:
    """All rows of the last batch."""
    return sent.filter(F.col("batch_id") == sent.agg(F.max("batch_id")).scalar())


def recent_rows(sent: DataFrame, rows: int = RECENT_ROWS) -> DataFrame:
    """A listing of the first rows of the last batch, in key order."""
    return last_batch(sent).orderBy("window_start", "wallet_address", "to_wallet").limit(rows)


def metrics_summary(metrics: DataFrame, recent: DataFrame) -> DataFrame:
    """Running totals, the last batch's values, and what its recent rows add up to.

    Totals come from one row per batch, so a batch written twice counts once. ``recent`` is the whole last
    batch; besides its sums, the summary lists its first ``SHOWN_ROWS`` rows with all their columns.
    """
    total = metrics.agg(
        F.coalesce(F.max_by("status", "batch_id"), F.lit("initializing")).alias("status"),
        F.coalesce(F.sum("groups_updated"), F.lit(0)).alias("total_processed"),
        F.coalesce(F.sum("anomalies"), F.lit(0)).alias("total_anomalies"),
        F.max("batch_id").alias("last_batch_id"),
        F.coalesce(F.max_by("avg_z_score", "batch_id"), F.lit(0.0)).alias("avg_z_score"))
    keys = ["window_start", "wallet_address", "to_wallet", "tx_id"]
    columns = [*keys, *[c for c in recent.columns if c not in keys]]
    rows = recent.orderBy(*keys).limit(SHOWN_ROWS).agg(F.sort_array(F.collect_list(F.struct(*columns)))).scalar()
    shown = recent.agg(F.struct(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.round(F.sum(F.coalesce("gas_fee", F.lit(0.0))) / F.greatest(F.count(F.lit(1)), F.lit(1)), 4),
                   F.lit(0.0)).alias("gas"),
        F.coalesce(F.sum("tx_count"), F.lit(0)).alias("tx"))).scalar()
    return total.select(
        "*", shown.getField("n").alias("recent_batch_record_count"),
        shown.getField("gas").alias("recent_avg_gas_fee"),
        shown.getField("tx").alias("recent_total_tx_count"),
        rows.alias("recent_records"))


def wash_rings(wallets: DataFrame) -> DataFrame:
    """(ring_id, wallets): the flagged wallets by ring; a ring has no more members than hops."""
    return (
        wallets.filter("in_wash_ring").groupBy(F.col("wash_ring_id").alias("ring_id"))
        .agg(F.sort_array(F.collect_list("wallet_address")).alias("wallets")).orderBy("ring_id"))


def top_risk_wallets(wallets: DataFrame, limit: int = 20) -> DataFrame:
    return (
        wallets.filter(F.col("pagerank").isNotNull())
        .select(
            "wallet_address", "pagerank", "community_id",
            F.coalesce("in_wash_ring", F.lit(False)).alias("in_wash_ring"),
            F.coalesce("historical_risk_tier", F.lit(UNKNOWN_TIER)).alias("historical_risk_tier"))
        .orderBy(F.desc("pagerank"), "wallet_address").limit(limit))


def _newest(sent: DataFrame, limit: int) -> DataFrame:
    """Newest first; rows without a time lead, ties follow the edge key."""
    return sent.orderBy(
        F.desc_nulls_first("timestamp"), "wallet_address", "to_wallet", "window_start").limit(limit)


def recent_edges(sent: DataFrame, limit: int = 150) -> DataFrame:
    return _newest(sent, limit).select(
        F.col("wallet_address").alias("from_wallet"), "to_wallet", "amount_usd", "anomaly_reason", "timestamp")


def transaction_listing(sent: DataFrame, limit: int = 20) -> DataFrame:
    return _newest(sent, limit).select(
        "tx_id", "wallet_address", "to_wallet", "amount_usd", "gas_fee", "anomaly_reason",
        "z_score", "ml_score", "ml_anomaly", "timestamp")


def wallet_listing(wallets: DataFrame) -> DataFrame:
    return wallets.select(
        "wallet_address", "first_seen_ts", "historical_tx_count", "historical_risk_tier", "pagerank",
        "community_id", F.coalesce("in_wash_ring", F.lit(False)).alias("in_wash_ring"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL being a value of its own."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def tier_counts(wallets: DataFrame) -> DataFrame:
    """Wallets and ring members per risk tier."""
    return wallets.groupBy("historical_risk_tier").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("in_wash_ring").alias("n_in_ring"))


def graph_summary(wallets: DataFrame, sent: DataFrame) -> DataFrame:
    """Wallets, edges sent by them, ring members and communities.

    Edges are counted per sender before the join, so a busy sender meets its wallet as one row. Communities
    are numbers and are counted by bitmaps.
    """
    sends = sent.groupBy("wallet_address").agg(F.count(F.lit(1)).alias("n_edges"))
    communities = count_of(bits_of(wallets, "community_id")).scalar()
    return wallets.join(sends, "wallet_address", "left").agg(
        F.count(F.lit(1)).alias("wallet_count"),
        F.coalesce(F.sum("n_edges"), F.lit(0)).alias("edge_count"),
        F.count_if("in_wash_ring").alias("ring_wallet_count")).withColumn("community_count", communities)


def draw_nodes(top: DataFrame, rings: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes to draw: ranked wallets and the ends of recent edges, with class, size and label."""
    ends = edges.select(F.explode(F.array("from_wallet", "to_wallet")).alias("wallet_address"))
    everyone = top.select("wallet_address").union(ends).distinct()
    ranks = top.select("wallet_address", "pagerank")
    members = rings.select(F.explode("wallets").alias("wallet_address")).distinct().withColumn("member", F.lit(True))
    # Sizes, the hub share and the least rank to scale by.
    highest = top.agg(F.greatest(F.max("pagerank"), F.lit(0.0001)).alias("m")).scalar()
    relative = F.coalesce(F.col("pagerank") / highest, F.lit(0.0))
    return everyone.join(ranks, "wallet_address", "left").join(members, "wallet_address", "left").select(
        "wallet_address", short_address(F.col("wallet_address")).alias("label"),
        F.when(F.col("member"), "ring").when(relative > 0.6, "hub").otherwise("normal").alias("node_class"),
        F.when(F.col("pagerank").isNotNull(), 10 + relative * 20).otherwise(F.lit(8.0)).alias("size"))


def draw_edges(edges: DataFrame) -> DataFrame:
    """Edges to draw, flagged where a reason is set."""
    flagged = F.col("anomaly_reason").isNotNull()
    return edges.select(
        "from_wallet", "to_wallet", "timestamp", "amount_usd",
        F.when(flagged, "flagged").otherwise("normal").alias("edge_class"),
        F.when(flagged, 2).otherwise(1).alias("width"))


def as_json(df: DataFrame, name: str = "value") -> DataFrame:
    """Rows as JSON text with ISO times, for sinks that take text."""
    return df.select(F.to_json(F.struct("*"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"}).alias(name))
