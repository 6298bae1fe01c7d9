"""Stored edges and wallets as plain Parquet, safe to write twice."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringwatch.config import UNKNOWN_TIER
from ringwatch.schema import SENT

EDGE_KEY = ["wallet_address", "to_wallet", "window_start"]


def sent_rows(scored: DataFrame) -> DataFrame:
    """Scored windows in the shape of stored edges."""
    return scored.select(
        F.col("sample_tx_id").alias("tx_id"), "window_start", "wallet_address", "to_wallet",
        F.col("total_amount_usd").alias("amount_usd"), F.col("avg_gas_fee").alias("gas_fee"),
        "tx_count", F.col("last_seen_ts").alias("timestamp"), "true_label", "z_score",
        "anomaly_reason", "ml_score", "ml_anomaly")


MANIFEST = "batch_id long, attempt long, path string, kind string, seen long"


def write_batch(rows: DataFrame, root: str, batch_id: int) -> str:
    """Write one batch as an attempt of its own and then record it; returns the attempt's path.

    Readers see the newest recorded attempt of each batch: one that is still being written, or was broken
    off, is not seen, and the attempt before stays until the new one is complete.
    """
    path, attempt = _attempt(root, batch_id)
    rows.withColumn("batch_id", F.lit(batch_id).cast("long")).write.parquet(path)
    _record(rows.sparkSession, root, (batch_id, attempt, path, "batch", 0))
    return path


def _attempt(root: str, batch_id: int) -> tuple[str, int]:
    attempt = time.time_ns()
    return f"{root}/batch_id={batch_id}/attempt={attempt}", attempt


def _record(spark: SparkSession, root: str, row: tuple) -> None:
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}-manifest")


def _live(spark: SparkSession, root: str) -> tuple[list, int]:
    """The recorded attempts that count, and the newest attempt known. There are as many as batches since the last compaction."""
    if not written(spark, f"{root}-manifest"):
        return [], 0
    records = spark.read.schema(MANIFEST).parquet(f"{root}-manifest").orderBy("attempt").collect()
    compacted = [r for r in records if r["kind"] == "compacted"][-1:]
    # What a compaction has read it replaces; a batch recorded meanwhile counts beside it.
    newest = {r["batch_id"]: r for r in records if r["kind"] == "batch" and not any(
        r["batch_id"] <= c["batch_id"] and r["attempt"] <= c["seen"] for c in compacted)}
    return [*compacted, *newest.values()], max(r["attempt"] for r in records)


def written(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder at ``path``."""
    try:
        spark.read.schema("_ int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _with_batch(schema: T.StructType) -> T.StructType:
    if "batch_id" in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField("batch_id", T.LongType(), True)])


def read_batches(spark: SparkSession, root: str, schema=SENT) -> DataFrame:
    """All batches under ``root`` with their ``batch_id``; empty when none was written yet."""
    return _read(spark, _live(spark, root)[0], schema)


def _read(spark: SparkSession, records: list, schema: T.StructType) -> DataFrame:
    if not records:
        return spark.createDataFrame([], _with_batch(schema))
    return spark.read.schema(_with_batch(schema)).parquet(*[r["path"] for r in records])


def current_edges(versions: DataFrame) -> DataFrame:
    """The latest version of each edge.

    Batches carry cumulative window values, so the greatest batch wins and nothing is summed.
    The aggregate keeps one version per edge and task before the shuffle.
    """
    values = [c for c in versions.columns if c not in (*EDGE_KEY, "batch_id")]
    latest = versions.groupBy(*EDGE_KEY).agg(
        F.max_by(F.struct(*values), F.col("batch_id")).alias("_row"), F.max("batch_id").alias("batch_id"))
    return latest.select(*EDGE_KEY, "_row.*", "batch_id")


def compact(spark: SparkSession, root: str, target: str, up_to: int) -> None:
    """Rewrite all batches up to ``up_to`` as one, under ``root`` itself or under a new one.

    Under ``root`` the stream may write on: a batch recorded in the meantime is not among what the compaction
    has read and stays beside it. Under another root the later batches known by now are copied, so the
    stream has to rest.
    """
    records, seen = _live(spark, root)
    # An earlier compaction has its newest batch as its number and is rewritten with the rest.
    old = [r for r in records if r["batch_id"] <= up_to]
    rows = current_edges(_read(spark, old, SENT)).withColumn("batch_id", F.lit(up_to).cast("long"))
    path, attempt = _attempt(target, up_to)
    rows.write.parquet(path)
    _record(spark, target, (up_to, attempt, path, "compacted", seen))
    if target != root:
        for record in records:
            if record["batch_id"] > up_to:
                write_batch(_read(spark, [record], SENT), target, record["batch_id"])


def wallet_activity(transfers: DataFrame) -> DataFrame:
    """Per wallet: first and last time seen as sender, and distinct transfers sent.

    Receivers that never send appear with no times and a count of 0. The distinct step runs on
    (wallet, transfer), so a busy wallet is spread over all tasks.
    """
    sends = (
        transfers.groupBy("wallet_address", "tx_id")
        .agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high"))
        .groupBy("wallet_address")
        .agg(F.min("low").alias("first_seen_ts"), F.max("high").alias("last_seen_ts"),
             F.count("tx_id").alias("live_tx_count")))
    receivers = transfers.select(F.col("to_wallet").alias("wallet_address")).distinct()
    return receivers.join(sends, "wallet_address", "full_outer").withColumn(
        "live_tx_count", F.coalesce("live_tx_count", F.lit(0)))


def wallet_table(activity: DataFrame, profiles: DataFrame, analytics: DataFrame | None = None) -> DataFrame:
    """Every known wallet with profile, live activity and, where given, graph results."""
    seen = activity.withColumnRenamed("first_seen_ts", "seen_first")
    wallets = seen.join(profiles, "wallet_address", "full_outer").select(
        "wallet_address",
        F.coalesce("first_seen_ts", "seen_first").alias("first_seen_ts"),
        F.coalesce("historical_tx_count", F.lit(0)).alias("historical_tx_count"),
        F.coalesce("historical_risk_tier", F.lit(UNKNOWN_TIER)).alias("historical_risk_tier"),
        F.coalesce("live_tx_count", F.lit(0)).alias("live_tx_count"),
        "last_seen_ts")
    return wallets if analytics is None else wallets.join(analytics, "wallet_address", "left")


def add_missing(wallets: DataFrame, addresses: DataFrame) -> DataFrame:
    """Add the addresses that are not in ``wallets`` yet; existing rows stay untouched."""
    fresh = addresses.select("wallet_address").distinct().join(wallets, "wallet_address", "left_anti")
    return wallets.unionByName(
        fresh.withColumns({"historical_risk_tier": F.lit(UNKNOWN_TIER), "live_tx_count": F.lit(0).cast("long")}),
        allowMissingColumns=True)


def save_snapshot(df: DataFrame, root: str, version: int) -> int:
    """Write a full version, then record it; readers never see a half-written one. Returns its rows."""
    spark = df.sparkSession
    path = f"{root}/v={version}"
    df.write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path).count()
    record = spark.range(1).select(
        F.lit(version).cast("long").alias("version"), F.lit(path).alias("path"),
        F.lit(rows).cast("long").alias("n_rows"))
    record.coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return rows


def current_snapshot(spark: SparkSession, root: str) -> tuple[DataFrame, int] | None:
    """The newest recorded version and its row count, or None before the first."""
    try:
        manifest = spark.read.schema("version long, path string, n_rows long").parquet(f"{root}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = manifest.orderBy(F.desc("version")).limit(1).collect()
    return (spark.read.parquet(newest[0]["path"]), newest[0]["n_rows"]) if newest else None
