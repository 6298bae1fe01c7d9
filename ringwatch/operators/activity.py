"""Wallet activity kept up to date batch by batch.

Each batch adds one small partial per wallet: first and last time seen, and how many transfers were new. What
is new is told by a table of all transfers counted so far, bucketed by (wallet, transfer): a batch is
brought to its buckets and the table itself is not moved. A batch that is written again replaces its own
partials and transfers.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.operators.store import read_batches, write_batch, written
from ringwatch.schema import ACTIVITY
from ringwatch.session import cut

BUCKETS = 64


@dataclass(frozen=True)
class ActivityStore:
    """Partials and counted transfers under ``root``. The number of buckets is fixed by the first batch."""

    spark: SparkSession
    root: str
    buckets: int = BUCKETS

    def _counted(self) -> str:
        """Name of the table of counted transfers, made known to this session where it is not yet."""
        name = f"counted_{hashlib.md5(self.root.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE {name} (wallet_address STRING, tx_id STRING, batch_id BIGINT) USING parquet "
                f"PARTITIONED BY (batch_id) CLUSTERED BY (wallet_address, tx_id) INTO {self.buckets} BUCKETS LOCATION '{self.root}/counted'")
            if written(self.spark, f"{self.root}/counted"):
                self.spark.catalog.recoverPartitions(name)
        return name

    def _width(self, name: str) -> int:
        """Buckets of the table as it was made, whatever this store was told."""
        told = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Num Buckets'").first()
        return int(told["data_type"])

    def add(self, transfers: DataFrame, batch_id: int) -> None:
        """Count one batch of transfers with sender and receiver. Only the batch is read, and of the earlier ones their transfers' ids in place."""
        name = self._counted()
        # Moved once, straight to the buckets: the sums per transfer and the join are made there.
        placed = transfers.select("wallet_address", "tx_id", "timestamp").repartition(self._width(name), "wallet_address", "tx_id")
        sends = placed.groupBy("wallet_address", "tx_id").agg(F.min("timestamp").alias("low"), F.max("timestamp").alias("high"))
        others = self.spark.table(name).filter(F.col("batch_id") != batch_id).select("wallet_address", "tx_id", F.lit(True).alias("known"))
        # Each transfer was new just once, so a match finds at most one row. A null id counts as no transfer.
        marked = cut(sends.join(others, ["wallet_address", "tx_id"], "left"))
        fresh = F.col("known").isNull() & F.col("tx_id").isNotNull()
        partials = marked.groupBy("wallet_address").agg(
            F.min("low").alias("first_seen_ts"), F.max("high").alias("last_seen_ts"), F.count_if(fresh).alias("new_tx"))
        receivers = transfers.select(F.col("to_wallet").alias("wallet_address")).distinct()
        rows = receivers.join(partials, "wallet_address", "full_outer").select(
            "wallet_address", "first_seen_ts", "last_seen_ts", F.coalesce("new_tx", F.lit(0)).alias("new_tx"))
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION (batch_id = {int(batch_id)}) SELECT wallet_address, tx_id FROM {{fresh}}",
            fresh=marked.filter(fresh))
        # Partials go last: a batch that fails in between is counted again from the start.
        write_batch(rows, f"{self.root}/partials", batch_id)

    def activity(self) -> DataFrame:
        """The same rows as ``store.wallet_activity`` of all transfers, from the partials alone."""
        return read_batches(self.spark, f"{self.root}/partials", ACTIVITY).groupBy("wallet_address").agg(
            F.min("first_seen_ts").alias("first_seen_ts"), F.max("last_seen_ts").alias("last_seen_ts"),
            F.sum("new_tx").alias("live_tx_count"))
