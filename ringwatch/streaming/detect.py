"""The streaming jobs: archive raw transfers, and detect on sliding windows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ringwatch.config import RuleConfig, WindowConfig
from ringwatch.operators import forest as forests
from ringwatch.operators.enrich import enrich
from ringwatch.operators.rules import apply_rules, verdict, without_model
from ringwatch.operators.store import current_snapshot, read_batches, sent_rows, write_batch
from ringwatch.operators.windows import final_pair_windows, pair_windows
from ringwatch.plans import views
from ringwatch.schema import BATCH_METRICS, CONTEXT, TRANSFER
from ringwatch.sources.transfers import with_reject_reason


#: Windows in progress lie on disk and take a fixed part of an executor's memory, however many there are.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500"}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state by ``STATE``, whatever the session says; it is as before afterwards.

    A query that goes on from a checkpoint keeps the kind of store it was begun with.
    """
    before = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@dataclass(frozen=True)
class Settings:
    """Where results go and how windows are judged. All paths lie under ``root``."""

    root: str
    rules: RuleConfig = field(default_factory=RuleConfig)
    windows: WindowConfig = field(default_factory=WindowConfig)
    graph_root: str | None = None
    trigger: dict = field(default_factory=lambda: {"processingTime": "10 seconds"})
    final_only: bool = False

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def score_batch(rows: DataFrame, settings: Settings, forest: forests.Forest | None) -> DataFrame:
    """Context, model score and verdict for one batch of windows.

    The context is looked up anew for every batch, so a refreshed graph counts from the next one.
    """
    snapshot = current_snapshot(rows.sparkSession, f"{settings.graph_root}/context") if settings.graph_root else None
    if snapshot:
        rows = enrich(rows, snapshot[0], known_rows=snapshot[1])
    else:
        empty = {f.name: F.lit(None).cast(f.dataType) for f in CONTEXT.fields if f.name != "wallet_address"}
        rows = rows.withColumns(empty)
    if forest is None:
        return without_model(rows)
    return verdict(forests.score(rows, forest), forest.threshold)


def process_batch(batch: DataFrame, batch_id: int, settings: Settings, forest: forests.Forest | None) -> None:
    """Store one batch and its metrics. Running it again for the same id replaces both."""
    # Written first and looked at after that, so that the plan with its state and source runs once.
    path = write_batch(sent_rows(score_batch(batch, settings, forest)), settings.path("sent"), batch_id)
    stored = batch.sparkSession.read.parquet(path)
    if stored.isEmpty():
        return
    write_batch(views.batch_metrics(stored).coalesce(1), settings.path("metrics"), batch_id)


def start_detection(transfers: DataFrame, settings: Settings, forest: forests.Forest | None = None) -> StreamingQuery:
    """Windows, rules, context, model and storage for a stream of transfers.

    Windows are stored anew with every batch that changes them, or, with ``settings.final_only``, once, when
    they are complete: later, but with a sixth of the state that an event touches and one version of each.
    """
    windows = final_pair_windows(transfers, settings.windows) if settings.final_only else pair_windows(
        transfers, settings.windows, watermark=True)
    judged = apply_rules(windows, settings.rules)
    writer = (
        judged.writeStream.queryName("detection").outputMode("append" if settings.final_only else "update")
        .option("checkpointLocation", settings.path("checkpoints/detection"))
        .trigger(**settings.trigger)
        .foreachBatch(lambda batch, batch_id: process_batch(batch, batch_id, settings, forest)))
    with _state_on_disk(transfers.sparkSession):
        return writer.start()


def start_archive(decoded: DataFrame, settings: Settings) -> StreamingQuery:
    """Keep all decoded rows: usable ones as transfers, the others with the reason they were set aside."""
    def keep(batch: DataFrame, batch_id: int) -> None:
        marked = with_reject_reason(batch).persist()
        try:
            write_batch(marked.filter("reject_reason IS NULL").select(*TRANSFER.fieldNames()),
                        settings.path("transfers"), batch_id)
            write_batch(marked.filter("reject_reason IS NOT NULL"), settings.path("rejects"), batch_id)
        finally:
            marked.unpersist()

    return (
        decoded.writeStream.queryName("archive").outputMode("append")
        .option("checkpointLocation", settings.path("checkpoints/archive"))
        .trigger(**settings.trigger).foreachBatch(keep).start())


def stored_edges(spark: SparkSession, settings: Settings) -> DataFrame:
    """All stored versions of all edges, with their batch."""
    return read_batches(spark, settings.path("sent"))


def stored_metrics(spark: SparkSession, settings: Settings) -> DataFrame:
    return read_batches(spark, settings.path("metrics"), BATCH_METRICS)


def stored_transfers(spark: SparkSession, settings: Settings) -> DataFrame:
    return read_batches(spark, settings.path("transfers"), TRANSFER)


def summary(spark: SparkSession, settings: Settings) -> DataFrame:
    """Totals over all batches and the look of the last one."""
    return views.metrics_summary(stored_metrics(spark, settings), views.last_batch(stored_edges(spark, settings)))
