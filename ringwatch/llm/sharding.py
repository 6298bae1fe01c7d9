"""Uniform sharding by a two-pass external shuffle, with built-in functions alone.

The first pass scatters every record to a bucket by a seeded hash of its place in the table; buckets are
as many as keep one of them within ``bucket_bytes``. The second pass takes each bucket into memory,
permutes it (``shuffle`` is Spark's Fisher-Yates) and writes it. The written buckets, one after the other,
are the shuffled table; shards are equal cuts of it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringwatch.llm.common import cut, pick

SHARDS = 40
SEED = 42
#: One bucket is one task; give large executors larger buckets, so that there are fewer of them.
BUCKET_BYTES = 32 << 20
#: What a record counts besides its text.
RECORD_BYTES = 16


def record_size(text: str = "text"):
    """UTF-8 bytes of the text (null: none) plus the fixed part."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_BYTES).cast("long")


def shuffled(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """shard int, slot long, record struct: every row of ``docs`` once, with all its columns in ``record``.

    Every order of the rows is equally likely. Shards take numbers 0 to ``shards`` - 1 and differ by one row
    at most; slots count from 0 without gaps. The same seed, files and settings give the same order.

    Rows scatter by their place, not by what they hold, so null or repeated ids, equal texts and whole
    repeated rows spread like any others; a bucket outgrows its bytes only by a text that is longer than
    that alone. Null texts count 16 bytes. Columns may have any names and types: they stay inside
    ``record``. With fewer rows than shards some shards are empty, and an empty table gives no rows.
    ``docs`` has to be read from files, or come out the same when a lost part of it is computed again.
    """
    names = list(docs.columns)
    rows, total = pick(docs, "text").agg(F.count(F.lit(1)), F.coalesce(F.sum(record_size()), F.lit(0))).first()
    buckets = max(1, math.ceil(total / bucket_bytes))

    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])
    placed = numbered.select(F.struct("*").alias("record"), F.monotonically_increasing_id().alias("row"))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(buckets)).cast("int")
    scattered = placed.withColumn("bucket", bucket).repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "row")

    # The order before the permutation is that of the rows, so a bucket computed again is the same again.
    piles = scattered.groupBy("bucket").agg(F.collect_list("record").alias("pile"))
    written = cut(piles.select("bucket", F.posexplode(F.shuffle("pile", seed)).alias("place", "record")))

    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = cut(sizes.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    whole = max(rows, 1)
    at = written.join(starts, "bucket").withColumn("at", F.col("start") + F.col("place"))
    sharded = at.withColumn("shard", F.expr(f"at * {shards}L div {whole}L"))
    first = F.expr(f"(shard * {whole}L + {shards - 1}L) div {shards}L")
    record = F.struct(*[F.col(f"record.c{i}").alias(name) for i, name in enumerate(names)])
    return sharded.select(F.col("shard").cast("int").alias("shard"), (F.col("at") - first).alias("slot"), record.alias("record"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write one folder ``shard=N`` per shard under ``path``; its files hold the records with their slots, in slot order."""
    rows = shuffled(docs, shards, seed).sortWithinPartitions("shard", "slot")
    rows.write.partitionBy("shard").parquet(path)


def digest(sharded: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 (null text: 0), law, shard, slot, grown_shard (null, as this law has none)."""
    record = pick(sharded, "shard", "slot", "record")
    text = F.col("record.text")
    return record.select(
        F.col("record.doc_id").alias("doc_id"), record_size("record.text").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
