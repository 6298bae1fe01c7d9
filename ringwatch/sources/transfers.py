"""Reading transfers from a message stream, from files or from raw JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringwatch.schema import TRANSFER

_CORRUPT = "_malformed"


def read_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """A stream with one payload per row in a ``value`` column.

    ``fmt="kafka"`` needs the Kafka connector on the class path and takes its options as given
    (``subscribe``, ``kafka.bootstrap.servers``). ``fmt="text"`` follows a folder of JSON lines.
    """
    defaults = {"startingOffsets": "latest"} if fmt == "kafka" else {}
    reader = spark.readStream.format(fmt).options(**{**defaults, **options})
    return reader.load(path) if path else reader.load()


def read_batch(spark: SparkSession, path: str, fmt: str = "text", **options: str) -> DataFrame:
    """The same payload rows from files at rest."""
    return spark.read.format(fmt).options(**options).load(path)


def decode(df: DataFrame, payload: str = "value", now: Column | None = None) -> DataFrame:
    """Parse JSON payloads into transfer columns; a missing event time becomes ``now``.

    ``malformed`` holds the payload text where it was not valid JSON for the schema.
    """
    schema = T.StructType(TRANSFER.fields + [T.StructField(_CORRUPT, T.StringType(), True)])
    parsed = F.from_json(
        F.col(payload).cast("string"), schema,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    fallback = F.current_timestamp() if now is None else now
    columns = [F.col(f"data.{name}").alias(name) for name in TRANSFER.fieldNames() if name != "timestamp"]
    return df.select(parsed.alias("data")).select(
        *columns,
        F.coalesce(F.col("data.timestamp"), fallback).alias("timestamp"),
        F.col(f"data.{_CORRUPT}").alias("malformed"))


def with_reject_reason(df: DataFrame) -> DataFrame:
    """Name what makes a decoded row unusable, or NULL when it is fine."""
    return df.withColumn(
        "reject_reason",
        F.when(F.col("malformed").isNotNull(), "malformed_payload")
        .when(F.col("tx_id").isNull(), "missing_tx_id")
        .when(F.col("wallet_address").isNull(), "missing_sender")
        .when(F.col("to_wallet").isNull(), "missing_receiver"))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable transfers, and the rows set aside with their reason."""
    marked = with_reject_reason(df)
    good = marked.filter(F.col("reject_reason").isNull()).select(*TRANSFER.fieldNames())
    return good, marked.filter(F.col("reject_reason").isNotNull())


def floor_amounts(df: DataFrame, least: float = 1.0) -> DataFrame:
    """Optional cleaning: no amount below ``least``."""
    return df.withColumn("amount_usd", F.greatest(F.col("amount_usd"), F.lit(least)))


def conform(df: DataFrame) -> DataFrame:
    """Cast any frame with the transfer columns to the fixed schema (event time included)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRANSFER.fields])
