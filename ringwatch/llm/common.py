"""What the operators of this subpackage share: column choice, Arrow batches, shared tables."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ringwatch.session import cut, passing_tables, scratch_path  # noqa: F401  re-exported for the operators

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Just the columns ``names``, spelled exactly so; further columns may clash with anything."""
    columns = list(df.columns)
    numbered = df.toDF(*[f"__c{i}" for i in range(len(columns))])
    return numbered.select(*[F.col(f"__c{columns.index(n)}").alias(n) for n in names])


def mapped(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose Python workers find this package wherever the driver was started."""
    environment = df.sparkSession.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, known] if known else [_ROOT])
    return df.mapInArrow(work, schema)


def batch_of(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def longs(values: object) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.int64))


def input_bytes(df: DataFrame) -> int:
    """Size of what ``df`` reads, as the optimizer knows it from the files."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(stats.sizeInBytes().toString())


def words(text: str | None) -> list[bytes]:
    """UTF-8 words of a text, cut at ASCII white space (x20, x09 to x0D) alone."""
    return text.encode().split() if text else []


def folded(text: str | None) -> list[bytes]:
    """As ``words``, with A-Z lower-cased and no other letter."""
    return text.encode().lower().split() if text else []


#: Bytes of an Arrow batch that is turned into Python objects at a time.
SLICE_BYTES = 1 << 20


def sliced(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes, so that a worker holds few rows as Python objects at once.

    A row that is longer than that is a slice of its own.
    """
    for batch in batches:
        rows = max(1, batch.num_rows * most // max(batch.nbytes, 1))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def passing(docs: DataFrame, make: Callable[[], Callable[[list[str | None]], list[bool]]]) -> DataFrame:
    """The rows whose texts a test accepts, with all their columns; decided row by row, whatever the ids.

    ``make`` gives the test, once for each task.
    """
    at = list(docs.columns).index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make()
        for batch in sliced(batches):
            yield batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))

    numbered = docs.toDF(*[f"__c{i}" for i in range(len(docs.columns))])
    return mapped(numbered, work, numbered.schema).toDF(*docs.columns)


def with_rows(docs: DataFrame) -> DataFrame:
    """The documents as a written table with one more column, ``__row``: a number of each row's own."""
    numbered = docs.toDF(*[f"__c{i}" for i in range(len(docs.columns))])
    return cut(numbered.withColumn("__row", F.monotonically_increasing_id())).toDF(*docs.columns, "__row")
