"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scope = threading.local()


def build_session(app_name: str = "ringwatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a fresh temporary folder.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(path)
    return path


def pin(df: DataFrame) -> DataFrame:
    """Compute ``df`` once as a checkpoint in the shared folder, keeping its partitioning.

    Later joins on the same keys need no further shuffle. The size estimate of the original plan
    is kept too, so use ``cut`` for what a loop feeds back into itself.
    """
    spark = df.sparkSession
    shared_dir(spark)
    # An adaptive plan does not tell its partitioning, so this one step is planned without it.
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.checkpoint(eager=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    The plan starts anew with the true size on disk, which also decides what may be broadcast,
    and the rows survive the loss of executors.
    """
    names = getattr(_scope, "names", None)
    if names is None:
        return _written(df)
    names.append(name := f"ringwatch_{uuid.uuid4().hex}")
    df.write.format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What ``cut`` writes inside goes into tables of the warehouse that are dropped at the end, so a long job does not
    keep the steps of its parts on disk. The function given is a ``cut`` whose result stays.

    Nothing that leaves the block may read from a table written inside it, other than through that function.
    """
    outer, _scope.names = getattr(_scope, "names", None), []
    try:
        yield _written
    finally:
        names, _scope.names = _scope.names, outer
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def bucketed(df: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """As ``cut``, with the table bucketed and sorted by ``key``: later joins and aggregates on it do not move its rows.

    Unlike a pinned frame it has its true size, so a loop may feed it back into itself. The table is known to
    this session's catalog by a name of its own; its files lie in the shared folder.
    """
    spark = df.sparkSession
    path, width = scratch_path(spark, "buckets"), buckets or shuffle_width(spark)
    name = f"ringwatch_{uuid.uuid4().hex}"
    df.repartition(width, key).write.format("parquet").option("path", path).bucketBy(width, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under this application's own folder, which can be dropped as a whole after the run."""
    own = f"{shared_dir(spark).rstrip('/')}/ringwatch-{spark.sparkContext.applicationId}"
    return f"{own}/{name}-{uuid.uuid4().hex}"


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
