"""Intermediate results in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


# Words are written as numbers of a dictionary as long as it is no larger than this.
DICTIONARY_BYTES = 16 * 1024 * 1024

# Whether the shuffle files of a query go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session, whose executors share the driver's disk, may go without
    the setting; it gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder  # shared or not is the cluster's word: a file: folder may well be a mount
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="run-")
    return _local[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_parquet(df: DataFrame, path: str, divided: Sequence[str] = ()) -> None:
    """Write ``df``, and leave none of the job's shuffle files behind.

    Otherwise these stay until the driver's next garbage collection, so jobs that follow
    one another would fill the executors' disks with the sum of their shuffles.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        writer = df.write.option("compression", "zstd").option("parquet.dictionary.page.size", str(DICTIONARY_BYTES))
        writer.partitionBy(*divided).parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def settle(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back from there.

    For small tables that a job reads many times; it also cuts their lineage.
    """
    path = path or scratch_path(df.sparkSession, "settled")
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
