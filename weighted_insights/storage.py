"""Shared-folder tables: how lineage is cut and where intermediate results go.

A written table survives the loss of any executor, keeps columnar pruning and
pushdown for its readers, and costs one write.  The folder is the one the
cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, without a trailing slash."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    # One process on one machine: its own temporary folder is shared by definition.
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="weighted-insights-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, purpose: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.  With ``keep`` it outlives the innermost :func:`scratch`."""
    path = new_path(df.sparkSession, purpose)
    df.write.parquet(path)
    for held in _open[:-1] if keep else _open:
        held.append((df.sparkSession, path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


_open: list[list[tuple[SparkSession, str]]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Remove the tables that are settled inside the block when it ends, also if it fails.

    What leaves the block must not read them any more.
    """
    held: list[tuple[SparkSession, str]] = []
    _open.append(held)
    try:
        yield
    finally:
        _open.remove(held)
        for spark, path in held:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder, wherever that folder lies."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
