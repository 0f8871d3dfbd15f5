"""Session helpers: a local session for tests, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from paperloom.folders import delete

# Paths handed out inside each open ``scratch`` block.
_open: list[list[str]] = []


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the submitted session is used as it is."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("paperloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.minPartitionNum", cores)
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a private folder; a cluster raises, as its executors would
    each write to their own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="paperloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to, below the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what ``land`` and ``fresh_path`` made inside the block; nothing lazy may outlive it."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            delete(spark, path)


def land(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table cuts the lineage, so an executor lost later never re-runs the scan, sort or
    row numbering above it with a different outcome.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
