"""The folder all executors share, and tables that live there for the time of a run."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    It is the one named in ``spark.checkpoint.dir``, else the one given to
    ``setCheckpointDir``. Without either, a local session uses a folder inside the warehouse; on a
    cluster that would be a folder of one machine, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.conf.get("spark.master", None) or "local"
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/lanebeacon-work"
    return folder.rstrip("/")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Meanwhile the shuffle files of a query go when it ends, and not when the driver happens to collect its garbage.

    For runs that write one table after another, whose shuffles would otherwise all stay on the executors' disks until
    the last is written. A DataFrame that is run a second time meanwhile has to make its shuffles anew.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def written_once(rows: DataFrame, name: str) -> Iterator[DataFrame]:
    """``rows`` as a table in the shared folder, for results that several writes are made from; gone afterwards."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:
        rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
