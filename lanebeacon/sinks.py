"""Writing master tables and views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

MASTER_MODES = ("replace_partitions", "append", "errorifexists", "overwrite")


def write_master(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    mode: str = "replace_partitions",
    fmt: str = "parquet",
    header: bool = False,
    cluster_by: Sequence[str] = (),
    rebalance: bool = True,
    options: dict[str, str] | None = None,
) -> None:
    """Writes a master table in parallel.

    ``replace_partitions`` replaces exactly the partitions ``df`` holds, so loading the
    same rows again changes nothing. ``cluster_by`` sorts inside each task, which lets
    parquet skip row groups on those columns. ``rebalance`` pays one shuffle of a partitioned
    table for files of an even size, since otherwise every task would write a file for every
    partition it meets: small partitions are written by one task, a hot one is split over several.
    ``options`` go to the file format, such as ``parquet.bloom.filter.enabled#did``.
    """
    if mode not in MASTER_MODES:
        raise ValueError(f"mode must be one of {MASTER_MODES}, not {mode!r}")
    if mode == "replace_partitions" and not partition_by:
        raise ValueError("replace_partitions needs partition_by")
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    if cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    writer = df.write.format(fmt).options(**(options or {})).partitionBy(*partition_by)
    if mode == "replace_partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        # Said outright, so that a session-wide dynamic setting does not reach in here.
        writer = writer.mode(mode).option("partitionOverwriteMode", "static")
    if fmt == "csv":
        writer = writer.option("header", header)
    writer.save(path)


def write_bucketed(df: DataFrame, table: str, path: str, by: Sequence[str], buckets: int, cluster_by: Sequence[str] = ()) -> None:
    """Writes a master as a table of the catalog whose files are dealt into ``buckets`` by a hash of ``by``.

    Views that group or join by those columns read it without a shuffle. All rows of a key are in one file and one task, so
    this is for keys of which none holds a large part of the rows; for others use ``write_master``. An existing table
    is replaced.
    """
    dealt = df.repartition(buckets, *by)
    writer = dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, *by).sortBy(*by, *cluster_by)
    writer.option("path", path).saveAsTable(table)


def write_view(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    fmt: str = "csv",
    header: bool = True,
    order_by: Sequence = (),
    columns: dict[str, str] | None = None,
) -> None:
    """Writes a computed view, by default as CSV with a header, in as many files as there are tasks.

    ``order_by`` sorts the whole view over its files, in order of their names. ``columns``
    renames columns for the reader of the files.
    """
    if columns:
        df = df.withColumnsRenamed(columns)
    _save(df.orderBy(*order_by) if order_by else df, path, mode, fmt, header)


def _save(df: DataFrame, path: str, mode: str, fmt: str, header: bool) -> None:
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", header)
    writer.save(path)
