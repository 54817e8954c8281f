"""Loading each daily file once, remembering which were loaded in a checkpoint.

Both functions read whatever arrived in ``folder`` since the last call and return
when that is done; calling them again adds nothing. They write the layout of the batch
loads, one partition per file, so both may load into the same table. They can be
interrupted at any time: the checkpoint replays the unfinished batch, which
replaces the partitions of its own files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from lanebeacon import schemas
from lanebeacon.plans.wifi import daily_bookings, dated, flat_readings, rejected, rejects, replace_files
from lanebeacon.plans.shared import written_once
from lanebeacon.sources.files import CORRUPT, with_corrupt, with_file_columns


def stream_readings(
    spark: SparkSession,
    folder: str,
    master: str,
    checkpoint: str | None = None,
    *,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """New reading files into a table partitioned by day and file."""
    raw = _new_files(spark, folder, schemas.READINGS_RAW, max_files_per_trigger)
    return _run(raw, flat_readings, master, checkpoint)


def stream_bookings(
    spark: SparkSession,
    folder: str,
    master: str,
    checkpoint: str | None = None,
    *,
    trim: bool = False,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """New booking files into a table partitioned by day and file.

    Copies are removed within each file, and a file is always part of one batch, so
    no state is kept between batches.
    """
    raw = _new_files(spark, folder, schemas.BOOKINGS_RAW, max_files_per_trigger)
    return _run(raw, lambda batch: daily_bookings(batch, trim), master, checkpoint)


def _run(
    raw: DataFrame, rows_of: Callable[[DataFrame], DataFrame], master: str, checkpoint: str | None
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        with written_once(dated(batch), "parsed") as parsed:
            replace_files(rows_of(parsed.where(F.col(CORRUPT).isNull())), master)
            replace_files(rejected(parsed), rejects(master))

    query = (
        raw.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint or _checkpoint(master))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _new_files(spark: SparkSession, folder: str, schema, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(with_corrupt(schema))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_file_columns(reader.json(folder))


def _checkpoint(master: str) -> str:
    """Beside the table, so on the same storage and found again by the next call."""
    return f"{master.rstrip('/')}.checkpoint"
