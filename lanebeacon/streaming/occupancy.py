"""People per room and hour while readings still come in.

Sightings carry the end of their hour as event time. A client counts once per room and hour, for which the stream
remembers who was seen until the watermark has passed that hour; then the hour's count is final and
written, once. A sighting of an hour that is already final is late: it is dropped and counted.

An hour becomes final when one has been seen that ends ``delay`` or more after it. ``close_hours`` says that nothing
more comes up to a time, and so makes the last hours final too.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lanebeacon import operators as ops
from lanebeacon import schemas
from lanebeacon.functions.rooms import AUDITORIUMS, Rules, room_name
from lanebeacon.functions.time import HOUR, bucket_start
from lanebeacon.operators.wifi_views import occupancy_labels
from lanebeacon.sources.files import CORRUPT, with_corrupt

COUNTS = StructType([StructField("location", StringType()), StructField("hour", LongType()), StructField("devices", LongType())])
HEARTBEAT = StructType([StructField("ts", LongType())])
# The router of rows that only have a time; no location is listed for it.
NOBODY = "(nobody)"


@dataclass(frozen=True)
class Streamed:
    """A finished run of the stream, and the sightings that came too late in it."""

    query: StreamingQuery
    late: int


def stream_occupancy(
    spark: SparkSession,
    folder: str,
    meta: DataFrame,
    target: str,
    checkpoint: str | None = None,
    *,
    rules: Rules = AUDITORIUMS,
    delay: str = "1 hour",
    max_files_per_trigger: int | None = None,
) -> Streamed:
    """Adds the hours that have become final to the table ``target``, from the files that came into ``folder`` since the last call.

    Each hour of each room is written once; the checkpoint (by default beside the table) holds the open ones. ``meta`` is
    read anew by each call. Rows without a time are left out, lines that do not parse too.
    """
    seen = counted_rooms(sightings(spark, folder, target, max_files_per_trigger), meta, rules, delay)
    query = (
        seen.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint or f"{target.rstrip('/')}.checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return Streamed(query, _late(query))


def sightings(spark: SparkSession, folder: str, target: str, max_files: int | None = None) -> DataFrame:
    """``did, cid, ts`` of new files, and of ``close_hours`` rows that only have a time."""
    beats = _heartbeats(target)
    _make_folder(spark, beats)
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.schema(with_corrupt(schemas.READINGS_RAW)).json(folder)
    flat = ops.flatten_readings(raw.where(F.col(CORRUPT).isNull())).select("did", "cid", "ts")
    # With a router, as the optimizer takes rows without one out before the watermark has seen their time.
    nobody = [F.lit(NOBODY).alias("did"), F.lit(None).cast("string").alias("cid")]
    times = spark.readStream.schema(HEARTBEAT).json(beats).select(*nobody, "ts")
    return flat.unionByName(times)


def counted_rooms(seen: DataFrame, meta: DataFrame, rules: Rules, delay: str) -> DataFrame:
    """``location, hour, devices`` of a stream of ``did, cid, ts``, an hour at a time as it becomes final."""
    rooms = meta.select("did", room_name(F.col("location"), rules).alias("location")).where("location is not null")
    ends = F.timestamp_seconds(bucket_start(F.col("ts"), HOUR) + HOUR)
    marked = seen.where(F.col("ts").isNotNull()).select("did", "cid", ends.alias("hour_end")).withWatermark("hour_end", delay)
    once = marked.join(rooms, "did").dropDuplicatesWithinWatermark(["location", "hour_end", "cid"])
    counts = once.groupBy("location", "hour_end").agg(F.count("cid").alias("devices"))
    return counts.select("location", (F.unix_timestamp("hour_end") - HOUR).alias("hour"), "devices")


def close_hours(spark: SparkSession, target: str, until: int) -> None:
    """Says that all sightings before ``until`` (epoch seconds) have come; the next run makes their hours final."""
    beats = _heartbeats(target)
    _make_folder(spark, beats)
    spark.createDataFrame([(until,)], HEARTBEAT).coalesce(1).write.mode("append").json(beats)


def read_occupancy(spark: SparkSession, target: str, *, tz: str = "UTC") -> DataFrame:
    """The report of the hours that are final so far."""
    return occupancy_labels(spark.read.schema(COUNTS).parquet(target), tz)


def _late(query: StreamingQuery) -> int:
    """Rows that the watermark dropped before they reached the state."""
    return sum(op["numRowsDroppedByWatermark"] for progress in query.recentProgress for op in json.loads(progress.json)["stateOperators"])


def _heartbeats(target: str) -> str:
    return f"{target.rstrip('/')}.heartbeats"


def _make_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
