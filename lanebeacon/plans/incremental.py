"""Wi-Fi views kept up to date: only files that changed since the last run are read again.

Hours per client are kept in a table with the partitions of the readings master, one per daily file. Beside it stands
what they were made from: the names of the data files of each partition. A write of a partition gives its data
files new names, so a partition whose names are as before has not changed. Hours of changed partitions are
computed anew, those of partitions that are gone are removed, and the views add up the hours of all files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lanebeacon import operators as ops
from lanebeacon.functions.rooms import AUDITORIUMS, Rules
from lanebeacon.plans.shared import written_once
from lanebeacon.plans.wifi import replace_files, views_from_hours
from lanebeacon.schemas import READINGS
from lanebeacon.sinks import write_master
from lanebeacon.sources import read_readings_master
from lanebeacon.sources.files import DATED, FILE_KEY, INGEST_DATE, DailyFile, read_master

KEYS = [INGEST_DATE, FILE_KEY]
SOURCES = StructType([*DATED, StructField("folder", StringType()), StructField("names", StringType())])


@dataclass(frozen=True)
class Refreshed:
    """Partitions of the readings that were computed anew, and that are gone."""

    changed: int
    gone: int


def update_wifi_views(
    spark: SparkSession, master: str, meta: DataFrame, target: str, *, tz: str = "UTC", rooms: Rules = AUDITORIUMS
) -> Refreshed:
    """Brings hours per client up to date with the readings master and writes the views from them."""
    refreshed = refresh_client_hours(spark, master, f"{target}/client_hours")
    views_from_hours(read_client_hours(spark, f"{target}/client_hours"), meta, target, tz=tz, rooms=rooms)
    return refreshed


def refresh_client_hours(spark: SparkSession, master: str, hours: str) -> Refreshed:
    """Makes the table ``hours`` that of all readings in ``master``, reading only partitions that changed.

    What the hours were made from is written last, in ``<hours>.sources``: a run that fails is done again by the next.
    """
    sources = f"{hours.rstrip('/')}.sources"
    with written_once(_sources(spark, master), "sources") as now:
        before = _written(spark, sources)
        states = now.join(before.select(*KEYS, F.col("names").alias("old")), KEYS, "full_outer")
        # Keys and folders of what changed: a row per daily file that was loaded since.
        rows = states.where("not names <=> old").select(*KEYS, "folder").collect()
        changed = [row for row in rows if row["folder"] is not None]
        files = [DailyFile(row["folder"] or "", row[INGEST_DATE], row[FILE_KEY]) for row in rows]
        if files:
            replace_files(_hours(spark, master, [row["folder"] for row in changed]), hours, files)
        write_master(now, sources, mode="overwrite")
    return Refreshed(len(changed), len(rows) - len(changed))


def read_client_hours(spark: SparkSession, hours: str) -> DataFrame:
    empty = ops.client_hours(spark.createDataFrame([], StructType([*READINGS, *DATED])), tuple(KEYS)).schema
    return read_master(spark, hours, StructType([f for f in empty if f.name not in KEYS]), "parquet", partitions=DATED)


def _hours(spark: SparkSession, master: str, folders: list[str]) -> DataFrame:
    """Hours per client of the partitions in ``folders``."""
    if folders:
        readings = spark.read.option("basePath", master).parquet(*folders)
    else:
        readings = spark.createDataFrame([], StructType([*READINGS, *DATED]))
    return ops.client_hours(readings, tuple(KEYS))


def _sources(spark: SparkSession, master: str) -> DataFrame:
    """Folder and names of the data files of each partition; of the data only its files' names are read."""
    readings = read_readings_master(spark, master)
    if not readings.inputFiles():
        return spark.createDataFrame([], SOURCES)
    path = F.col("_metadata.file_path")
    files = readings.select(*KEYS, path.alias("path")).distinct()
    names = F.array_join(F.array_sort(F.collect_list(F.substring_index("path", "/", -1))), ",")
    folder = F.min(F.regexp_replace("path", "/[^/]*$", ""))
    return files.groupBy(*KEYS).agg(folder.alias("folder"), names.alias("names"))


def _written(spark: SparkSession, sources: str) -> DataFrame:
    """What the hours were made from the last time; nothing before the first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sources)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], SOURCES)
    return spark.read.schema(SOURCES).parquet(sources)
