"""Wi-Fi: daily files to master tables, master tables to views."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanebeacon import operators as ops
from lanebeacon.functions.rooms import AUDITORIUMS, LECTURE_ROOMS, Rules
from lanebeacon.plans.shared import shuffles_removed, written_once
from lanebeacon.schemas import BOOKINGS
from lanebeacon.sinks import write_master, write_view
from lanebeacon.sources import read_bookings_json, read_meta_json, read_readings_json
from lanebeacon.sources.files import CORRUPT, FILE_KEY, INGEST_DATE, SOURCE_FILE, DailyFile, file_key, scanned_files

# Column titles of the written reports.
USAGE_TITLES = {
    "from_day": "From",
    "to_day": "To",
    "unique_clients": "Total no of unique clients",
    "accesses": "Total no of accesses",
}
OCCUPANCY_TITLES = {"day": "Date", "from_time": "From", "to_time": "To", "devices": "#devices"}
CONNECTION_TITLES = {"connections": "Total no of connections"}
QUALITY_TITLES = {"start_hour": "startHour", "end_hour": "endHour", "avg_accesses": "Avg. Total no of accesses"}


@dataclass(frozen=True)
class Loaded:
    """What a load did: files and lines read, rows kept, lines rejected."""

    files: int
    read: int
    kept: int
    rejected: int


def load_readings(spark: SparkSession, paths: str | list[str], master: str, **write_options) -> Loaded:
    """Loads daily reading files in one scan. Each file has its own partition within its day.

    The files are those that Spark finds for ``paths``, also in ``k=v`` folders. A file loaded again replaces exactly
    its own rows, also when it has none any more; other files of the day, whoever loaded them, stay. A file without a
    date in its name stops the load before anything is read. Lines that do not parse go to ``<master>.rejected``.
    """
    return _load(read_readings_json(spark, paths), flat_readings, master, write_options)


def _load(raw: DataFrame, rows_of: Callable[[DataFrame], DataFrame], master: str, write_options: dict) -> Loaded:
    """Parses the files once, into a table of the shared folder that rows and rejected lines are written from."""
    files = scanned_files(raw)
    with written_once(dated(raw), "parsed") as parsed:
        lines = parsed.agg(F.count(F.lit(1)).alias("read"), F.count(CORRUPT).alias("rejected")).first()
        kept = replace_files(rows_of(parsed.where(F.col(CORRUPT).isNull())), master, files, **write_options)
        replace_files(rejected(parsed), rejects(master), files)
    return Loaded(len(files), lines["read"], kept, lines["rejected"])


def load_meta(spark: SparkSession, paths: str | list[str], master: str, mode: str = "errorifexists") -> None:
    """Router locations without placeholders; lines that do not parse go to ``<master>.rejected``."""
    with written_once(read_meta_json(spark, paths), "parsed") as parsed:
        good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        write_master(ops.clean_locations(good), master, mode=mode)
        write_master(rejected(parsed), rejects(master), mode=mode)


def load_bookings(
    spark: SparkSession, paths: str | list[str], master: str, *, trim: bool = False, **write_options
) -> Loaded:
    """Loads daily booking files in one scan, like ``load_readings``; copies within a file are removed."""
    return _load(read_bookings_json(spark, paths), lambda parsed: daily_bookings(parsed, trim), master, write_options)


def replace_files(rows: DataFrame, master: str, files: Sequence[DailyFile] = (), **write_options) -> int:
    """Writes rows by day and file; ``files`` without rows lose the rows they had before. Returns the rows written for ``files``.

    The rows are written first, so a load that fails leaves every file with its old or new rows. A
    partition that the write has replaced has other data files than before.
    """
    spark = rows.sparkSession
    before = partitions_of(spark, master, files)
    write_master(rows, master, partition_by=[INGEST_DATE, FILE_KEY], **write_options)
    after = partitions_of(spark, master, files)
    for partition, names in before.items():
        if after.get(partition) == names:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(partition)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    written = [f"{partition}/{name}" for partition, names in after.items() for name in names - before.get(partition, frozenset())]
    # Of parquet files only the footers are read.
    return spark.read.format(write_options.get("fmt", "parquet")).load(written).count() if written else 0


def partitions_of(spark: SparkSession, master: str, files: Sequence[DailyFile]) -> dict[str, frozenset[str]]:
    """Names of the data files in the partitions of ``files``; only the folders of their days are listed."""
    keys = defaultdict(set)
    for file in files:
        keys[file.day].add(file.key)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = folder(master).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for day, wanted in sorted(keys.items()):
        top = folder(f"{master.rstrip('/')}/{INGEST_DATE}={day}")
        for part in store.listStatus(top) if store.exists(top) else ():
            if unquote(part.getPath().getName()).removeprefix(f"{FILE_KEY}=") in wanted:
                names = frozenset(f.getPath().getName() for f in store.listStatus(part.getPath()))
                found[part.getPath().toString()] = names
    return found


def rejects(master: str) -> str:
    return f"{master.rstrip('/')}.rejected"


def rejected(raw: DataFrame) -> DataFrame:
    """Lines that do not parse, as far as they could be read, with the file they came from."""
    return raw.where(F.col(CORRUPT).isNotNull())


def dated(raw: DataFrame) -> DataFrame:
    """Adds the file's key and insists on a date in its name."""
    undated = F.raise_error(F.concat(F.lit("no date in the name of "), SOURCE_FILE))
    return raw.withColumns({INGEST_DATE: F.coalesce(INGEST_DATE, undated.cast("date")), FILE_KEY: file_key(F.col(SOURCE_FILE))})


def flat_readings(raw: DataFrame) -> DataFrame:
    return ops.flatten_readings(raw, keep=(INGEST_DATE, FILE_KEY))


def daily_bookings(raw: DataFrame, trim: bool = False) -> DataFrame:
    """Booking rows with the day and key of the file they came from."""
    rows = ops.explode_bookings(raw, scope="file", trim=trim, keep=(INGEST_DATE, FILE_KEY))
    return rows.select(*BOOKINGS.names, INGEST_DATE, FILE_KEY)


def write_wifi_views(
    readings: DataFrame,
    meta: DataFrame,
    target: str,
    *,
    bookings: DataFrame | None = None,
    tz: str = "UTC",
    rooms: Rules = AUDITORIUMS,
    lecture_rooms: Rules | None = LECTURE_ROOMS,
) -> None:
    """The batch views, each in its own folder under ``target``.

    The readings are scanned once, into hours per client that are kept next to the
    views; the first three views start from there. With ``bookings`` the connections per
    lecture are written too, which look at the readings again and at the times of the bookings several times; those are
    kept next to the views as well. ``rooms`` and ``lecture_rooms`` are the rules
    of the occupancy and of the lectures.
    """
    spark = readings.sparkSession
    hours_path, times_path = f"{target}/client_hours", f"{target}/booked_times"
    with shuffles_removed(spark):
        write_master(ops.client_hours(readings), hours_path, mode="overwrite")
        views_from_hours(spark.read.parquet(hours_path), meta, target, tz=tz, rooms=rooms)
        if bookings is not None:
            write_master(ops.booked_times(bookings, lecture_rooms, tz=tz), times_path, mode="overwrite")
            connections = ops.lecture_connections(readings, meta, spark.read.parquet(times_path), lecture_rooms, tz=tz)
            write_view(connections, f"{target}/lecture_connections", columns=CONNECTION_TITLES)


def views_from_hours(hours: DataFrame, meta: DataFrame, target: str, *, tz: str = "UTC", rooms: Rules = AUDITORIUMS) -> None:
    """The three views that hours per client are enough for."""
    views = {
        "router_usage": (ops.weekly_router_usage(hours, meta, tz=tz), USAGE_TITLES),
        "room_occupancy": (ops.room_occupancy_hourly(hours, meta, rooms, tz=tz), OCCUPANCY_TITLES),
        "signal_quality": (ops.signal_quality_profile(hours, meta, tz=tz), QUALITY_TITLES),
    }
    with shuffles_removed(hours.sparkSession):
        for name, (view, titles) in views.items():
            write_view(view, f"{target}/{name}", columns=titles)
