"""Raw Wi-Fi documents to flat rows. Only booking de-duplication shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanebeacon.functions.rooms import PLACEHOLDER, UNKNOWN
from lanebeacon.functions.time import booking_time
from lanebeacon.schemas import BOOKINGS_RAW, READINGS
from lanebeacon.sources.files import SOURCE_FILE


def flatten_readings(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per client sighting, from routers with nested readings and clients.

    NULL or empty arrays give no row; missing client fields stay NULL. ``keep``
    names further top-level columns to carry along.
    """
    return (
        raw.select("did", *keep, F.inline("readings"))
        .select("did", "ts", *keep, F.inline("clients"))
        .select(*READINGS.names, *keep)
    )


def device_sightings(raw: DataFrame, did: str) -> DataFrame:
    """The flattened sightings of one device; the filter runs before the flattening."""
    return flatten_readings(raw).where(F.col("did") == did)


def clean_locations(meta: DataFrame, placeholder: str = PLACEHOLDER, replacement: str = UNKNOWN) -> DataFrame:
    """Routers whose location was never filled in get ``replacement``; NULL stays NULL."""
    location = F.col("location")
    return meta.withColumn("location", F.when(location == placeholder, replacement).otherwise(location))


def explode_bookings(
    raw: DataFrame, *, scope: str = "all", trim: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per room and lecturer of each booking, with typed start and end.

    Copies of a booking are removed first: over all files (``scope="all"``) or within
    each file (``scope="file"``, which needs the ``source_file`` column the readers
    attach and keeps it). Copies are already merged inside each map task, so a booking
    repeated in many places does not make a hot shuffle key. ``trim`` removes blanks
    around the names in a list; ``keep`` names further columns to carry along, rows that
    differ in them being no copies.
    """
    if scope not in ("all", "file"):
        raise ValueError(f"scope must be 'all' or 'file', not {scope!r}")
    file = [SOURCE_FILE] if scope == "file" else []
    one_each = raw.select(*BOOKINGS_RAW.names, *file, *keep).distinct()

    def name(column: str):
        return F.trim(column) if trim else F.col(column)

    per_room = one_each.withColumn("room", F.explode(F.split("room", ","))).withColumn("room", name("room"))
    per_lecturer = per_room.withColumn("lecturers", F.explode(F.split("lecturers", ",")))
    return (
        per_lecturer.withColumn("lecturers", name("lecturers"))
        .withColumn("start_ts", booking_time(F.col("startDate"), F.col("startTime")))
        .withColumn("end_ts", booking_time(F.col("endDate"), F.col("endTime")))
    )
