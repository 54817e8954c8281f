"""Readers for raw files and master tables. Paths are any Hadoop URI, a list or a glob."""

from lanebeacon.sources.files import open_bucketed
from lanebeacon.sources.traffic import read_fcd_csv, read_person_master, read_traces_master, read_vehicle_master
from lanebeacon.sources.wifi import (
    read_bookings_json,
    read_bookings_master,
    read_meta_json,
    read_meta_master,
    read_readings_json,
    read_readings_master,
)

__all__ = [
    "open_bucketed",
    "read_bookings_json",
    "read_bookings_master",
    "read_fcd_csv",
    "read_meta_json",
    "read_meta_master",
    "read_person_master",
    "read_readings_json",
    "read_readings_master",
    "read_traces_master",
    "read_vehicle_master",
]
