"""Incremental loads of daily files, and views over readings that still come in."""

from lanebeacon.streaming.ingest import stream_bookings, stream_readings
from lanebeacon.streaming.occupancy import close_hours, read_occupancy, stream_occupancy

__all__ = ["close_hours", "read_occupancy", "stream_bookings", "stream_occupancy", "stream_readings"]
