"""DataFrame-to-DataFrame operators."""

from lanebeacon.operators.heatmap import heatmap_density
from lanebeacon.operators.lanes import cars_per_lane, edge_traffic, lane_zipper, parse_lanes
from lanebeacon.operators.lectures import booked_times, lecture_attendance, lecture_connections
from lanebeacon.operators.reshape import clean_locations, device_sightings, explode_bookings, flatten_readings
from lanebeacon.operators.traces import split_persons, split_traces, split_vehicles
from lanebeacon.operators.vehicles import timestep_count, vehicles_per_lane, vehicles_per_timestep
from lanebeacon.operators.wifi_views import (
    client_hours,
    client_sketches,
    room_occupancy_hourly,
    signal_quality_profile,
    weekly_router_usage,
)

__all__ = [
    "booked_times",
    "cars_per_lane",
    "clean_locations",
    "client_hours",
    "client_sketches",
    "device_sightings",
    "edge_traffic",
    "explode_bookings",
    "flatten_readings",
    "heatmap_density",
    "lane_zipper",
    "lecture_attendance",
    "lecture_connections",
    "parse_lanes",
    "room_occupancy_hourly",
    "signal_quality_profile",
    "split_persons",
    "split_traces",
    "split_vehicles",
    "timestep_count",
    "vehicles_per_lane",
    "vehicles_per_timestep",
    "weekly_router_usage",
]
