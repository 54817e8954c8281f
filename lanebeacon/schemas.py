"""Schemas of raw input and master tables. Nothing is ever inferred.

The field names are fixed values: they must match the input files.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    FloatType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

STRING, DOUBLE, FLOAT, LONG, WALL_TIME = StringType(), DoubleType(), FloatType(), LongType(), TimestampNTZType()


def columns(**types: DataType) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in types.items()])


CLIENT = columns(cid=STRING, clientOS=STRING, rssi=DOUBLE, snRatio=DOUBLE, ssid=STRING)
READINGS_RAW = columns(did=STRING, readings=ArrayType(columns(clients=ArrayType(CLIENT), ts=LONG)))
READINGS = columns(did=STRING, cid=STRING, clientOS=STRING, rssi=DOUBLE, snRatio=DOUBLE, ssid=STRING, ts=LONG)

# Master data kept as text delivers the two measures as strings; the views accept both.
READINGS_TEXT = columns(did=STRING, cid=STRING, clientOS=STRING, rssi=STRING, snRatio=STRING, ssid=STRING, ts=LONG)

META = columns(did=STRING, location=STRING)

BOOKINGS_RAW = columns(
    name=STRING,
    startDate=STRING,
    endDate=STRING,
    startTime=STRING,
    endTime=STRING,
    room=STRING,
    type=STRING,
    lecturers=STRING,
    programme=STRING,
)
BOOKINGS = StructType([*BOOKINGS_RAW, *columns(start_ts=WALL_TIME, end_ts=WALL_TIME)])

# The simulator's wide trace: a row fills either the vehicle half or the person half.
FCD_RAW = columns(
    timestep_time=FLOAT,
    vehicle_id=STRING,
    vehicle_x=STRING,
    vehicle_y=STRING,
    vehicle_z=STRING,
    vehicle_angle=STRING,
    vehicle_type=STRING,
    vehicle_speed=STRING,
    vehicle_pos=STRING,
    vehicle_lane=STRING,
    vehicle_slope=STRING,
    person_id=STRING,
    person_x=STRING,
    person_y=STRING,
    person_z=STRING,
    person_angle=STRING,
    person_speed=STRING,
    person_pos=STRING,
    person_edge=STRING,
    person_slope=STRING,
)
VEHICLE = columns(
    timestep_time=FLOAT,
    vehicle_id=STRING,
    vehicle_x=DOUBLE,
    vehicle_y=DOUBLE,
    vehicle_angle=DOUBLE,
    vehicle_type=STRING,
    vehicle_speed=DOUBLE,
    vehicle_pos=DOUBLE,
    vehicle_lane=STRING,
)
PERSON = columns(
    timestep_time=FLOAT,
    person_id=STRING,
    person_x=DOUBLE,
    person_y=DOUBLE,
    person_angle=DOUBLE,
    person_speed=DOUBLE,
    person_pos=DOUBLE,
    person_edge=STRING,
)
POINTS = columns(lat=DOUBLE, lng=DOUBLE)
