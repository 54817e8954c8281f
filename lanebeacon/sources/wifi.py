"""Wi-Fi readings, router locations and room bookings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanebeacon import schemas
from lanebeacon.sources.files import DATED, read_master, with_corrupt, with_file_columns

Paths = str | list[str]


def read_readings_json(spark: SparkSession, paths: Paths) -> DataFrame:
    """JSON Lines of routers with nested readings, with the file columns and ``_corrupt_record``."""
    return with_file_columns(spark.read.schema(with_corrupt(schemas.READINGS_RAW)).json(paths))


def read_meta_json(spark: SparkSession, paths: Paths) -> DataFrame:
    """JSON Lines of routers and their locations, with ``_corrupt_record``."""
    return spark.read.schema(with_corrupt(schemas.META)).json(paths)


def read_bookings_json(spark: SparkSession, paths: Paths) -> DataFrame:
    """JSON Lines of bookings, with the file columns and ``_corrupt_record``."""
    return with_file_columns(spark.read.schema(with_corrupt(schemas.BOOKINGS_RAW)).json(paths))


def read_readings_master(spark: SparkSession, paths: Paths, fmt: str = "parquet") -> DataFrame:
    schema = schemas.READINGS if fmt == "parquet" else schemas.READINGS_TEXT
    return read_master(spark, paths, schema, fmt, partitions=DATED)


def read_meta_master(spark: SparkSession, paths: Paths, fmt: str = "parquet") -> DataFrame:
    return read_master(spark, paths, schemas.META, fmt)


def read_bookings_master(spark: SparkSession, paths: Paths, fmt: str = "parquet") -> DataFrame:
    return read_master(spark, paths, schemas.BOOKINGS, fmt, header=True, partitions=DATED)
