"""Simulator traces and the vehicle and person tables made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanebeacon import schemas
from lanebeacon.operators.traces import BOTH_KINDS, PERSON_KIND, VEHICLE_KIND
from lanebeacon.sources.files import read_master, with_corrupt

Paths = str | list[str]


def read_fcd_csv(spark: SparkSession, paths: Paths) -> DataFrame:
    """The wide trace: ``;`` separated, with a header line, and ``_corrupt_record``.

    All columns are parsed, since a line of the wrong length is only seen as such by a parser of all of them.
    """
    reader = spark.read.schema(with_corrupt(schemas.FCD_RAW)).option("columnPruning", False)
    return reader.csv(paths, sep=";", header=True)


def read_vehicle_master(spark: SparkSession, paths: Paths, fmt: str = "parquet") -> DataFrame:
    return read_master(spark, paths, schemas.VEHICLE, fmt)


def read_person_master(spark: SparkSession, paths: Paths, fmt: str = "parquet") -> DataFrame:
    return read_master(spark, paths, schemas.PERSON, fmt)


def read_traces_master(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Vehicle or person rows of a combined traces table; only partitions with such rows are read."""
    if kind not in (VEHICLE_KIND, PERSON_KIND):
        raise ValueError(f"kind must be {VEHICLE_KIND!r} or {PERSON_KIND!r}, not {kind!r}")
    return spark.read.parquet(path).where(F.col("kind").isin(kind, BOTH_KINDS)).select(f"{kind}.*")
