"""Splitting the simulator's wide rows into vehicle rows and person rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanebeacon.schemas import PERSON, VEHICLE

VEHICLE_KIND = "vehicle"
PERSON_KIND = "person"
BOTH_KINDS = "both"


def split_vehicles(fcd: DataFrame) -> DataFrame:
    return fcd.where(F.col("vehicle_id").isNotNull()).select(*_typed(VEHICLE))


def split_persons(fcd: DataFrame) -> DataFrame:
    return fcd.where(F.col("person_id").isNotNull()).select(*_typed(PERSON))


def split_traces(fcd: DataFrame) -> DataFrame:
    """Both halves at once, for writing both master tables from a single scan.

    ``vehicle`` and ``person`` are structs, NULL where the row has no such half; ``kind``
    says which of them are there.
    """
    has_vehicle, has_person = F.col("vehicle_id").isNotNull(), F.col("person_id").isNotNull()
    kind = F.when(has_vehicle & has_person, BOTH_KINDS).when(has_vehicle, VEHICLE_KIND).otherwise(PERSON_KIND)
    return fcd.where(has_vehicle | has_person).select(
        kind.alias("kind"),
        F.when(has_vehicle, F.struct(*_typed(VEHICLE))).alias("vehicle"),
        F.when(has_person, F.struct(*_typed(PERSON))).alias("person"),
    )


def _typed(schema) -> list[Column]:
    """The columns of ``schema``, numbers read from text; text that is no number gives NULL."""
    return [F.col(field.name).try_cast(field.dataType).alias(field.name) for field in schema]
