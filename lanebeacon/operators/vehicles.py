"""Distinct-vehicle counts over traces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanebeacon.functions.aggregates import distinct_count


def vehicles_per_timestep(vehicle: DataFrame, *, approx: bool = False) -> DataFrame:
    """Distinct vehicles per timestep, in time order."""
    per_step = vehicle.groupBy("timestep_time").agg(distinct_count("vehicle_id", approx).alias("vehicles"))
    return per_step.orderBy("timestep_time")


def vehicles_per_lane(vehicle: DataFrame, n: int | None = None, *, approx: bool = False) -> DataFrame:
    """Distinct vehicles per lane, the most first, ties in lane order; ``n`` keeps that many lanes."""
    per_lane = vehicle.groupBy("vehicle_lane").agg(distinct_count("vehicle_id", approx).alias("vehicles"))
    busiest = per_lane.orderBy(F.desc("vehicles"), "vehicle_lane")
    return busiest if n is None else busiest.limit(n)


def timestep_count(vehicle: DataFrame, *, approx: bool = False) -> DataFrame:
    """Number of distinct timesteps."""
    return vehicle.agg(distinct_count("timestep_time", approx).alias("timesteps"))
