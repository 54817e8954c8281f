"""Weights for a heatmap of positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heatmap_density(points: DataFrame, cell: float | None = None) -> DataFrame:
    """How often each position occurs: the exact one, or its square of side ``cell``.

    Squares are numbered from the origin; (``lat_cell`` × ``cell``, ``lng_cell`` × ``cell``)
    is the lower corner. A hot position is already counted inside each map task.
    """
    if cell is not None and not cell > 0:
        raise ValueError(f"cell must be above 0, not {cell!r}")
    if cell is None:
        return points.groupBy("lat", "lng").agg(F.count("*").alias("weight"))
    return points.groupBy(
        F.floor(F.col("lat") / cell).alias("lat_cell"), F.floor(F.col("lng") / cell).alias("lng_cell")
    ).agg(F.count("*").alias("weight"))
