"""Numbers without gaps within groups, however large a group is.

Rows are sorted over ranges of (group, order), and the counts of the ranges give each its first number, so no
group passes through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanebeacon.llm.common import shuffle_partitions, stored

# Bits of ``monotonically_increasing_id`` that count within a partition.
_IN_PARTITION = 33


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, gapless from 0 within each ``group`` by ``order``, and ``n``, the rows of the group.

    Rows that agree in all of ``order`` are told apart by their place in the input; they have to be
    alike in what is made of them. ``group`` is never NULL; a NULL in ``order`` comes first.
    """
    n = shuffle_partitions(rows.sparkSession)
    keys = [group, *order, "_place"]
    dealt = rows.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # Written down, as the borders of the ranges come from a sample.
    placed = stored(dealt.drop("_place").withColumn("place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("place", _IN_PARTITION)
    runs = placed.groupBy(group, part.alias("part")).agg(F.min("place").alias("begin"), F.count("*").alias("size"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per group and range it reaches into.
    offsets = runs.select(
        group,
        "part",
        (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("begin")).alias("shift"),
        F.sum("size").over(Window.partitionBy(group)).alias("n"),
    )
    joined = placed.withColumn("part", part).join(offsets, [group, "part"])
    return joined.withColumn("idx", F.col("place") + F.col("shift")).drop("part", "place", "shift")
