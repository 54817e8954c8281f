"""Connected components of links between documents, without gathering any of them in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanebeacon.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``: the smallest node that can be reached.

    Alternating large and small stars: every node passes the smallest of its neighbours on to
    those larger than itself, then to those smaller. The number of links never grows, and
    rounds end when none has changed. Links of a node with itself are left out.
    """
    pairs = links.where("a != b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct()
    pairs = stored(pairs, "links")
    before = _state(pairs)
    while before[0]:
        both = pairs.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
            pairs.select(F.col("low").alias("u"), F.col("high").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()
        lowest = large.groupBy("high").agg(F.min("low").alias("m"))
        down = large.join(lowest, "high")
        small = down.select("high", F.col("m").alias("low")).unionByName(
            down.where("low != m").select(F.col("low").alias("high"), F.col("m").alias("low"))
        )
        pairs = stored(small.where("low != high").select("low", "high").distinct(), "stars")
        after = _state(pairs)
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return pairs.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(roots)


def _state(pairs: DataFrame) -> tuple[int, int]:
    row = pairs.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.shiftright(F.xxhash64("low", "high"), 20)), F.lit(0)).alias("h")
    ).first()
    return row["n"], row["h"]
