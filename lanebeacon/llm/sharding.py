"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Documents with equal text form a group. A group is a vector of bytes, tokens (words)
and rows, measured in shard capacities (a shard's even share of each total), and goes to
the shard where its dot product with the residual capacity is highest, large groups
first.

To pack any number of groups, only a bounded number of vectors is packed in one place:

* Groups that weigh ``1 / HEAVY`` of a shard or more in any measure; there are at most
  ``3 * HEAVY * shards`` of them. One larger than a shard is first cut into pieces of
  about ``1 / PIECES`` of a shard by a hash of the row's place in the table, whatever its id.
* The others are dealt by a hash into parts. Each part packs its own groups by the same
  rule into ``BUNDLES`` bundles, a quarter of which are small. The bundles of all parts
  are then packed like groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanebeacon.llm.common import shuffle_partitions, stored, table, word_count

LAW = "bytes"
MEASURES = ("bytes", "tokens", "rows")
# What each measure counts in the dot product: bytes are to be near equal, the others follow.
WEIGHTS = np.array([8.0, 1.0, 1.0])
HEAVY = 128
PIECES = 32
BUNDLES = 64
# A quarter of the bundles are small; packed last, they even out what the large ones leave.
_BUNDLE_SIZES = np.where(np.arange(BUNDLES) % 4 == 3, 0.125, 1.0)


def pack(vectors: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Bin of each vector; ``residual`` (bins by measures) is what the bins can still take.

    Large vectors come first, in the given order among equals. Each goes where its dot
    product with the residual capacity, weighed by ``WEIGHTS``, is highest. Residuals may
    become negative, so that every vector finds a place.
    """
    bins = np.empty(len(vectors), dtype=np.int32)
    for i in np.argsort(-vectors.max(axis=1, initial=0.0), kind="stable"):
        bins[i] = place = int(np.argmax(residual @ (vectors[i] * WEIGHTS)))
        residual[place] -= vectors[i]
    return bins


def shard_documents(
    docs: DataFrame, shards: int = 16, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, size, tokens, text_crc32, shard, slot`` of every row of ``docs``.

    ``size`` is the number of UTF-8 bytes plus 1, ``slot`` counts from 0 without gaps within
    a shard, in no particular order. Equal texts share a shard unless together they exceed
    a shard's even share in some measure. Bytes count most in the packing (``WEIGHTS``), so they come out most even. NULL text counts as an empty one; NULL or repeated
    ids are rows like others; an empty table gives no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    measured = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            word_count(text).alias("tokens"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("digest"),
            # Written down, so that a row keeps it.
            F.monotonically_increasing_id().alias("place"),
        ),
        "shard-measured",
    )
    groups = measured.groupBy("digest").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")
    )
    groups = stored(groups, "shard-groups")
    totals = groups.agg(*[F.sum(measure).cast("double").alias(measure) for measure in MEASURES]).first()
    capacity = {measure: max((totals[measure] or 0.0) / shards, 1.0) for measure in MEASURES}
    weighed = groups.select("digest", *[(F.col(m) / F.lit(capacity[m])).alias(m) for m in MEASURES])
    weight = F.greatest(*MEASURES)
    pieces = F.when(weight > 1.0, F.ceil(weight * PIECES)).otherwise(F.lit(1)).cast("int")
    weighed = weighed.withColumn("pieces", pieces).withColumn("heavy", weight >= 1.0 / HEAVY)

    # Heavy groups: single ones by their own vector, larger ones by the vectors of their pieces.
    heavy = weighed.where("heavy")
    # No more than three times as many groups as shards are larger than a shard.
    cut = F.broadcast(heavy.where("pieces > 1").select("digest", "pieces"))
    in_piece = F.pmod(F.xxhash64(F.lit(1), "place"), F.col("pieces")).cast("int")
    pieced = (
        measured.join(cut, "digest")
        .withColumn("piece", in_piece)
        .groupBy("digest", "piece")
        .agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
        .select("digest", "piece", *[(F.col(m) / F.lit(capacity[m])).alias(m) for m in MEASURES])
    )
    whole = heavy.where("pieces = 1").select("digest", F.lit(0).alias("piece"), *MEASURES)
    heavies = whole.unionByName(pieced).orderBy("digest", "piece").toPandas()

    # Light groups: bundles, packed part by part.
    parts = shuffle_partitions(spark)
    light = weighed.where("not heavy").select("digest", *MEASURES)
    dealt = light.repartition(parts, F.xxhash64("digest")).sortWithinPartitions("digest")
    bundled = stored(dealt.mapInPandas(_bundle, "part int, digest binary, bundle int, bytes double, tokens double, rows double"), "shard-bundles")
    sums = bundled.groupBy("part", "bundle").agg(*[F.sum(F.round(m, 12)).alias(m) for m in MEASURES]).toPandas()
    sums = sums.sort_values(["part", "bundle"], kind="stable")

    vectors = np.concatenate([heavies[list(MEASURES)].to_numpy(float), sums[list(MEASURES)].to_numpy(float)])
    placed = pack(vectors, np.ones((shards, len(MEASURES))))
    heavies["shard"], sums["shard"] = placed[: len(heavies)], placed[len(heavies) :]
    # Both tables have a bounded number of rows, so they can be broadcast.
    heavy_shards = spark.createDataFrame(
        [(bytes(d), int(p), int(s)) for d, p, s in zip(heavies["digest"], heavies["piece"], heavies["shard"])],
        "digest binary, piece int, heavy_shard int",
    )
    bundle_shards = spark.createDataFrame(
        [(int(p), int(b), int(s)) for p, b, s in zip(sums["part"], sums["bundle"], sums["shard"])],
        "part int, bundle int, light_shard int",
    )
    light_shards = bundled.join(F.broadcast(bundle_shards), ["part", "bundle"]).select("digest", "light_shard")
    dealt_rows = (
        measured.join(cut, "digest", "left")
        .withColumn("piece", F.coalesce(in_piece, F.lit(0)))
        .join(F.broadcast(heavy_shards), ["digest", "piece"], "left")
    )
    columns = ["doc_id", "size", "tokens", "text_crc32", "place"]
    # Only rows of light groups, of which none is a large share of all, are shuffled to their shard.
    of_heavy = dealt_rows.where("heavy_shard is not null").select(*columns, F.col("heavy_shard").alias("shard"))
    of_light = dealt_rows.where("heavy_shard is null").join(light_shards, "digest").select(*columns, F.col("light_shard").alias("shard"))
    return _with_slots(stored(of_heavy.unionByName(of_light), "shard-placed"), parts)


def _bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Packs the groups of one part into bundles; the part's number is that of its task."""
    from pyspark import TaskContext

    groups = pd.concat([pd.DataFrame({"digest": [], **{m: [] for m in MEASURES}}), *batches], ignore_index=True)
    if groups.empty:
        return
    vectors = groups[list(MEASURES)].to_numpy(float)
    share = np.maximum(vectors.sum(axis=0), 1e-300)
    capacity = np.repeat(_BUNDLE_SIZES[:, None] / _BUNDLE_SIZES.sum(), len(MEASURES), axis=1)
    groups["bundle"] = pack(vectors / share, capacity)
    groups["part"] = TaskContext.get().partitionId()
    yield groups[["part", "digest", "bundle", *MEASURES]].astype({"part": "int32", "bundle": "int32"})


def _with_slots(placed: DataFrame, parts: int) -> DataFrame:
    """Numbers the rows of each shard: by ranks within slices of it, behind the slices before."""
    sliced = placed.withColumn("slice", F.pmod(F.xxhash64("place"), F.lit(parts)).cast("int"))
    counts = sliced.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n"))
    # One row per shard and slice.
    earlier = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "place"))
    ranked = sliced.withColumn("rank", rank).join(F.broadcast(starts), ["shard", "slice"])
    return ranked.withColumn("slot", F.col("start") + F.col("rank") - 1).drop("slice", "rank", "start", "place")


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal sizes."""
    sharded = shard_documents(table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
