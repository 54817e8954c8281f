"""Nearest neighbours by counting collisions of query-centred windows.

Every vector is projected on ``PROJECTIONS`` random directions, and the projections of a block of
vectors are kept as sorted arrays, one for each direction. A query looks at a window of each array centred on
its own projection, which widens step by step (virtual rehashing: no buckets are built
anew). A vector that lies in at least ``THRESHOLD`` of the windows is verified: its
cosine is computed.

A vector at distance s lies in a window of half width w with chance ``2 Phi(w / s) - 1``, and in
different windows almost independently. So once w is wide enough for a vector at the distance of the k-th best verified
one to pass the threshold with chance ``CONFIDENCE``, every nearer one would have been found
with at least that chance, and the query is done. That rule holds at any size; there is no
cap on candidates.

Vectors are dealt into blocks and queries into chunks of bounded size; each block meets each
chunk in a task of its own, and the best of all blocks are ranked at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanebeacon.llm.common import shuffle_partitions, stored, table

PROJECTIONS = 128
# Windows a vector has to lie in.
THRESHOLD = 80
CONFIDENCE = 0.93
# First half width, and the factor by which windows widen.
FIRST_WIDTH, WIDEN = 0.8, 1.06
# Vectors of a block and queries of a chunk at most; blocks are smaller where that keeps more tasks busy.
BLOCK, LEAST_BLOCK, CHUNK = 16_384, 512, 2_048
SEED = 3


def _chance_needed() -> float:
    """Chance of one window from which ``THRESHOLD`` of ``PROJECTIONS`` are reached with ``CONFIDENCE``."""

    def reached(p: float) -> float:
        return sum(math.comb(PROJECTIONS, i) * p**i * (1 - p) ** (PROJECTIONS - i) for i in range(THRESHOLD, PROJECTIONS + 1))

    low, high = 0.0, 1.0
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (middle, high) if reached(middle) < CONFIDENCE else (low, middle)
    return high


# Half width, in distances, at which a vector is found with the wanted chance.
_WIDTHS = NormalDist().inv_cdf((1 + _chance_needed()) / 2)


class Block:
    """Vectors of a block with their sorted projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.directions = np.random.default_rng(SEED).standard_normal((vectors.shape[1], PROJECTIONS))
        projected = (self.unit @ self.directions).T
        self.order = np.argsort(projected, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(projected, self.order, axis=1)

    def windows(self, at: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows of all queries begin and end in each array, from the queries' projections."""
        low, high = np.empty(at.shape, np.int32), np.empty(at.shape, np.int32)
        for j, row in enumerate(self.sorted):
            low[:, j] = np.searchsorted(row, at[:, j] - width)
            high[:, j] = np.searchsorted(row, at[:, j] + width, side="right")
        return low, high

    def nearest(self, query_ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[np.ndarray]:
        """For each query the places of what it has verified, without its own vectors."""
        units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        at = units @ self.directions
        # Windows without anything in them, so that the first step counts equal projections too.
        nothing = self.windows(at, 0.0)[0]
        steps: list[tuple[np.ndarray, np.ndarray]] = [(nothing, nothing)]
        for q, (query_id, unit) in enumerate(zip(query_ids, units)):
            own = self.ids == query_id
            counts, verified = np.zeros(len(own), np.int64), own.copy()
            found, cosines = np.zeros(0, np.int64), np.zeros(0)
            width, step = FIRST_WIDTH, 1
            while not verified.all():
                if step == len(steps):
                    steps.append(self.windows(at, width))
                (low, high), (lower, higher) = steps[step - 1], steps[step]
                wings = zip(self.order, lower[q].tolist(), low[q].tolist(), high[q].tolist(), higher[q].tolist())
                parts = [part for row, a, b, c, d in wings for part in (row[a:b], row[c:d])]
                counts += np.bincount(np.concatenate(parts), minlength=len(counts))
                fresh = np.flatnonzero((counts >= THRESHOLD) & ~verified)
                verified[fresh] = True
                found, cosines = np.append(found, fresh), np.append(cosines, self.unit[fresh] @ unit)
                if len(cosines) >= k:
                    kth = np.partition(cosines, len(cosines) - k)[len(cosines) - k]
                    if width >= _WIDTHS * math.sqrt(max(2 - 2 * kth, 0.0)):
                        break
                width, step = width * WIDEN, step + 1
            yield found


def _search(block_rows: pd.DataFrame, query_rows: pd.DataFrame, k: int) -> pd.DataFrame:
    if block_rows.empty or query_rows.empty:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    block_rows = block_rows.sort_values("id", kind="stable")
    block = Block(block_rows["id"].to_numpy(), np.array(block_rows["vector"].tolist(), dtype=float))
    query_ids, queries = query_rows["id"].to_numpy(), np.array(query_rows["vector"].tolist(), dtype=float)
    results = []
    for query_id, query, places in zip(query_ids, queries, block.nearest(query_ids, queries, k)):
        # The score of the answer is computed on the vectors as they are.
        score = exact_cosines(block.vectors[places], query)
        best = np.lexsort((block.ids[places], -score))[:k]
        results.append(pd.DataFrame({"query_id": query_id, "vec_id": block.ids[places][best], "score": score[best]}))
    return pd.concat(results, ignore_index=True)


def exact_cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    return (vectors @ query) / (np.sqrt((vectors * vectors).sum(axis=1)) * math.sqrt(float(query @ query)))


def usable(vector: Column) -> Column:
    """Neither NULL nor empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest_neighbours(
    vectors: DataFrame, queries: Column, *, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``queries`` marks, its ``k`` nearest other rows.

    Nearness is the largest cosine, in double precision; ties go to the smaller id. Rows
    with a NULL id, or a vector that is NULL, empty, zero or not finite, take no part; vectors of
    another length than the query's are no candidates. All rows with the query's id are its own.
    If there are fewer than ``k`` other rows, all of them are found. An empty table gives no
    rows. Other columns are not looked at.
    """
    rows = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks")
    )
    rows = stored(rows.distinct().withColumn("length", F.size("vector")), "vectors")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    busy = min(math.ceil(sizes["n"] / LEAST_BLOCK), shuffle_partitions(vectors.sparkSession))
    blocks, chunks = max(1, math.ceil(sizes["n"] / BLOCK), busy), max(1, math.ceil(sizes["q"] / CHUNK))
    dealt = F.xxhash64(F.lit(SEED), "id")

    def everywhere(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    data = rows.select("id", "vector", "length", F.pmod(dealt, F.lit(blocks)).cast("int").alias("block"), everywhere(chunks).alias("chunk"))
    asked = rows.where("asks").select("id", "vector", "length", F.pmod(dealt, F.lit(chunks)).cast("int").alias("chunk"), everywhere(blocks).alias("block"))
    keys = ["length", "block", "chunk"]
    kind = vectors.schema[id_col].dataType.simpleString()
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
        lambda block_rows, query_rows: _search(block_rows, query_rows, k).astype({"score": "float64"}),
        f"query_id {kind}, vec_id {kind}, score double",
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # A query that stands in several rows may find the same vector more than once.
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 5 nearest other rows of every vector whose id is divisible by 50."""
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours(embeddings, F.col("vec_id") % 50 == 0)
