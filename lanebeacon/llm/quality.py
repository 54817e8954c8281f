"""Quality scores by Bradley-Terry ranking.

Of two documents the one with the better label is preferred. The model gives every document a
worth, linear in its features, so that the chance of a preference is the logistic function of the
difference in worth. It is fitted by logistic loss on feature differences of pairs, a block of pairs
at a time. The threshold is the quantile of worth above which there are as many labelled documents as good
ones; it is taken from a histogram of the worths of all labelled documents.

Features describe how a text is written, not what it says: shares of its pairs of
neighbouring character classes, and of words that repeat the one before, over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType

from lanebeacon.llm.common import small_batches, table
from lanebeacon.llm.words import BLOCK_BYTES, raw_bytes, text_blocks, word_hashes

# Labelled ids that are fitted on, the first in order of a hash; different rows of counts among their documents, the
# first in order of a hash; pairs of those, and pairs whose gradients are summed at a time.
MOST_LABELLED = 20_000
PAIRS = 100_000
PAIRS_AT_ONCE = 10_000
# Cells of the histogram of worths.
BINS = 1 << 16
RIDGE = 1e-4
SEED = 4

# Classes of bytes: other control characters and symbols fall into class 0.
_CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:!?", b"'\"()-", b"|", b"<>/={}[]\\_", b"@#$%&*+~^`")
N_CLASSES = len(_CLASSES) + 2
_CLASS_OF = np.zeros(256, dtype=np.int64)
for _number, _members in enumerate(_CLASSES, 1):
    _CLASS_OF[list(_members)] = _number
_CLASS_OF[128:] = N_CLASSES - 1
N_PAIRS = N_CLASSES * N_CLASSES
# Counts of class pairs, of words, and of words that are like the one before.
N_COUNTS = N_PAIRS + 2
# A text's shares are mixed with the average ones, as if that many more pairs and words were like those.
SHRINK_PAIRS, SHRINK_WORDS = 60.0, 10.0


def text_counts(texts: pa.Array) -> np.ndarray:
    """What a text is judged by, over all of it; zeros for an empty text."""
    content, offsets = raw_bytes(texts)
    counts = np.zeros((len(texts), N_COUNTS))
    for first, last in text_blocks(offsets):
        own = offsets[first : last + 1]
        for a in range(own[0], own[-1], 2 * BLOCK_BYTES):
            b = min(a + 2 * BLOCK_BYTES, int(own[-1]))
            classes = _CLASS_OF[content[a : min(b + 1, int(own[-1]))]]
            pairs = classes[:-1] * N_CLASSES + classes[1:]
            lengths = np.diff(np.clip(own, a, a + len(pairs)))
            owner = np.repeat(np.arange(last - first), lengths)
            borders = own[1:-1] - 1 - a
            pairs = pairs[: len(owner)] + owner * N_PAIRS
            kept = np.ones(len(pairs), dtype=bool)
            kept[borders[(borders >= 0) & (borders < len(pairs))]] = False
            cells = np.bincount(pairs[kept], minlength=(last - first) * N_PAIRS)
            counts[first:last, :N_PAIRS] += cells.reshape(last - first, N_PAIRS)
        hashes, words = word_hashes(content, own)
        same = np.append(False, hashes[1:] == hashes[:-1])
        starts = np.cumsum(words) - words
        same[starts[words > 0]] = False
        counts[first:last, N_PAIRS] = words
        counts[first:last, N_PAIRS + 1] = np.diff(np.append(0, np.cumsum(same))[np.append(starts, len(same))])
    return counts


@dataclass
class Ranking:
    """Worth of a document is its features times ``weights``; at ``cut`` it counts as good.

    ``average`` is what a document of unknown kind is like, ``poor`` the worth of one without anything to judge.
    """

    average: np.ndarray
    weights: np.ndarray
    cut: float = 0.0
    poor: float = 0.0

    def features(self, counts: np.ndarray) -> np.ndarray:
        """Square roots of shares; the shorter a text, the closer to the average."""
        pairs, words, same = counts[:, :N_PAIRS], counts[:, N_PAIRS, None], counts[:, N_PAIRS + 1 :]
        shares = (pairs + SHRINK_PAIRS * self.average[:N_PAIRS]) / (pairs.sum(axis=1, keepdims=True) + SHRINK_PAIRS)
        again = (same + SHRINK_WORDS * self.average[N_PAIRS:]) / (words + SHRINK_WORDS)
        return np.sqrt(np.hstack([shares, again]))

    def worths(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts[:, N_PAIRS] > 0, self.features(counts) @ self.weights, self.poor)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.worths(counts) - self.cut, -30, 30)))

    @property
    def furthest(self) -> float:
        """No worth is further from 0: the squares of a document's features add up to two at most."""
        return float(np.sqrt(2) * np.linalg.norm(self.weights)) + abs(self.poor) + 1e-9


def _average(counts: np.ndarray, copies: np.ndarray) -> np.ndarray:
    each = counts[:, :N_PAIRS] / np.maximum(counts[:, :N_PAIRS].sum(axis=1, keepdims=True), 1)
    again = counts[:, N_PAIRS + 1] / np.maximum(counts[:, N_PAIRS], 1)
    return np.average(np.hstack([each, again[:, None]]), axis=0, weights=copies)


def fit_weights(better: np.ndarray, worse: np.ndarray, features: np.ndarray, *, at_once: int = PAIRS_AT_ONCE) -> np.ndarray:
    """Weights for which the logistic loss of the preferences of rows ``better`` over rows ``worse`` is least, by Newton steps.

    Gradient and curvature are sums over blocks of ``at_once`` pairs, so memory does not grow with the pairs.
    """
    n, weights = len(better), np.zeros(features.shape[1])
    for _ in range(25):
        slope, curve = -RIDGE * weights, RIDGE * np.eye(len(weights))
        for a in range(0, n, at_once):
            differences = features[better[a : a + at_once]] - features[worse[a : a + at_once]]
            p = 1 / (1 + np.exp(-np.clip(differences @ weights, -30, 30)))
            slope = slope + differences.T @ (1 - p) / n
            curve = curve + (differences * (p * (1 - p))[:, None]).T @ differences / n
        step = np.linalg.solve(curve, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def fit_ranking(counts: np.ndarray, good: np.ndarray, copies: np.ndarray, *, pairs: int = PAIRS, seed: int = SEED) -> Ranking:
    """Fits worths to ``pairs`` preferences of good over bad documents, drawn by how many ``copies`` of a row there are.

    Without documents of both kinds there is no preference: all worths and the cut are 0, so
    every document counts as good. Documents without words are as poor as the average bad one.
    """
    best, worst = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(best) or not len(worst):
        return Ranking(np.zeros(N_PAIRS + 1), np.zeros(N_PAIRS + 1))
    averages = [_average(counts[rows], copies[rows]) for rows in (best, worst)]
    ranking = Ranking((averages[0] + averages[1]) / 2, np.zeros(N_PAIRS + 1))
    chance = np.random.default_rng(seed)
    better, worse = (chance.choice(rows, pairs, p=copies[rows] / copies[rows].sum()) for rows in (best, worst))
    ranking.weights = fit_weights(better, worse, ranking.features(counts))
    ranking.poor = float(np.sqrt(averages[1]) @ ranking.weights)
    return ranking


def quantile_cut(ranking: Ranking, cells: np.ndarray, sizes: np.ndarray, n_bad: int) -> float:
    """The worth below which ``n_bad`` documents are, from the ``sizes`` of histogram ``cells`` in order.

    It is the middle between a hundredth of the documents below that and above it, so that
    single wrong labels do not push the cut into either side.
    """
    upto = np.cumsum(sizes)
    total = int(upto[-1])
    around = max(1, total // 100)
    places = np.array([max(n_bad - around, 0), min(n_bad + around - 1, total - 1)])
    at = cells[np.searchsorted(upto, places, side="right")]
    return float(((at + 0.5) / BINS * 2 - 1).mean() * ranking.furthest)


def held_out(doc_id: Column) -> Column:
    """Whether an id is kept for measuring: a third of all, by its checksum."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn_quality(docs: DataFrame, labels: DataFrame, *, most: int = MOST_LABELLED) -> Ranking:
    """A ranking from labelled documents that are not held out.

    Weights are fitted to the documents of at most ``most`` ids, those that come first by a hash. Documents of the
    same label that count alike are one row with a weight, and of different rows the first ``most``
    by a hash are taken, so the driver gets a bounded number of rows, whatever an id is shared by. The cut is
    a quantile over all labelled documents, of which the driver gets the sizes of the cells of a histogram.
    Ids with NULL or contradictory labels, and NULL ids, are left out; an id that several documents share counts
    for each.
    """
    usable = (
        labels.where("doc_id is not null and quality is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where("quality = most")
        .select("doc_id", (F.col("quality") == 1).alias("good"))
    )
    sample = usable.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(most)
    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    # The sample has ``most`` rows at most.
    rows = texts.join(F.broadcast(sample), "doc_id").select("good", _counted("text").alias("counts"))
    alike = rows.groupBy("good", "counts").agg(F.count("*").alias("copies"))
    known = alike.orderBy(F.xxhash64(F.lit(SEED), "counts", "good"), "counts", "good").limit(most).toArrow()
    counts = np.frombuffer(b"".join(known["counts"].to_pylist()), np.float32).reshape(len(known), N_COUNTS)
    ranking = fit_ranking(counts, known["good"].to_numpy().astype(bool), known["copies"].to_numpy().astype(float))
    if not ranking.weights.any():
        return ranking
    # One row per id and cell, before labels come in.
    placed = texts.where("doc_id is not null").select("doc_id", _cell(ranking)("text").alias("cell")).groupBy("doc_id", "cell").agg(F.count("*").alias("size"))
    sizes = placed.join(usable, "doc_id").groupBy("cell").agg(F.sum("size").alias("size"), F.sum(F.when(F.col("good"), 0).otherwise(F.col("size"))).alias("bad"))
    found = sizes.orderBy("cell").toArrow()
    ranking.cut = quantile_cut(ranking, found["cell"].to_numpy(), found["size"].to_numpy(), int(found["bad"].to_numpy().sum()))
    return ranking


def _cell(ranking: Ranking):
    """Cell of a text's worth in a histogram of ``BINS`` cells over all possible worths."""

    @arrow_udf("int")
    def cell(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            share = (ranking.worths(text_counts(texts)) / ranking.furthest + 1) / 2
            yield pa.array(np.clip(share * BINS, 0, BINS - 1).astype(np.int32))

    return cell


@arrow_udf(BinaryType())
def _counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([row.tobytes() for row in text_counts(texts).astype(np.float32)], pa.binary())


def score_quality(docs: DataFrame, ranking: Ranking, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` from 0 to 1, half at the cut.

    Texts without words, NULL and empty ones among them, have the score of the average bad document.
    """

    @arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(ranking.scores(text_counts(texts)), pa.float64())

    small_batches(docs.sparkSession)
    return docs.withColumn(score_col, score(F.col(text_col)))


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """Every document's quality score and prediction."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, learn_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
