"""Mixing sources to target weights by pivotal rounding, in DataFrame functions only.

A document of a source takes part ``copies = target / size of its source`` times. The
whole copies are certain; what is left is a probability. Pivotal rounding lets two
documents meet: one passes mass to the other until one of them is settled at 0 or 1, and the
other goes on to the next meeting. Mass is probability times words, so the expected
words of a source never change. Which way mass goes is drawn when a document is first left
unsettled, by its probability then, and holds until it is settled.

Documents of a source are dealt by a hash into blocks of about ``BLOCK``. Each block
is folded by itself, long documents first, and leaves one unsettled document at most,
most often a short one. Those residuals form the next
level's blocks, ``BLOCK`` times fewer, up to one residual per source, which is
rounded to the nearer end. No block grows with the data, whatever share of it one source holds.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanebeacon.llm.common import stored, table, uniform, word_count

BLOCK = 256
WEIGHTS = (1, 2, 3)
MOST = 3.0
SEED = 20
_CLOSE = 1e-6  # of a word

# One meeting after the other. c is the number of the unsettled document (0: none), m its expected
# words, up whether it is to gain; won are the documents settled at 1. Whoever is neither in won
# nor c is settled at 0. Both together expect m + mass words. Whoever gains takes as much of that
# as fits: if it is filled it has won, and the other goes on with the rest; else it goes on itself.
_BOTH = "(s.m + units[i - 1].mass)"
_HELD, _NEW = "units[s.c - 1]", "units[i - 1]"


def _upward(mass: str) -> str:
    """Whether the new document is to gain, drawn by its probability at this moment."""
    return f"{_NEW}.draw * {_NEW}.size < {mass}"


_HELD_GAINS = f"""case
      when {_BOTH} >= {_HELD}.size - {_CLOSE} then named_struct(
        'c', if({_BOTH} > {_HELD}.size + {_CLOSE}, i, 0), 'm', greatest({_BOTH} - {_HELD}.size, 0D),
        'up', {_upward(f"{_BOTH} - {_HELD}.size")}, 'won', concat(s.won, array(s.c)))
      else named_struct('c', s.c, 'm', {_BOTH}, 'up', s.up, 'won', s.won) end"""
_NEW_GAINS = f"""case
      when {_BOTH} >= {_NEW}.size - {_CLOSE} then named_struct(
        'c', if({_BOTH} > {_NEW}.size + {_CLOSE}, s.c, 0), 'm', greatest({_BOTH} - {_NEW}.size, 0D),
        'up', s.up, 'won', concat(s.won, array(i)))
      else named_struct('c', i, 'm', {_BOTH}, 'up', {_upward(_BOTH)}, 'won', s.won) end"""

# Lambdas name the block and the outcome, so that each is computed once.
_SETTLED = f"""
transform(array(units), units -> transform(array(aggregate(
  sequence(1, size(units)),
  named_struct('c', 0, 'm', 0D, 'up', false, 'won', array_remove(array(0), 0)),
  (s, i) -> case
    when s.c = 0 then named_struct('c', i, 'm', {_NEW}.mass, 'up', {_upward(f"{_NEW}.mass")}, 'won', s.won)
    when s.up then {_HELD_GAINS}
    else {_NEW_GAINS} end)),
  after -> transform(units, (u, i) -> named_struct(
    'doc_id', u.doc_id, 'size', u.size, 'n', u.n, 'source_size', u.source_size, 'target', u.target,
    'base', u.base, 'documents', u.documents,
    'extra', u.extra + if(array_contains(after.won, i + 1), 1, 0),
    'mass', if(after.c = i + 1, after.m, 0D),
    'open', after.c = i + 1)))[0])[0]"""


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``target`` of each source, from rows of ``source, source_size, documents``: one row per source.

    Sources in order of code points, NULL last, weigh ``weights`` in turn and share the sum
    of all sizes by weight. No target exceeds ``most`` times its source's size; what is
    cut off goes to the others by weight until none is above. The fixed point is found
    directly: with sources in order of size per weight, the first ones are at their bound,
    and the rest share what is left at one rate. That rate grows with every source that is
    at its bound and shrinks with every other one taken out, so it is the largest of all.
    """
    cycle = F.array(*[F.lit(float(weight)) for weight in weights])
    # One row per source; only those few numbers meet in one place.
    placed = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weighed = placed.withColumn("weight", F.element_at(cycle, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")))
    bounded = weighed.withColumn("bound", F.col("source_size") * F.lit(most))
    by_rate = Window.orderBy(F.col("bound") / F.col("weight"), "place")
    before = by_rate.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total, heavy = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    used = F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    gone = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rated = bounded.withColumn("rate", (total - used) / (heavy - gone))
    rated = rated.withColumn("common", F.max("rate").over(everything))
    target = F.least(F.col("bound"), F.col("common") * F.col("weight"))
    return rated.select("source", "source_size", "documents", F.coalesce(target, "bound").alias("target"))


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: float = MOST,
    seed: int = SEED,
) -> DataFrame:
    """How often each document takes part: ``doc_id, source, size, n, source_size, target, base, extra``.

    A row stands for the ``n`` documents that agree in id, source and size: ``extra`` of
    them are taken ``base + 1`` times, the others ``base`` times. ``size`` is the number of
    words. NULL text has size 0; NULL sources form a source of their own; documents of size
    0 are taken as often as certain (once in a source without words). An empty table gives
    no rows. Other columns are not looked at. The same rows give the same result.
    """
    read = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    )
    units = stored(read.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-units")
    sizes = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).cast("double").alias("source_size"), F.count(F.lit(1)).alias("documents")
    )
    targets = stored(source_targets(sizes, weights, most).withColumnRenamed("source", "of_source"), "mix-targets")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    base = F.floor(F.col("copies") + 1e-9)
    left = F.col("n") * (F.col("copies") - F.col("base"))
    opened = (
        units.join(targets, units["source"].eqNullSafe(targets["of_source"]))
        .withColumn("copies", copies)
        .withColumn("base", base)
        .withColumn("left", F.when(F.col("size") > 0, F.greatest(left, F.lit(0.0))).otherwise(F.lit(0.0)))
        .withColumn("extra", F.floor(F.col("left") + 1e-9))
        .withColumn("mass", (F.col("left") - F.col("extra")) * F.col("size"))
        .select("doc_id", "source", "size", "n", "source_size", "target", "base", "extra", "mass", "documents")
    )
    most_documents = targets.agg(F.max("documents")).first()[0] or 0
    settled = [opened.where(F.col("mass") <= _CLOSE)]
    blocks = F.ceil(F.col("documents") / F.lit(BLOCK))
    dealt = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), blocks)
    current = opened.where(F.col("mass") > _CLOSE).withColumn("block", dealt).withColumn("blocks", blocks)
    level, n_blocks = 0, math.ceil(most_documents / BLOCK)
    while n_blocks:
        folded = _folded(current, seed + 1 + level)
        decided = folded.select("source", "block", "blocks", F.inline("units"))
        last = n_blocks == 1
        if last:
            # One document of the source is left. A draw could miss the target by all its words;
            # the nearer end misses it by half of them at most.
            wins = F.col("mass") * 2 >= F.col("size")
            settled.append(decided.withColumn("extra", F.when(F.col("open") & wins, F.col("extra") + 1).otherwise(F.col("extra"))))
            break
        decided = stored(decided, f"mix-level{level}")
        settled.append(decided.where(~F.col("open")))
        fewer = F.ceil(F.col("blocks") / F.lit(BLOCK))
        current = decided.where("open").withColumn("block", F.pmod("block", fewer)).withColumn("blocks", fewer)
        level, n_blocks = level + 1, math.ceil(n_blocks / BLOCK)
    kept = ["doc_id", "source", "size", "n", "source_size", "target", "base", "extra"]
    result = settled[0].select(*kept)
    for part in settled[1:]:
        result = result.unionByName(part.select(*kept))
    return result


def _folded(units: DataFrame, seed: int) -> DataFrame:
    """Each block's documents after their meetings, ``open`` marking the unsettled one."""
    unit = F.struct(
        "size",
        uniform("doc_id", "source", "size", seed=seed).alias("draw"),
        "doc_id",
        "n",
        "source_size",
        "target",
        "base",
        "extra",
        "mass",
        "documents",
    )
    gathered = units.groupBy("source", "block", "blocks").agg(F.sort_array(F.collect_list(unit), asc=False).alias("units"))
    return gathered.withColumn("units", F.expr(_SETTLED))


def take_copies(
    docs: DataFrame, mix: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """``docs`` with every row repeated as often as ``mix``, made from the same rows, says.

    Of rows that agree in id, source and size, those with the smaller hashes are taken once more.
    """
    unit = F.struct(
        docs[id_col].alias("doc_id"), docs[source_col].alias("source"), word_count(docs[text_col]).alias("size")
    )
    packed = docs.select(F.struct(*[docs[name] for name in docs.columns]).alias("row"), unit.alias("unit"))
    packed = packed.withColumn("k", F.xxhash64("unit"))
    told = mix.select(F.struct("doc_id", "source", "size").alias("told"), "n", "base", "extra")
    told = told.withColumn("told_k", F.xxhash64("told"))
    joined = packed.join(told, (F.col("k") == F.col("told_k")) & F.col("unit").eqNullSafe(F.col("told")))
    among_equals = Window.partitionBy("k", "unit").orderBy(F.xxhash64("row"))
    single = joined.where("n = 1").withColumn("turn", F.lit(1))
    several = joined.where("n > 1").withColumn("turn", F.row_number().over(among_equals))
    copies = F.col("base") + (F.col("turn") <= F.col("extra")).cast("bigint")
    counted = single.unionByName(several).select("row", copies.alias("copies")).where("copies > 0")
    return counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select("row.*")


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    """Per document the size, its source's size and target, and the words the mix takes of it."""
    mix = mix_sources(table(spark, sf_dir, "documents"))
    each = mix.withColumn("turn", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    copies = F.col("base") + (F.col("turn") <= F.col("extra")).cast("bigint")
    return each.select(
        "doc_id",
        "size",
        F.col("source_size").cast("bigint").alias("source_size"),
        "target",
        (copies * F.col("size")).alias("taken"),
    )
