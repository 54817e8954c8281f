"""Document fingerprints: bottom-k sketches of shingle hashes. DataFrame functions only.

A shingle is ``WIDTH`` words in a row; a text of fewer words is one shingle, a text without words
has none. The sketch keeps the ``K`` smallest different hashes in ascending order. The sketch of several
parts together is the ``K`` smallest of their sketches, so sketches merge in any order. A
sketch with fewer than ``K`` hashes holds all of them, and what is estimated from two of
those is exact.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanebeacon.llm.common import WORD, ascii_lower, shuffle_partitions, table

K = 128
WIDTH = 5
# Rows with one value that are dealt over ranges of their own.
MANY = 1000
_SPACE = WORD.replace("^", "")
_RANGE = float(1 << 64)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` refers to it in a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sketch(text: Column, *, k: int = K, width: int = WIDTH) -> Column:
    """The ``k`` smallest hashes of a text's shingles. A-Z count as lower case; NULL is an empty text."""
    words = F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _SPACE), lambda w: w != "")

    def hashes(w: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(w) - width),
            lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)]),
        )
        short = F.when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.slice(F.array(F.xxhash64(w)), 1, 0))
        return F.when(F.size(w) >= width, each).otherwise(short)

    return F.slice(F.sort_array(F.array_distinct(_let(words, hashes))), 1, k)


def merged(a: Column, b: Column, *, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct_shingles(s: Column, *, k: int = K) -> Column:
    """Number of different shingles: exact below ``k``, else estimated from the place of the largest hash kept."""
    place = (F.element_at(s, -1).cast("double") + _RANGE / 2) / _RANGE
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise(F.lit(k - 1.0) / place)


def resemblance(a: Column, b: Column, *, k: int = K) -> Column:
    """Share of common shingles among all of both texts; 1 for two texts without any, 0 for one."""
    return _let(merged(a, b, k=k), lambda u: F.coalesce(F.try_divide(_common(u, a, b), F.size(u)), F.lit(1.0)))


def containment(a: Column, b: Column, *, k: int = K) -> Column:
    """Share of ``a``'s shingles that ``b`` has as well; 1 for a text without any."""

    def estimate(u: Column) -> Column:
        return F.coalesce(F.try_divide(_common(u, a, b), F.size(F.array_intersect(u, a))), F.lit(1.0))

    return _let(merged(a, b, k=k), estimate)


def _common(u: Column, a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(F.array_intersect(u, a), b)).cast("double")


def sketch_text(s: Column) -> Column:
    """The hashes as 16 hexadecimal digits each."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def fingerprint_documents(docs: DataFrame, *, text_col: str = "text", k: int = K, width: int = WIDTH) -> DataFrame:
    """``docs`` with ``sketch``, row by row; NULL and empty texts get an empty one."""
    return docs.withColumn("sketch", sketch(F.col(text_col), k=k, width=width))


def with_next(docs: DataFrame, order_col: str, carried: list[str], *, tie_cols: list[str] | None = None) -> DataFrame:
    """``docs`` with ``next_<name>`` of the next row in descending order of ``order_col``; after the last comes the first.

    Rows are dealt into ranges of the order column, and each range's first row is also
    sent to the range before it, where it stands after the last. So every range is
    read by itself, and no more than one row per range is known to the driver. Rows
    without an order stand last. Ties stand in the order of the carried columns; but where ``MANY`` rows share a
    value, or have none, they stand in the order of a hash of ``tie_cols`` (by default the carried ones) first, which
    cuts them into ranges of their own. Only rows that are alike in those too stay in one range.
    """
    spark = docs.sparkSession
    tie = F.xxhash64(*(tie_cols or carried))
    order = docs.select(F.col(order_col).alias("value"), tie.alias("tie"))
    parts = max(2 * shuffle_partitions(spark), 2)
    cut_at = F.percentile_approx("value", [i / parts for i in range(1, parts)], 100 * parts).alias("cuts")
    found = order.agg(cut_at, F.count_if(F.col("value").isNull()).alias("nulls"), F.count(F.lit(1)).alias("n")).first()
    often = Counter(found["cuts"] or [])
    cuts = sorted(often)
    # A value that is the cut between several parts is that many parts large; range i ends with its rows.
    copies = {len(cuts) - 1 - i: often[cut] for i, cut in enumerate(cuts) if often[cut] > 1 and often[cut] * found["n"] >= MANY * parts}
    if found["nulls"] >= MANY:
        copies[len(cuts) + 1] = math.ceil(parts * found["nulls"] / found["n"])
    spans = [1 + copies.get(i, 0) for i in range(len(cuts) + 2)]
    starts = [sum(spans[:i]) for i in range(len(spans))]
    steps = [1 << b for b in reversed(range(max(len(cuts), 1).bit_length()))]

    def range_of(value: Column, tie: Column) -> Column:
        """``r, shared``: by number of cuts above the value, by halving, or beyond them for NULL; shared values by their hash within that."""
        if not cuts:
            below = F.lit(0)
        else:
            bounds = F.array(*[F.lit(cut) for cut in cuts])
            below = F.aggregate(
                F.array(*[F.lit(step) for step in steps]),
                F.lit(0),
                lambda n, step: F.when(
                    (n + step <= len(cuts)) & (F.get(bounds, F.least(n + step, F.lit(len(cuts))) - 1) <= value), n + step
                ).otherwise(n),
            )
        number = F.when(value.isNull(), F.lit(len(cuts) + 1)).otherwise(F.lit(len(cuts)) - below)
        share = F.shiftrightunsigned(tie.bitwiseXOR(F.lit(-(1 << 63))), 11).cast("double") / float(1 << 53)

        def within(i: Column) -> Column:
            more = F.get(F.array(*[F.lit(span - 1) for span in spans]), i)
            last = F.get(F.array(*[F.lit(cut) for cut in reversed(cuts)], F.lit(None)), i)
            shared = (more > 0) & (value.isNull() | value.eqNullSafe(last))
            start = F.get(F.array(*[F.lit(start) for start in starts]), i)
            return F.struct((start + F.when(shared, 1 + F.floor(share * more).cast("int")).otherwise(0)).alias("r"), shared.alias("shared"))

        return _let(number, within)

    # The first row of each range that has any, and the range before it, around the end.
    placed = order.select(range_of(F.col("value"), F.col("tie"))["r"].alias("r"), "value", "tie")
    firsts = placed.groupBy("r").agg(F.max(F.struct("value", F.bitwise_not("tie").alias("tie"))).alias("first")).orderBy("r").collect()
    heads = [(None, None, 0)] * sum(spans)
    for i, row in enumerate(firsts):
        heads[row["r"]] = (row["first"]["value"], ~row["first"]["tie"], firsts[i - 1]["r"])
    kind = docs.schema[order_col].dataType
    first_at = F.array(*[F.lit(value).cast(kind) for value, _, _ in heads])
    tie_at = F.array(*[F.lit(tie).cast("bigint") for _, tie, _ in heads])
    before_at = F.array(*[F.lit(before) for _, _, before in heads])
    value, own, shared = F.col(f"_row.{order_col}"), F.col("_range.r"), F.col("_range.shared")
    packed = docs.select(F.struct(*[docs[name] for name in docs.columns]).alias("_row"), tie.alias("_tie"))
    packed = packed.withColumn("_range", range_of(value, F.col("_tie")))
    rows = packed.select("_row", own.alias("_at"), F.when(shared, F.col("_tie")).alias("_tie"), F.lit(False).alias("_guest"))
    # One of the rows that are first in their range, which partial aggregation chooses in each task.
    is_first = value.eqNullSafe(F.get(first_at, own)) & (~shared | (F.col("_tie") == F.get(tie_at, own)))
    chosen = F.min_by("_row", F.struct(*[F.col(f"_row.{name}") for name in carried])).alias("_row")
    firsts_there = packed.where(is_first).groupBy(own.alias("_own")).agg(chosen)
    guests = firsts_there.select("_row", F.get(before_at, F.col("_own")).alias("_at"), F.lit(None).cast("bigint").alias("_tie"), F.lit(True).alias("_guest"))
    in_order = Window.partitionBy("_at").orderBy("_guest", value.desc_nulls_last(), "_tie", *[F.col(f"_row.{name}") for name in carried])
    following = rows.unionByName(guests).select("_row", "_guest", *[F.lead(f"_row.{name}").over(in_order).alias(f"next_{name}") for name in carried])
    return following.where("not _guest").select("_row.*", *[f"next_{name}" for name in carried])


def op9_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness to it and to the next document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = with_next(fingerprint_documents(docs), "doc_id", ["text", "sketch"], tie_cols=["text"])
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - cut), F.substr("next_text", F.lit(1), cut))
    both = pairs.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    done = both.withColumn("edited_sketch", sketch(F.col("edited")))
    return done.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketch_text(F.col("sketch")).alias("fingerprint"),
        sketch_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_shingles(F.col("sketch")).alias("shingles"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("kept_in_edited"),
        distinct_shingles(merged(F.col("sketch"), F.col("next_sketch"))).alias("shingles_with_next"),
    )
